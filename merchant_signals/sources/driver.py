"""Map the driver's parquet tables onto the pipeline's data model.

The driver ships ``events`` (event_id, ts, user_id, event_type, value, props)
plus the TPC-H style ``customer`` / ``nation`` tables.  The rules below turn
them into raw JSON payloads, historical (labelled) facts and a merchant
dimension.  The DuckDB oracles in ``plans/oracles.py`` restate the same rules
in SQL, so both sides read the same inputs.

Fixed values of the mapping (chosen for these fixtures; they exercise the
reference's edge cases: rejects, fallback ids, late data, NULL and negative
amounts, duplicates):
  raw_id                = event_id + 1
                          (copies: past the largest id of the originals, see duplicates)
  source                = 'SYNTH_LIVE'
  merchant_id           = 'm_' || user_id padded to at least 6 digits;  '' when event_id % 97 = 0 (raw only)
  event_id (text)       = 'evt_' || event_id;             '' when event_id % 101 = 0 (raw only)
  order_id              = 'ord_' || event_id
  status                = 'failed' for event_type 'error', else 'captured'
  received_at/ingested  = ts + (event_id % 90) minutes  (raw);  = ts (historical)
  amount_usd            = value as decimal(18,2); NULL when event_id % 53 = 0;
                          negated when event_type = 'error' and event_id % 7 = 0
  label_bad_outcome     = event_type = 'error'
  label_anomaly         = value > 250
  label_dispute_lost    = event_type = 'error' and event_id % 3 = 0
  duplicates            = rows with event_id % 10 = 0 again, raw_id + max(event_id) + 1,
                          amount + 1.00, received 31 days later (a replay; the
                          payload keeps its times; the first copy must win)
  now                   = 2024-01-31 00:00:00 UTC
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_signals.functions.time import iso_utc, to_utc
from merchant_signals.operators.enrich import MCC_INDUSTRY

# Fixed values (see module doc).
SOURCE = "SYNTH_LIVE"
HISTORICAL_SOURCE = "SYNTHETIC_HISTORICAL"
NOW = _dt.datetime(2024, 1, 31, 0, 0, 0)
NOW_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
REJECT_MERCHANT_MOD = 97
FALLBACK_ID_MOD = 101
NULL_AMOUNT_MOD = 53
NEGATIVE_AMOUNT_MOD = 7
LAG_MINUTES_MOD = 90
DUP_MOD = 10
DUP_DELAY_DAYS = 31

# TPC-H market segment -> merchant segment, nation -> country code.
SEGMENT_MAP = {
    "AUTOMOBILE": "SMB",
    "BUILDING": "SMB",
    "FURNITURE": "MID_MARKET",
    "HOUSEHOLD": "MID_MARKET",
    "MACHINERY": "ENTERPRISE",
}
COUNTRIES = ["US", "CA", "GB", "DE", "FR", "AU", "IN", "BR", "MX", "JP"]
# A customer's merchant category code is MCC_POOL[c_custkey % 7].
MCC_POOL = list(MCC_INDUSTRY)
HISTORY_SPLIT = _dt.datetime(2024, 1, 16, 0, 0, 0)
HISTORY_SPLIT_SQL = "TIMESTAMP '2024-01-16 00:00:00'"
DRIFT_DAYS = 15


def now_lit() -> Column:
    return F.lit(NOW).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver events with ``ts`` as a UTC timestamp."""
    return table(spark, sf_dir, "events").withColumn("ts", to_utc("ts"))


def merchant_of(user_id: Column) -> Column:
    """Padded to at least 6 digits; longer ids stay whole."""
    digits = user_id.cast("string")
    return F.concat(F.lit("m_"), F.lpad(digits, F.greatest(F.length(digits), F.lit(6)), F.lit("0")))


def _amount(e: str = "") -> Column:
    v = F.col("value").cast("decimal(18,2)")
    eid = F.col("event_id")
    return (F.when(eid % NULL_AMOUNT_MOD == 0, F.lit(None).cast("decimal(18,2)"))
            .when((F.col("event_type") == "error") & (eid % NEGATIVE_AMOUNT_MOD == 0), -v)
            .otherwise(v))


def _status() -> Column:
    return F.when(F.col("event_type") == "error", "failed").otherwise("captured")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_realtime_events`` rows (raw_id, source, payload, received_at)."""
    eid = F.col("event_id")
    top = events(spark, sf_dir).agg(F.max("event_id").alias("m")).first()["m"]  # one-row control value
    copies_from = 1 + (top if top is not None else 0)
    ev = (events(spark, sf_dir)
          .withColumn("received_at", F.col("ts") + F.make_dt_interval(
              F.lit(0), F.lit(0), (eid % LAG_MINUTES_MOD).cast("int")))
          .withColumn("amount_usd", _amount()))
    dups = (ev.filter(eid % DUP_MOD == 0)
            .withColumn("amount_usd", F.col("amount_usd") + F.lit(1).cast("decimal(18,2)"))
            .withColumn("dup", F.lit(1)))
    dup_received = F.col("received_at") + F.col("dup") * F.expr(f"INTERVAL {DUP_DELAY_DAYS} DAYS")
    ev = ev.withColumn("dup", F.lit(0))
    both = ev.unionByName(dups)
    payload = F.to_json(F.struct(
        F.when(eid % FALLBACK_ID_MOD == 0, F.lit("")).otherwise(
            F.concat(F.lit("evt_"), eid.cast("string"))).alias("event_id"),
        F.col("event_type"),
        F.when(eid % REJECT_MERCHANT_MOD == 0, F.lit("")).otherwise(
            merchant_of(F.col("user_id"))).alias("merchant_id"),
        F.concat(F.lit("ord_"), eid.cast("string")).alias("order_id"),
        F.col("amount_usd").cast("decimal(18,2)").alias("amount_usd"),
        _status().alias("status"),
        iso_utc("ts").alias("event_time_utc"),
        iso_utc("received_at").alias("ingested_at_utc"),
    ))
    return both.select(
        (eid + 1 + F.col("dup") * F.lit(copies_from)).cast("long").alias("raw_id"),
        F.lit(SOURCE).alias("source"),
        payload.alias("payload"),
        dup_received.alias("received_at"),
    )


def historical_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, labelled facts (as loaded from a wide fact file): ingest time is
    event time, all three labels present, no rejects and no duplicates."""
    eid = F.col("event_id")
    ev = events(spark, sf_dir)
    return ev.select(
        F.concat(F.lit("evt_"), eid.cast("string")).alias("event_id"),
        F.col("event_type"),
        F.col("ts").alias("event_time_utc"),
        F.col("ts").alias("ingested_at_utc"),
        merchant_of(F.col("user_id")).alias("merchant_id"),
        F.concat(F.lit("ord_"), eid.cast("string")).alias("order_id"),
        _amount().alias("amount_usd"),
        _status().alias("status"),
        (F.col("event_type") == "error").cast("int").alias("label_bad_outcome"),
        (F.col("value") > 250).cast("int").alias("label_anomaly"),
        ((F.col("event_type") == "error") & (eid % 3 == 0)).cast("int").alias("label_dispute_lost"),
        (eid + 1).cast("long").alias("raw_id"),
        F.lit(HISTORICAL_SOURCE).alias("source"),
        F.col("ts").alias("received_at"),
        F.lit(None).cast("string").alias("payload"),
    )


def dim_merchant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchant dimension from ``customer`` joined with ``nation``.

    ``nation`` has 25 rows (fixed by the TPC-H spec), so it is broadcast."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    seg = F.create_map(*[F.lit(x) for kv in SEGMENT_MAP.items() for x in kv])
    countries = F.array(*[F.lit(x) for x in COUNTRIES])
    bal = F.col("c_acctbal")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
            .select(
                merchant_of(F.col("c_custkey")).alias("merchant_id"),
                F.col("c_name").alias("merchant_name"),
                F.coalesce(seg[F.col("c_mktsegment")], F.lit("SMB")).alias("merchant_segment"),
                F.when(bal < 0, "HIGH").when(bal < 3000, "MEDIUM").otherwise("LOW").alias("risk_tier"),
                F.element_at(countries, (F.col("c_nationkey") % len(COUNTRIES) + 1).cast("int")).alias("country"),
                F.element_at(F.array(*[F.lit(m) for m in MCC_POOL]),
                             (F.col("c_custkey") % len(MCC_POOL) + 1).cast("int")).alias("mcc"),
                F.col("c_custkey"),
                F.col("c_nationkey"),
            ))


def fact_stage14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14-column historical fact file of the seed script, from the driver
    tables: ingest time = raw receive time, label_bad_outcome NULL for every
    11th event (the load must COALESCE it), drift flag for the last 15 days."""
    eid = F.col("event_id")
    ev = events(spark, sf_dir)
    dim = dim_merchant(spark, sf_dir).select(F.col("c_custkey").alias("user_id"),
                                             F.col("country").alias("merchant_country"),
                                             F.col("mcc").alias("merchant_mcc"))
    j = ev.join(dim, "user_id", "left")
    return j.select(
        F.concat(F.lit("evt_"), eid.cast("string")).alias("event_id"),
        "event_type",
        F.col("ts").alias("event_time_utc"),
        merchant_of(F.col("user_id")).alias("merchant_id"),
        F.concat(F.lit("ord_"), eid.cast("string")).alias("order_id"),
        _status().alias("status"),
        _amount().alias("amount_usd"),
        F.sha2(F.concat(F.lit("payer|"), eid.cast("string")), 256).alias("payer_id_hash"),
        "merchant_country", "merchant_mcc",
        F.lit("SYNTHETIC").alias("source_system"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), (eid % LAG_MINUTES_MOD).cast("int")))
        .alias("ingested_at_utc"),
        F.when(eid % 11 == 0, F.lit(None).cast("int"))
        .otherwise((F.col("event_type") == "error").cast("int")).alias("label_bad_outcome"),
        (F.col("ts") >= now_lit() - F.expr(f"INTERVAL {DRIFT_DAYS} DAYS")).cast("int").alias("drift_regime_id"),
    )


# Fixed values of the payment-event view used by the enrichment operators:
#   payment event type = EVENT_TYPES[event_id % 9]     (operators.enrich.EVENT_TYPES)
#   currency           = ['USD','CAD','GBP','EUR','AUD'][event_id % 5]
#   refund fraction    = [0.25, 0.5, 1.0][event_id % 3]  (refund events only)
#   dispute fee        = [15, 25, 35][event_id % 3]      (dispute events only)
#   settlement lag     = 1 + event_id % 71 hours;  payout lag = 12 + event_id % 108 hours
#   payer country      = COUNTRIES[(event_id div 7) % 10]
REFUND_FRACTIONS = ["0.25", "0.5", "1.0"]
DISPUTE_FEES = ["15", "25", "35"]


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver events as payment events (types, currencies, lags, payer)."""
    from merchant_signals.operators.enrich import CURRENCIES, EVENT_TYPES

    eid = F.col("event_id")

    def pick(values: list[str], idx: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))

    ev = events(spark, sf_dir)
    return ev.select(
        eid.alias("event_no"),
        F.concat(F.lit("evt_"), eid.cast("string")).alias("event_id"),
        pick(EVENT_TYPES, eid % len(EVENT_TYPES)).alias("event_type"),
        F.col("ts").alias("event_time_utc"),
        F.col("user_id"),
        merchant_of(F.col("user_id")).alias("merchant_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        pick(CURRENCIES, eid % len(CURRENCIES)).alias("currency"),
        pick(REFUND_FRACTIONS, eid % 3).cast("decimal(9,4)").alias("refund_fraction"),
        pick(DISPUTE_FEES, eid % 3).cast("decimal(18,2)").alias("dispute_fee_pick"),
        (eid % 71 + 1).cast("int").alias("settlement_lag_hours"),
        (eid % 108 + 12).cast("int").alias("payout_lag_hours"),
        pick(COUNTRIES, F.floor(eid / 7) % len(COUNTRIES)).alias("payer_country"),
    )
