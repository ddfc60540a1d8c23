"""The registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry reads the driver tables (or data Spark derives from them) in
full.  Results go through ``for_compare`` so column types line up with the
DuckDB oracles in ``plans.oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_signals.operators.features import merchant_features
from merchant_signals.plans import views as V
from merchant_signals.schemas import FACT_FILE_COLUMNS

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return V.for_compare(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


@query("merchant_features")
def q_merchant_features(spark, sf_dir):
    """OP-31 + OP-49: windowed features of the live facts, ingest guard on."""
    return merchant_features(V.live_facts(spark, sf_dir))


@query("risk_score_v1")
def q_risk_score_v1(spark, sf_dir):
    """OP-31 + OP-55: the flagship snapshot table (features + heuristic)."""
    return V.scored_features(V.live_facts(spark, sf_dir))


# ---- buckets and snapshots -------------------------------------------------

@query("time_buckets")
def q_time_buckets(spark, sf_dir):
    """OP-51: floor15 / ceil15 / next15 of every event time."""
    from pyspark.sql import functions as F

    from merchant_signals.functions.time import ceil15, floor15, next15
    from merchant_signals.sources import driver

    e = driver.events(V.ensure_session(spark), sf_dir)
    return e.select("event_id", "ts", floor15("ts").alias("floor15"), ceil15("ts").alias("ceil15"),
                    next15("ts").alias("next15"))


@query("bucket_series")
def q_bucket_series(spark, sf_dir):
    """OP-43 + OP-52: every bucket between next15(min) and next15(max) event time."""
    from merchant_signals.operators.features import backfill_buckets

    return backfill_buckets(V.hist_facts(spark, sf_dir))


@query("snapshot_backfill")
def q_snapshot_backfill(spark, sf_dir):
    """OP-53: bucket_count and snapshot rows of the historical backfill."""
    from pyspark.sql import functions as F

    from merchant_signals.operators.features import backfill_buckets, snapshot_backfill

    hf = V.hist_facts(spark, sf_dir)
    b = backfill_buckets(hf).agg(F.count(F.lit(1)).alias("bucket_count"))
    s = snapshot_backfill(hf).agg(F.count(F.lit(1)).alias("snapshot_rows_upserted"))
    return b.crossJoin(s)


@query("backfill_rows")
def q_backfill_rows(spark, sf_dir):
    """OP-53: the stored snapshot rows of the historical backfill."""
    return V.hist_snapshots(spark, sf_dir)


@query("latest_features")
def q_latest_features(spark, sf_dir):
    """OP-44: newest snapshot per merchant, from the stored latest state."""
    return V.live_latest(spark, sf_dir)


@query("latest_kept")
def q_latest_kept(spark, sf_dir):
    """OP-44 as the store keeps it up: snapshots arrive in three waves, the newest days second; the
    one-row-a-merchant table after them equals a scan of all snapshots."""
    import datetime as dt
    from merchant_signals.session import temp_path
    from merchant_signals.sources import driver
    from merchant_signals.sources.store import TableStore

    snaps = V.live_snapshots(spark, sf_dir)
    store = TableStore(spark, temp_path(spark, "latest_store"))
    t = F.col("snapshot_time_utc")
    old, new = (F.lit(driver.NOW - dt.timedelta(days=d)).cast("timestamp") for d in (20, 4))
    for wave in ((t >= old) & (t < new), t >= new, t < old):
        store.replace_partitions("snapshots", V.with_model_columns(snaps.filter(wave)))
    return store.latest_snapshots().select(*snaps.columns)


# ---- labels, training set, model, backtest ---------------------------------

@query("label_24h")
def q_label_24h(spark, sf_dir):
    """OP-19 + OP-21 + OP-27 + OP-34: the historical training export, built
    from the snapshot table and the facts."""
    return V.build_training_set(spark, sf_dir)


@query("training_window")
def q_training_window(spark, sf_dir):
    """OP-21: both window rules (history bounds from the facts; scheduled run at now)."""
    from pyspark.sql import functions as F

    from merchant_signals.operators.labels import history_window, scheduled_window
    from merchant_signals.sources import driver

    s, e = scheduled_window(driver.NOW)
    return history_window(V.hist_facts(spark, sf_dir), driver.now_lit()).select(
        "*", F.lit(s).cast("timestamp").alias("scheduled_start_utc"),
        F.lit(e).cast("timestamp").alias("scheduled_end_utc"))


@query("training_export")
def q_training_export(spark, sf_dir):
    """OP-08: the scheduled export ([now-8d, now-24h)) of the snapshot table, written
    as the ordered training CSV and read back."""
    from pyspark.sql import functions as F

    from merchant_signals.operators.labels import scheduled_window, training_dataset
    from merchant_signals.session import temp_path
    from merchant_signals.sources import driver
    from merchant_signals.sources.files import export_training_csv, read_csv

    s, e = scheduled_window(driver.NOW)
    hf = V.hist_facts(spark, sf_dir)
    rows = training_dataset(V.hist_snapshots(spark, sf_dir), hf, F.lit(s).cast("timestamp"),
                            F.lit(e).cast("timestamp"), driver.now_lit())
    path = temp_path(spark, "training_csv")
    export_training_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@query("train_model")
def q_train_model(spark, sf_dir):
    """OP-36: class-mean model on the training set (one row per feature)."""
    from merchant_signals.operators import model as M

    return M.stats_long(M.train(V.training_set(spark, sf_dir)))


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """OP-12: save the model as Parquet below the checkpoint dir, load, check keys."""
    from merchant_signals.operators import model as M
    from merchant_signals.session import temp_path

    path = temp_path(spark, "models")
    M.save(M.train(V.training_set(spark, sf_dir)), path)
    return M.stats_long(M.load(spark, path))


@query("score_model")
def q_score_model(spark, sf_dir):
    """OP-56: model score and band for every training row."""
    from pyspark.sql import functions as F

    from merchant_signals.operators import model as M
    from merchant_signals.operators.scoring import model_score

    ts = V.training_set(spark, sf_dir)
    s = model_score(ts, M.train(ts))
    return s.select("merchant_id", "snapshot_time_utc",
                    F.round("local_model_score_raw", 5).cast("decimal(6,5)").alias("local_model_score"),
                    "local_model_band")


@query("time_split")
def q_time_split(spark, sf_dir):
    """OP-58: strict time boundary at split 0.8 and the row counts on each side."""
    from pyspark.sql import functions as F

    from merchant_signals.operators.backtest import split_boundary

    ts = V.training_set(spark, sf_dir)
    b = F.broadcast(split_boundary(ts, 0.8))
    t = F.col("snapshot_time_utc")
    return (ts.crossJoin(b).groupBy("boundary_snapshot_time", "n_times")
            .agg(F.count_if(t < F.col("boundary_snapshot_time")).alias("train_rows"),
                 F.count_if(t >= F.col("boundary_snapshot_time")).alias("test_rows")))


@query("backtest")
def q_backtest(spark, sf_dir):
    """OP-37/38/59/60: local model vs heuristic on the newest 20% of times."""
    from merchant_signals.operators.backtest import backtest

    return backtest(V.training_set(spark, sf_dir), 0.8)


@query("tolerant_features")
def q_tolerant_features(spark, sf_dir):
    """OP-09: payload amounts read with the tolerant float rule."""
    from merchant_signals.functions.json import json_text
    from merchant_signals.functions.numeric import tolerant_float

    r = V.raw(spark, sf_dir)
    return r.select("raw_id", tolerant_float(json_text("payload", "amount_usd")).alias("amount_f"))


# ---- raw -> facts ------------------------------------------------------------

# Batch size of the registered increments: several batches even on the small tables.
QUERY_BATCH = 2_000


def _watermark_state(spark, sf_dir):
    """Fixture state of ``raw_ingest_watermark``: everything received before
    the history split has been loaded.  One row per source."""
    from pyspark.sql import functions as F

    from merchant_signals.sources import driver

    r = V.raw(spark, sf_dir)
    return (r.filter(F.col("received_at") < F.lit(driver.HISTORY_SPLIT).cast("timestamp"))
            .groupBy("source").agg(F.max("raw_id").alias("last_raw_id")))


def _watermark_value(spark, sf_dir, source="SYNTH_LIVE"):
    """The source's watermark, a one-row control value."""
    row = _watermark_state(spark, sf_dir).filter(F.col("source") == source).first()
    return int(row["last_raw_id"]) if row else 0


@query("raw_valid_split")
def q_raw_valid_split(spark, sf_dir):
    """OP-16: merchant presence per raw row (rejects are consumed, not loaded)."""
    from merchant_signals.functions.json import json_text
    from merchant_signals.operators.facts import merchant_present

    r = V.raw(spark, sf_dir)
    return r.select("raw_id", json_text("payload", "merchant_id").alias("merchant_id"),
                    merchant_present("payload").alias("is_valid"))


@query("facts_from_raw")
def q_facts_from_raw(spark, sf_dir):
    """OP-17: typed projection of every valid raw row (before dedup)."""
    from merchant_signals.operators.facts import facts_from_raw

    return facts_from_raw(V.raw(spark, sf_dir)).drop("payload", *FACT_FILE_COLUMNS)


@query("dedup_first_wins")
def q_dedup_first_wins(spark, sf_dir):
    """OP-22: first-wins fact table over all raw rows (duplicates carry new amounts)."""
    return V.build_live_facts(spark, sf_dir).drop("payload", *FACT_FILE_COLUMNS)


@query("insert_ignore")
def q_insert_ignore(spark, sf_dir):
    """OP-23: live facts appended to a historical table (first half of the
    month) with insert-ignore on event_id."""
    from pyspark.sql import functions as F

    from merchant_signals.operators.facts import insert_ignore
    from merchant_signals.sources import driver

    cols = ["event_id", "source", "raw_id", "amount_usd", "event_time_utc"]
    existing = (V.hist_facts(spark, sf_dir)
                .filter(F.col("event_time_utc") < F.lit(driver.HISTORY_SPLIT).cast("timestamp"))
                .select(*cols))
    new = V.live_facts(spark, sf_dir).select(*cols)
    ins = insert_ignore(new, existing, "event_id")
    return (existing.withColumn("origin", F.lit("existing"))
            .unionByName(ins.withColumn("origin", F.lit("inserted"))))


@query("new_merchants")
def q_new_merchants(spark, sf_dir):
    """OP-33: merchants discovered in raw rows, inserted into a fresh
    dimension that holds only the seed merchant."""
    from merchant_signals.operators.facts import new_merchants
    from merchant_signals.sources import driver

    seed = spark.createDataFrame([("m_seed_0001",)], "merchant_id string")
    return new_merchants(V.raw(spark, sf_dir), seed, driver.now_lit())


@query("load_stats")
def q_load_stats(spark, sf_dir):
    """OP-35 + OP-48: (processed, inserted, watermark) of every increment."""
    from merchant_signals.operators.facts import all_increments_stats

    return all_increments_stats(V.raw(spark, sf_dir), "SYNTH_LIVE", QUERY_BATCH)


@query("incremental_batch")
def q_incremental_batch(spark, sf_dir):
    """OP-15: the next raw rows after the source's watermark."""
    from merchant_signals.operators.facts import incremental_batch

    wm = _watermark_value(spark, sf_dir)
    return (incremental_batch(V.raw(spark, sf_dir), "SYNTH_LIVE", wm, QUERY_BATCH)
            .select("raw_id", "source", "received_at"))


@query("watermark_advance")
def q_watermark_advance(spark, sf_dir):
    """OP-35 + OP-48: one increment from the watermark state: batch,
    insert-ignore against the facts already loaded, new watermark."""
    from pyspark.sql import functions as F

    from merchant_signals.operators.facts import (
        batch_stats, dedup_first_wins, facts_from_raw, incremental_batch, load_batch)

    wm = _watermark_value(spark, sf_dir)
    r = V.raw(spark, sf_dir)
    loaded = dedup_first_wins(facts_from_raw(r.filter(F.col("raw_id") <= F.lit(wm))))
    batch = incremental_batch(r, "SYNTH_LIVE", wm, QUERY_BATCH)
    stats = batch_stats(batch, load_batch(batch, loaded), wm)
    return stats.select(F.lit("SYNTH_LIVE").alias("source"), F.lit(wm).cast("long").alias("last_raw_id_before"),
                        "processed_rows", "inserted_fact", "updated_watermark")


@query("ingest_lag")
def q_ingest_lag(spark, sf_dir):
    """OP-40: raw rows beyond the watermark, per source."""
    from merchant_signals.operators.facts import ingest_lag

    return ingest_lag(V.raw(spark, sf_dir), _watermark_state(spark, sf_dir))


@query("dense_row_id")
def q_dense_row_id(spark, sf_dir):
    """OP-04: ROW_NUMBER() OVER (ORDER BY event_time_utc, event_id) without a
    single-partition window."""
    from merchant_signals.operators.row_ids import dense_row_id

    hf = V.hist_facts(spark, sf_dir).select("event_id", "event_time_utc")
    return dense_row_id(hf, ["event_time_utc", "event_id"], "raw_id")


@query("historical_fact_load")
def q_historical_fact_load(spark, sf_dir):
    """OP-06/07: the 14-column fact CSV written and read back with COPY
    semantics, then loaded as historical facts."""
    from merchant_signals.functions.json import json_text
    from merchant_signals.operators.facts import historical_load
    from merchant_signals.session import temp_path
    from merchant_signals.sources import driver
    from merchant_signals.sources.files import read_fact_csv14, write_csv

    path = temp_path(spark, "stage")
    write_csv(driver.fact_stage14(V.ensure_session(spark), sf_dir), path)
    loaded = historical_load(read_fact_csv14(spark, path))
    return (loaded.withColumn("payload_merchant_country", json_text("payload", "merchant_country"))
            .drop("payload", *FACT_FILE_COLUMNS))


# ---- enrichment ----------------------------------------------------------------

def _payments(spark, sf_dir):
    from merchant_signals.sources import driver

    return driver.payment_events(V.ensure_session(spark), sf_dir)


def _dim(spark, sf_dir):
    from merchant_signals.sources import driver

    return driver.dim_merchant(V.ensure_session(spark), sf_dir)


def _priced(spark, sf_dir):
    """Payment events with merchant attributes, status, USD amounts, refunds
    and dispute fees (the inputs of the fee / settlement operators)."""
    from pyspark.sql import functions as F

    from merchant_signals.operators import enrich as E

    p = E.enrich_with_merchant(_payments(spark, sf_dir), _dim(spark, sf_dir),
                               ("merchant_segment", "risk_tier", "mcc", "country"))
    p = E.fx_normalise(p.withColumn("status", E.status_of("event_type")))
    t = F.col("event_type")
    return (p.withColumn("refund_amount", F.when(t.isin(E.REFUND_TYPES),
                                                 F.round(F.col("amount_usd_exact") * F.col("refund_fraction"), 2))
                         .otherwise(F.lit(0)).cast("decimal(18,2)"))
            .withColumn("dispute_fee", F.when(t.isin(E.DISPUTE_TYPES), F.col("dispute_fee_pick"))
                        .otherwise(F.lit(0)).cast("decimal(18,2)")))


@query("event_status")
def q_event_status(spark, sf_dir):
    """OP-61: event type -> status."""
    from merchant_signals.operators.enrich import status_of

    return _payments(spark, sf_dir).select("event_id", "event_type", status_of("event_type").alias("status"))


@query("event_flags")
def q_event_flags(spark, sf_dir):
    """OP-62: refund / dispute / denied flags and the bad-outcome label."""
    from merchant_signals.operators.enrich import event_flags

    p = _priced(spark, sf_dir)
    return event_flags(p, "event_type", "refund_amount").select(
        "event_id", "is_refund", "is_dispute", "is_denied", "label_bad_outcome")


@query("conditional_ids")
def q_conditional_ids(spark, sf_dir):
    """OP-63: lifecycle ids only for their event types."""
    from pyspark.sql import functions as F

    from merchant_signals.operators.enrich import ID_TYPES, conditional_ids

    p = _payments(spark, sf_dir)
    return conditional_ids(p, F.col("event_no").cast("string")).select("event_id", *ID_TYPES)


@query("fx_normalise")
def q_fx_normalise(spark, sf_dir):
    """OP-64: FX rate by currency and USD amount."""
    from merchant_signals.operators.enrich import fx_normalise

    return fx_normalise(_payments(spark, sf_dir)).select("event_id", "currency", "amount",
                                                         "fx_rate_to_usd", "amount_usd")


@query("fees_net")
def q_fees_net(spark, sf_dir):
    """OP-65: fee rate, fee and net amount."""
    from merchant_signals.operators.enrich import fees_net

    return fees_net(_priced(spark, sf_dir)).select("event_id", "fee_rate", "fee_amount", "net_amount")


@query("settlement_times")
def q_settlement_times(spark, sf_dir):
    """OP-66: settlement and payout times for completed captures."""
    from merchant_signals.operators.enrich import settlement_times

    return settlement_times(_priced(spark, sf_dir)).select(
        "event_id", "status", "settlement_lag_hours", "payout_lag_hours", "settlement_time_utc", "payout_time_utc")


@query("cross_border")
def q_cross_border(spark, sf_dir):
    """OP-67: payer country differs from merchant country."""
    from merchant_signals.operators.enrich import cross_border

    p = _priced(spark, sf_dir)
    return p.select("event_id", "payer_country", F.col("country").alias("merchant_country"),
                    cross_border("payer_country", "country").alias("is_cross_border"))


@query("drift_regime")
def q_drift_regime(spark, sf_dir):
    """OP-68: drift flag for events of the last 15 days before now."""
    from merchant_signals.operators.enrich import drift_regime
    from merchant_signals.sources import driver

    p = _payments(spark, sf_dir)
    return p.select("event_id", drift_regime("event_time_utc", driver.now_lit(), driver.DRIFT_DAYS)
                    .alias("drift_regime_id"))


@query("hash_ids")
def q_hash_ids(spark, sf_dir):
    """OP-69: sha256 pseudonyms of payer, device and IP identifiers."""
    from merchant_signals.operators.enrich import pseudonymise

    p = _payments(spark, sf_dir)
    return p.select("event_id",
                    pseudonymise("payer|", "event_no").alias("payer_id_hash"),
                    pseudonymise("dev|", "user_id").alias("device_id_hash"),
                    pseudonymise("ip|", F.col("event_no") % 65536).alias("ip_hash"))


@query("merchant_policy")
def q_merchant_policy(spark, sf_dir):
    """OP-70: processor fee, reserve rate, industry and US state per merchant."""
    from merchant_signals.operators.enrich import merchant_policy

    d = merchant_policy(_dim(spark, sf_dir), F.col("c_custkey"))
    return d.select("merchant_id", "merchant_segment", "risk_tier", "mcc", "country",
                    "processor_fee_rate", "reserve_rate", "industry_name", "state")


@query("enrich_merchant")
def q_enrich_merchant(spark, sf_dir):
    """OP-30: live facts with merchant segment, risk tier, MCC and country."""
    from merchant_signals.operators.enrich import enrich_with_merchant

    f = V.live_facts(spark, sf_dir).select("event_id", "merchant_id", "event_time_utc")
    return enrich_with_merchant(f, _dim(spark, sf_dir))


@query("anomaly_p997")
def q_anomaly_p997(spark, sf_dir):
    """OP-39: amounts above the exact 99.7th percentile of the last 14 days."""
    from merchant_signals.operators.enrich import anomaly_flag
    from merchant_signals.sources import driver

    p = _priced(spark, sf_dir).select("event_id", "event_time_utc", "amount_usd")
    return anomaly_flag(p, "amount_usd", "event_time_utc", driver.now_lit()).select(
        "event_id", "amount_usd", "p", "label_anomaly")




# ---- snapshot table mutation, scoring write-back ------------------------------

def _score_bounds():
    from merchant_signals.operators.features import horizon_bounds
    from merchant_signals.sources import driver

    return horizon_bounds(driver.NOW)


@query("score_window")
def q_score_window(spark, sf_dir):
    """OP-20: snapshots in [ceil15(end) - 75m, ceil15(end)] (6 buckets, both ends in)."""
    lo, hi = _score_bounds()
    s = V.hist_snapshots(spark, sf_dir)
    t = F.col("snapshot_time_utc")
    return s.filter(t.between(F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")))


def _written_back(spark, sf_dir):
    from merchant_signals.operators import model as M
    from merchant_signals.operators.mutate import update_columns
    from merchant_signals.operators.scoring import persist_scores
    from merchant_signals.schemas import MODEL_COLUMNS, SNAPSHOT_KEY
    from merchant_signals.sources import driver

    lo, hi = _score_bounds()
    snaps = V.with_model_columns(V.hist_snapshots(spark, sf_dir))
    t = F.col("snapshot_time_utc")
    window = snaps.filter(t.between(F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")))
    model = M.train(V.training_set(spark, sf_dir))
    scores = persist_scores(window, model, driver.now_lit())
    return update_columns(snaps, scores, SNAPSHOT_KEY, MODEL_COLUMNS)


@query("score_writeback")
def q_score_writeback(spark, sf_dir):
    """OP-26 + OP-57: model scores of the scoring window written onto the snapshot table."""
    return _written_back(spark, sf_dir)


@query("snapshot_upsert")
def q_snapshot_upsert(spark, sf_dir):
    """OP-25: the last 6 buckets recomputed from live facts and upserted; the
    model columns of existing rows are carried over."""
    from merchant_signals.operators.features import recompute_horizon
    from merchant_signals.operators.mutate import upsert_snapshots
    from merchant_signals.operators.scoring import risk_score_v1
    from merchant_signals.sources import driver

    src = (risk_score_v1(recompute_horizon(V.live_facts(spark, sf_dir), driver.NOW))
           .withColumn("computed_at_utc", driver.now_lit() + F.expr("INTERVAL 15 MINUTES")))
    return upsert_snapshots(_written_back(spark, sf_dir), src)


@query("schema_upgrade")
def q_schema_upgrade(spark, sf_dir):
    """OP-13: an old fact table (no label columns, event time missing on
    'view' rows) upgraded to the current schema with the backfill."""
    from merchant_signals.operators.mutate import upgrade_schema
    from merchant_signals.schemas import FACT

    old = (V.live_facts(spark, sf_dir).drop("label_bad_outcome", "label_anomaly", "label_dispute_lost")
           .withColumn("event_time_utc", F.when(F.col("event_type") != "view", F.col("event_time_utc"))))
    up = upgrade_schema(old, FACT, backfill={"event_time_utc": F.col("ingested_at_utc")})
    return up.select("event_id", "event_type", "event_time_utc", "ingested_at_utc",
                     "label_bad_outcome", "label_anomaly", "label_dispute_lost")


@query("insert_if_absent")
def q_insert_if_absent(spark, sf_dir):
    """OP-03: the seed merchant added to the dimension only when absent."""
    from merchant_signals.operators.mutate import insert_if_absent

    dim = _dim(spark, sf_dir).select("merchant_id", "merchant_name")
    seed = spark.createDataFrame([("m_seed_0001", "Seed Merchant")], "merchant_id string, merchant_name string")
    return insert_if_absent(dim, seed, key=["merchant_id"])


def _review(spark, sf_dir):
    """Merchants with a negative amount (a reversal) in their history."""
    return (V.hist_facts(spark, sf_dir).filter(F.col("amount_usd") < 0)
            .select("merchant_id").distinct())


@query("dim_upsert")
def q_dim_upsert(spark, sf_dir):
    """OP-24: reviewed merchants replace their dimension rows (all columns)."""
    from merchant_signals.operators.mutate import upsert_last_state

    dim = _dim(spark, sf_dir).select("merchant_id", "merchant_name", "merchant_segment", "risk_tier",
                                     "country", "mcc")
    src = (dim.join(_review(spark, sf_dir), "merchant_id", "left_semi")
           .withColumn("risk_tier", F.lit("HIGH"))
           .withColumn("merchant_name", F.concat("merchant_name", F.lit(" (reviewed)"))))
    return upsert_last_state(dim, src, ["merchant_id"])


def _dim22(spark, sf_dir):
    """The 22-column merchant file built from the dimension rules."""
    from merchant_signals.operators.enrich import merchant_policy
    from merchant_signals.schemas import DIM_CSV22
    from merchant_signals.sources import driver

    d = merchant_policy(_dim(spark, sf_dir), F.col("c_custkey"))
    d = (d.withColumn("onboarding_date", F.date_add(F.lit("2020-01-01").cast("date"),
                                                     (F.col("c_custkey") % 1000).cast("int")))
         .withColumn("account_status", F.lit("ACTIVE"))
         .withColumn("fixed_fee", F.lit("0.30").cast("decimal(18,2)"))
         .withColumn("created_at_utc", driver.now_lit()))
    return d.select(*[(F.col(f.name) if f.name in d.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in DIM_CSV22.fields])


@query("dim_csv_upsert")
def q_dim_csv_upsert(spark, sf_dir):
    """OP-05 + OP-24: 22-column merchant CSV (header skipped positionally)
    upserted into the stored dimension, which holds the seed merchant."""
    from merchant_signals.schemas import DIM_COLUMNS
    from merchant_signals.session import temp_path
    from merchant_signals.sources.files import load_dim_csv, write_csv
    from merchant_signals.sources.store import TableStore

    base = temp_path(spark, "dim_csv")
    write_csv(_dim22(spark, sf_dir), base + "/in")
    store = TableStore(spark, base + "/store")
    store.append("dim_merchant", spark.createDataFrame([("m_seed_0001", "Seed Merchant")],
                                                       "merchant_id string, merchant_name string"))
    state, _staged = load_dim_csv(spark, base + "/in", store.read("dim_merchant"))
    store.replace("dim_merchant", state)
    return store.read("dim_merchant").select(*DIM_COLUMNS)


# ---- monitoring ------------------------------------------------------------------

@query("bucket_coverage")
def q_bucket_coverage(spark, sf_dir):
    """OP-41: snapshot rows per bucket of a run's horizon, 0 for empty buckets."""
    import datetime as dt

    from merchant_signals.operators.features import horizon_bounds
    from merchant_signals.sources import driver

    lo, hi = horizon_bounds(driver.NOW + dt.timedelta(hours=1))
    buckets = spark.range(6).select(
        (F.lit(lo).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 15).cast("int")))
        .alias("snapshot_time_utc"))
    t = F.col("snapshot_time_utc")
    snaps = (V.live_snapshots(spark, sf_dir).filter(t.between(F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp")))
             .select("merchant_id", "snapshot_time_utc"))
    return (buckets.join(snaps, "snapshot_time_utc", "left").groupBy("snapshot_time_utc")
            .agg(F.count("merchant_id").alias("snapshot_rows")))


@query("recent_buckets")
def q_recent_buckets(spark, sf_dir):
    """OP-41: rows of the five newest buckets (top-k is the feature)."""
    from merchant_signals.operators.features import newest_buckets

    return newest_buckets(V.live_snapshots(spark, sf_dir), 5)


@query("coverage_counts")
def q_coverage_counts(spark, sf_dir):
    """OP-42: fact rows, snapshot rows and exportable rows (last 30 days to now-24h)."""
    from merchant_signals.operators.labels import training_dataset
    from merchant_signals.sources import driver

    hf = V.hist_facts(spark, sf_dir)
    snaps = V.hist_snapshots(spark, sf_dir)
    now = driver.now_lit()
    exp = training_dataset(snaps, hf, now - F.expr("INTERVAL 30 DAYS"), now - F.expr("INTERVAL 24 HOURS"), now)
    def cnt(df, name):
        return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")
    return cnt(hf, "fact_rows").unionByName(cnt(snaps, "snapshot_rows")).unionByName(cnt(exp, "exported_rows"))


@query("merchant_lookup")
def q_merchant_lookup(spark, sf_dir):
    """OP-45: merchant profiles for the merchants in the scoring window (semi join)."""
    lo, hi = _score_bounds()
    t = F.col("snapshot_time_utc")
    keys = (V.hist_snapshots(spark, sf_dir)
            .filter(t.between(F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp"))).select("merchant_id"))
    return (_dim(spark, sf_dir).join(keys, "merchant_id", "left_semi")
            .select("merchant_id", "merchant_name", "merchant_segment", "risk_tier", "country", "mcc"))


@query("newest_raw")
def q_newest_raw(spark, sf_dir):
    """OP-46: newest raw row per source that can serve as a clone template."""
    from merchant_signals.functions.json import json_text
    from merchant_signals.operators.clone import newest_templates

    return newest_templates(V.raw(spark, sf_dir)).select("source", "raw_id", json_text("payload", "event_id").alias("event_id"))


# ---- late data, horizons, arbitrary times, reruns ------------------------------------

@query("late_events_excluded")
def q_late_events_excluded(spark, sf_dir):
    """OP-49: facts kept out of a bucket by the ingest-time guard."""
    from merchant_signals.operators.features import late_excluded

    return late_excluded(V.live_facts(spark, sf_dir))


@query("recompute_horizon")
def q_recompute_horizon(spark, sf_dir):
    """OP-49 + OP-52: the 6 buckets a manual run ending at now + 7 minutes recomputes."""
    import datetime as dt

    from merchant_signals.operators.features import recompute_horizon
    from merchant_signals.sources import driver

    return recompute_horizon(V.live_facts(spark, sf_dir), driver.NOW + dt.timedelta(minutes=7))


@query("snapshot_at_times")
def q_snapshot_at_times(spark, sf_dir):
    """OP-28: features at unaligned times (a manual run ending at the last event)."""
    from merchant_signals.operators.features import features_at_times

    lf = V.live_facts(spark, sf_dir)
    end = F.lit(lf.agg(F.max("event_time_utc").alias("e")).first()["e"]).cast("timestamp")
    times = spark.range(1).select(F.explode(F.sequence(end - F.expr("INTERVAL 75 MINUTES"), end,
                                                       F.expr("INTERVAL 15 MINUTES"))).alias("snapshot_time_utc"))
    return features_at_times(lf, times)


@query("rerun_noop")
def q_rerun_noop(spark, sf_dir):
    """OP-54: loading the same raw rows a second time changes nothing."""
    from merchant_signals.operators.facts import dedup_first_wins, facts_from_raw, insert_ignore

    once = V.live_facts(spark, sf_dir)
    again = insert_ignore(dedup_first_wins(facts_from_raw(V.raw(spark, sf_dir))), once, "event_id")
    return merchant_features(once.unionByName(again))


@query("realtime_tail")
def q_realtime_tail(spark, sf_dir):
    """OP-11: the last 60 minutes of events, in event-time order, written as JSON
    lines and read back."""
    from merchant_signals.session import temp_path
    from merchant_signals.sources.files import realtime_tail, write_jsonl

    lf = V.live_facts(spark, sf_dir)
    ref = F.lit(lf.agg(F.max("event_time_utc").alias("e")).first()["e"]).cast("timestamp")
    tail = realtime_tail(lf, ref).select("event_id", "event_time_utc", "merchant_id", "amount_usd")
    path = temp_path(spark, "tail")
    write_jsonl(tail, path)
    return spark.read.schema(tail.schema).json(path)


@query("table_export")
def q_table_export(spark, sf_dir):
    """OP-10: the dimension exported as CSV partitioned by country, read back."""
    from merchant_signals.schemas import DIM_CSV22
    from merchant_signals.session import temp_path
    from merchant_signals.sources.files import export_table, read_csv

    path = temp_path(spark, "export")
    export_table(_dim22(spark, sf_dir), path, "csv", ["country"])
    schema = DIM_CSV22.__class__([f for f in DIM_CSV22.fields if f.name != "country"])
    back = read_csv(spark, path, schema)
    return back.select("merchant_id", "merchant_name", "country", "state", "processor_fee_rate",
                       "reserve_rate", "onboarding_date", "created_at_utc")


@query("json_merge")
def q_json_merge(spark, sf_dir):
    """OP-71: clone a payload with a new event id and event time (right side wins)."""
    from merchant_signals.functions.json import json_merge, json_text
    from merchant_signals.functions.time import iso_utc

    r = V.raw(spark, sf_dir)
    over = F.create_map(
        F.lit("event_id"), F.concat(F.lit("evt_clone_"), F.col("raw_id").cast("string")),
        F.lit("event_time_utc"), iso_utc(F.col("received_at") + F.expr("INTERVAL 1 DAY")))
    m = r.select("raw_id", json_merge("payload", over).alias("p"))
    return m.select("raw_id", json_text("p", "event_id").alias("event_id"),
                    json_text("p", "event_time_utc").alias("event_time_utc"),
                    json_text("p", "merchant_id").alias("merchant_id"),
                    json_text("p", "amount_usd").cast("double").alias("amount_usd"),
                    F.size(F.json_object_keys("p")).alias("n_keys"))


# ---- increments and streams ---------------------------------------------------------

def _arrival_chunks(raw, n: int = 4):
    """Raw rows split by receive time into ``n`` arrival waves (left to right)."""
    from merchant_signals.sources import driver

    edges = [driver.NOW.replace(day=1 + 8 * i) for i in range(1, n)]
    t = F.col("received_at")
    out, lo = [], None
    for e in edges + [None]:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (t >= F.lit(lo).cast("timestamp"))
        if e is not None:
            cond = cond & (t < F.lit(e).cast("timestamp"))
        out.append(raw.filter(cond))
        lo = e
    return out


def several_batches(rows: int) -> int:
    """Batch size that loads a small table in five batches; beyond 100,000 rows the number of batches grows with the table."""
    from merchant_signals.operators.facts import BATCH_SIZE

    return min(BATCH_SIZE, max(QUERY_BATCH, rows // 5))


@query("increment_run")
def q_increment_run(spark, sf_dir):
    """OP-47: the originals are loaded in several batches and the buckets of the
    scheduled training window are computed; then the copies arrive, and one more
    catch-up at now recomputes its 6 buckets, exports, trains and scores them."""
    from merchant_signals.operators.labels import scheduled_window
    from merchant_signals.plans.increment import catch_up, recompute_buckets
    from merchant_signals.session import temp_path
    from merchant_signals.sources import driver
    from merchant_signals.sources.store import TableStore

    store = TableStore(spark, temp_path(spark, "store"))
    raw = V.raw(spark, sf_dir)
    copies = 1 + driver.events(spark, sf_dir).agg(F.max("event_id").alias("m")).first()["m"]
    several = several_batches(raw.count())
    store.append("raw", raw.filter(F.col("raw_id") <= F.lit(copies)))
    catch_up(spark, store, driver.NOW, batch_size=several)
    recompute_buckets(store, *scheduled_window(driver.NOW), driver.now_lit())
    store.append("raw", raw.filter(F.col("raw_id") > F.lit(copies)))
    catch_up(spark, store, driver.NOW, batch_size=several)
    return store.read("snapshots").drop("computed_at_utc", "local_model_version")


@query("stream_features")
def q_stream_features(spark, sf_dir):
    """OP-50: raw rows landing in four arrival waves, each picked up by an
    available-now stream run; the final snapshot table equals the batch one."""
    from merchant_signals.session import temp_path
    from merchant_signals.sources.store import TableStore
    from merchant_signals.streaming.stream import start_feature_stream

    base = temp_path(spark, "stream")
    store = TableStore(spark, base + "/store")
    raw = V.raw(spark, sf_dir).select("source", "payload", "received_at")
    for chunk in _arrival_chunks(raw):
        store.append_raw(chunk)
        q = start_feature_stream(spark, store, base + "/ckpt")
        q.awaitTermination()
    # no model in this run: the score column stays empty
    return store.read("snapshots").drop("computed_at_utc", "local_model_band", "local_model_version",
                                        "local_model_scored_at_utc")


@query("raw_append")
def q_raw_append(spark, sf_dir):
    """OP-01: {source, payload} objects streamed into the raw table; a missing
    source becomes 'HTTP'."""
    from merchant_signals.functions.json import json_text
    from merchant_signals.session import temp_path
    from merchant_signals.sources.store import TableStore
    from merchant_signals.streaming.stream import start_raw_landing

    base = temp_path(spark, "landing")
    r = V.raw(spark, sf_dir)
    objs = r.select(F.when(F.col("raw_id") % 2 == 1, F.lit("API")).alias("source"),
                    F.from_json("payload", "map<string,string>").alias("payload"))
    objs.write.json(base + "/in")
    store = TableStore(spark, base + "/store")
    start_raw_landing(spark, store, base + "/in", base + "/ckpt").awaitTermination()
    out = store.read("raw")
    return out.select("source", json_text("payload", "event_id").alias("event_id"),
                      json_text("payload", "merchant_id").alias("merchant_id"),
                      json_text("payload", "amount_usd").cast("double").alias("amount_usd"))


@query("jsonl_replay")
def q_jsonl_replay(spark, sf_dir):
    """OP-02: a JSONL file of payloads (blank lines skipped) replayed as raw rows."""
    from merchant_signals.functions.json import json_text
    from merchant_signals.session import temp_path
    from merchant_signals.sources.files import replay_file

    path = temp_path(spark, "replay")
    r = V.raw(spark, sf_dir)
    blank = F.get_json_object("payload", "$.merchant_id") == ""
    r.select(F.when(blank, F.lit("   ")).otherwise(F.col("payload")).alias("value")).write.text(path)
    rows = replay_file(spark, path)
    return rows.select("source", json_text("payload", "event_id").alias("event_id"),
                       json_text("payload", "merchant_id").alias("merchant_id"))


@query("raw_events_view")
def q_raw_events_view(spark, sf_dir):
    """OP-14: the raw table registered as ``raw_realtime_events`` with the
    ``raw_events`` alias view; per-source counts through SQL on the alias."""
    V.raw(spark, sf_dir).createOrReplaceTempView("raw_realtime_events")
    spark.sql("CREATE OR REPLACE TEMP VIEW raw_events AS SELECT * FROM raw_realtime_events")
    return spark.sql("""
        SELECT source, count(*) AS raw_rows, min(raw_id) AS min_raw_id, max(raw_id) AS max_raw_id,
               count_if(get_json_object(payload, '$.merchant_id') <> '') AS with_merchant
        FROM raw_events GROUP BY source""")


@query("clone_events")
def q_clone_events(spark, sf_dir):
    """OP-71 + OP-22/23: every raw row cloned with md5-derived ids and a new
    time, then sent again through base64; per merchant the clones and the
    facts they load (a duplicate must add nothing)."""
    from merchant_signals.operators.clone import clone_payloads, via_base64
    from merchant_signals.operators.facts import dedup_first_wins, facts_from_raw
    from merchant_signals.session import temp_table

    r = V.raw(spark, sf_dir)
    at = F.col("received_at") + F.expr("INTERVAL 1 DAY")
    clones = temp_table(clone_payloads(r, at), "clones")  # sent twice and counted: each payload is merged once
    dup = clones.select("template_raw_id", "source", via_base64(F.col("payload")).alias("payload"), "received_at")
    rows = (clones.withColumn("raw_id", F.col("template_raw_id") * 2)
            .unionByName(dup.withColumn("raw_id", F.col("template_raw_id") * 2 + 1))
            .drop("template_raw_id"))
    facts = dedup_first_wins(temp_table(facts_from_raw(rows), "clone-facts"))  # parsed once, read twice
    per_clone = facts.groupBy("merchant_id").agg(F.count(F.lit(1)).alias("facts"))
    sent = (clones.select(F.get_json_object("payload", "$.merchant_id").alias("merchant_id"))
            .filter(F.col("merchant_id") != "").groupBy("merchant_id").agg(F.count(F.lit(1)).alias("clones")))
    return sent.join(per_clone, "merchant_id", "left")


@query("clone_lines")
def q_clone_lines(spark, sf_dir):
    """OP-71: the printed line and the event time of a manual clone of every raw row."""
    from merchant_signals.functions.json import json_text
    from merchant_signals.operators.clone import clone_line, recent_second

    r = V.raw(spark, sf_dir)
    return r.select("raw_id", clone_line(json_text("payload", "event_id"), F.nullif(json_text("payload", "merchant_id"), F.lit("")))
                    .alias("line"), recent_second(F.col("received_at")).alias("event_time_utc"))


@query("stream_window_features")
def q_stream_window_features(spark, sf_dir):
    """OP-50 from typed facts, out of order: the newest week's facts arrive before
    the older ones, one file a micro-batch; each batch recomputes the (merchant,
    bucket) keys that it touches, and the final table equals the batch features."""
    import datetime as dt
    from merchant_signals.session import temp_path
    from merchant_signals.sources import driver
    from merchant_signals.sources.store import TableStore
    from merchant_signals.streaming.stream import start_fact_stream

    base = temp_path(spark, "window_stream")
    facts = V.live_facts(spark, sf_dir)
    store = TableStore(spark, base + "/store")
    t, hi = F.col("event_time_utc"), None
    for k in range(4):
        lo = None if k == 3 else F.lit(driver.NOW - dt.timedelta(days=8 * (k + 1))).cast("timestamp")
        wave = facts.filter((F.lit(True) if hi is None else t < hi) & (F.lit(True) if lo is None else t >= lo))
        wave.write.mode("append").parquet(base + "/in")
        stream = spark.readStream.schema(facts.schema).parquet(base + "/in")
        start_fact_stream(stream, store, base + "/ckpt").awaitTermination()
        hi = lo
    return store.read("snapshots").select("merchant_id", "snapshot_time_utc", "txn_count_15m", "gmv_usd_15m",
                                          "txn_count_1h", "gmv_usd_1h")


@query("stream_state_features")
def q_stream_state_features(spark, sf_dir):
    """OP-50 with state: the newest week's facts are loaded and streamed before the older ones, so that most later rows
    are behind the watermark; those are kept aside and repaired, and the final table equals the batch features."""
    import datetime as dt
    from merchant_signals.session import temp_path
    from merchant_signals.sources import driver
    from merchant_signals.sources.store import TableStore
    from merchant_signals.streaming.stream import append_facts, run_window_stream

    base = temp_path(spark, "state_stream")
    facts = V.live_facts(spark, sf_dir)
    store = TableStore(spark, base + "/store")
    t, hi = F.col("event_time_utc"), None
    for k in range(3):
        lo = None if k == 2 else F.lit(driver.NOW - dt.timedelta(days=10 * (k + 1))).cast("timestamp")
        append_facts(store, facts.filter((F.lit(True) if hi is None else t < hi) & (F.lit(True) if lo is None else t >= lo)))
        run_window_stream(spark, store, base + "/ckpt")
        hi = lo
    return store.read("snapshots").select("merchant_id", "snapshot_time_utc", "txn_count_15m", "gmv_usd_15m",
                                          "txn_count_1h", "gmv_usd_1h")


@query("fact_csv_load")
def q_fact_csv_load(spark, sf_dir):
    """OP-06 + OP-22: the 14-column fact file, with every 7th event a second time
    further down under an earlier time, loaded into the live fact table with insert-ignore on
    event_id (all-or-nothing checks first; the first in the file stays)."""
    from merchant_signals.session import temp_path
    from merchant_signals.sources import driver
    from merchant_signals.sources.files import load_fact_csv, write_csv

    path = temp_path(spark, "fact_csv")
    stage = driver.fact_stage14(V.ensure_session(spark), sf_dir)
    again = stage.filter(F.substring("event_id", 5, 20).cast("long") % 7 == 0).withColumn(
        "event_time_utc", F.col("event_time_utc") - F.expr("INTERVAL 1 DAY"))
    write_csv(stage.unionByName(again), path)
    new, counts = load_fact_csv(spark, path, V.live_facts(spark, sf_dir))
    # label_bad_outcome is NULL on some staged rows; a nullable integer column
    # converts to float in pandas, so it is compared as double on both sides.
    return new.select("event_id", "event_type", "event_time_utc", "merchant_id", "amount_usd",
                      F.col("label_bad_outcome").cast("double").alias("label_bad_outcome"), "source",
                      "payer_id_hash", "merchant_country", "merchant_mcc", "drift_regime_id",
                      *[F.lit(v).cast("long").alias(k) for k, v in counts.items()])


@query("source_allow_list")
def q_source_allow_list(spark, sf_dir):
    """OP-18: raw rows of the sources that increments load, by the allow-list."""
    from merchant_signals.operators.facts import KNOWN_SOURCES, resolve_source

    known = [resolve_source(x) for x in (None, *KNOWN_SOURCES)]
    return (V.raw(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("raw_rows"))
            .withColumn("loaded", F.col("source").isin(known)))


FEATURES_SQL = """
SELECT merchant_id,
       w.end AS snapshot_time_utc,
       CAST(count_if(event_time_utc >= w.end - INTERVAL 15 MINUTES) AS INT) AS txn_count_15m,
       CAST(coalesce(sum(amount_usd) FILTER (WHERE event_time_utc >= w.end - INTERVAL 15 MINUTES), 0)
            AS DECIMAL(18,2)) AS gmv_usd_15m,
       CAST(count(*) AS INT) AS txn_count_1h,
       CAST(coalesce(sum(amount_usd), 0) AS DECIMAL(18,2)) AS gmv_usd_1h
FROM (SELECT merchant_id, event_time_utc, ingested_at_utc, amount_usd,
             window(event_time_utc, '1 hour', '15 minutes') AS w
      FROM fact_payment_events) f
WHERE ingested_at_utc < w.end
GROUP BY merchant_id, w.end
"""


@query("merchant_features_sql")
def q_merchant_features_sql(spark, sf_dir):
    """OP-31 + OP-32 + OP-49 in Spark SQL over the fact table view (same plan
    shape as the DataFrame form: Expand, guard filter, one hash aggregate)."""
    V.live_facts(spark, sf_dir).createOrReplaceTempView("fact_payment_events")
    return spark.sql(FEATURES_SQL)
