"""Event and merchant enrichment (OP-30, 39, 61-70).

The deterministic column logic of the reference's data generators, as
column expressions.  Money arithmetic is done in DECIMAL so rounding is
exact (half away from zero), as NUMERIC is in the reference.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed values ----------------------------------------------------------
EVENT_TYPES = [
    "CHECKOUT.ORDER.APPROVED",
    "PAYMENT.AUTHORIZATION.CREATED",
    "PAYMENT.AUTHORIZATION.VOIDED",
    "PAYMENT.CAPTURE.COMPLETED",
    "PAYMENT.CAPTURE.DENIED",
    "PAYMENT.CAPTURE.REFUNDED",
    "CUSTOMER.DISPUTE.CREATED",
    "CUSTOMER.DISPUTE.RESOLVED",
    "PAYOUTS.PAYOUT.COMPLETED",
]
STATUS_BY_TYPE = {
    "PAYMENT.CAPTURE.COMPLETED": "COMPLETED",
    "PAYMENT.CAPTURE.DENIED": "DENIED",
    "PAYMENT.CAPTURE.REFUNDED": "REFUNDED",
    "CHECKOUT.ORDER.APPROVED": "APPROVED",
    "PAYMENT.AUTHORIZATION.CREATED": "AUTHORIZED",
    "PAYMENT.AUTHORIZATION.VOIDED": "VOIDED",
    "CUSTOMER.DISPUTE.CREATED": "DISPUTE_OPEN",
    "CUSTOMER.DISPUTE.RESOLVED": "DISPUTE_CLOSED",
    "PAYOUTS.PAYOUT.COMPLETED": "PAID_OUT",
}
UNKNOWN_STATUS = "UNKNOWN"
REFUND_TYPES = ["PAYMENT.CAPTURE.REFUNDED"]
DISPUTE_TYPES = ["CUSTOMER.DISPUTE.CREATED", "CUSTOMER.DISPUTE.RESOLVED"]
DENIED_TYPES = ["PAYMENT.CAPTURE.DENIED"]
ID_TYPES = {
    "authorization_id": ("aut_", ["PAYMENT.AUTHORIZATION.CREATED", "PAYMENT.AUTHORIZATION.VOIDED"]),
    "capture_id": ("cap_", ["PAYMENT.CAPTURE.COMPLETED", "PAYMENT.CAPTURE.DENIED", "PAYMENT.CAPTURE.REFUNDED"]),
    "refund_id": ("rfd_", ["PAYMENT.CAPTURE.REFUNDED"]),
    "dispute_id": ("dsp_", ["CUSTOMER.DISPUTE.CREATED", "CUSTOMER.DISPUTE.RESOLVED"]),
    "payout_id": ("pyo_", ["PAYOUTS.PAYOUT.COMPLETED"]),
}
FX_TO_USD = {"USD": "1.0", "CAD": "0.74", "GBP": "1.27", "EUR": "1.09"}
FX_OTHER = "0.66"
CURRENCIES = ["USD", "CAD", "GBP", "EUR", "AUD"]
FEE_BASE = {"ENTERPRISE": "0.022", "MID_MARKET": "0.025"}
FEE_BASE_OTHER = "0.029"
FEE_RISK = {"HIGH": "0.006", "MEDIUM": "0.002"}
FEE_RISK_OTHER = "0.0"
FEE_RATE_MIN, FEE_RATE_MAX = "0.015", "0.07"
FIXED_FEE_USD, FIXED_FEE_OTHER = "0.30", "0.35"
DISPUTE_FEE_SHARE = "0.2"
RESERVE_BY_TIER = {"HIGH": "0.07", "MEDIUM": "0.03"}
RESERVE_OTHER = "0.0"
MCC_INDUSTRY = {
    "5411": "Grocery Stores",
    "5812": "Eating Places/Restaurants",
    "5732": "Electronics Stores",
    "5999": "Misc Retail",
    "7011": "Lodging/Hotels",
    "4111": "Transport",
    "4900": "Utilities",
}
US_STATES = ["NY", "CA", "TX", "FL", "IL", "WA", "MA", "NJ", "PA", "GA", "NC", "VA", "AZ", "CO", "MI"]
HASH_PREFIX = {"payer_id_hash": "payer|", "device_id_hash": "dev|", "ip_hash": "ip|"}
ANOMALY_QUANTILE = 0.997
ANOMALY_RECENT_DAYS = 14
DRIFT_DAYS_DEFAULT = 45


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(mapping: dict, key: Column, default, dtype: str | None = None) -> Column:
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.coalesce(m[key], F.lit(default))
    return v.cast(dtype) if dtype else v


def status_of(event_type: Column | str) -> Column:
    """OP-61."""
    return _lookup(STATUS_BY_TYPE, _c(event_type), UNKNOWN_STATUS)


def event_flags(df: DataFrame, event_type: str = "event_type",
                refund_amount: str | None = "refund_amount") -> DataFrame:
    """OP-62: is_refund / is_dispute / is_denied and label_bad_outcome.  The
    label tests ``refund_amount > 0`` when that column is given, else the
    refund flag."""
    t = F.col(event_type)
    out = df.select("*", t.isin(REFUND_TYPES).alias("is_refund"), t.isin(DISPUTE_TYPES).alias("is_dispute"),
                    t.isin(DENIED_TYPES).alias("is_denied"))
    refund = (F.col(refund_amount) > 0) if refund_amount else F.col("is_refund")
    return out.withColumn("label_bad_outcome",
                          (F.col("is_denied") | F.col("is_dispute") | F.coalesce(refund, F.lit(False))).cast("int"))


def conditional_ids(df: DataFrame, base_id: Column, event_type: str = "event_type") -> DataFrame:
    """OP-63: id columns only for their event types, else NULL."""
    t = F.col(event_type)
    return df.select("*", *[F.when(t.isin(types), F.concat(F.lit(prefix), base_id)).alias(name)
                            for name, (prefix, types) in ID_TYPES.items()])


def fx_normalise(df: DataFrame, amount: str = "amount", currency: str = "currency") -> DataFrame:
    """OP-64: fx_rate_to_usd by currency (other currencies 0.66) and
    amount_usd = round(amount * fx, 2); ``amount_usd_exact`` keeps the
    unrounded product, which fees, refunds and net amounts are computed from."""
    fx = _lookup(FX_TO_USD, F.col(currency), FX_OTHER, "decimal(9,4)")
    exact = F.col(amount).cast("decimal(18,2)") * F.col("fx_rate_to_usd")
    return (df.withColumn("fx_rate_to_usd", fx)
            .withColumn("amount_usd_exact", exact)
            .withColumn("amount_usd", F.round(F.col("amount_usd_exact"), 2).cast("decimal(18,2)")))


def fees_net(df: DataFrame, noise: Column | None = None) -> DataFrame:
    """OP-65: fee rate = base(segment) + risk(tier) [+ noise], clipped to
    [0.015, 0.07]; fee = round(usd * rate + fixed, 2) with fixed 0.30 for USD
    else 0.35; net = round(usd - fee - refund - 0.2 * dispute_fee, 2), with
    ``usd`` the unrounded USD amount when present."""
    rate = (_lookup(FEE_BASE, F.col("merchant_segment"), FEE_BASE_OTHER, "decimal(9,4)")
            + _lookup(FEE_RISK, F.col("risk_tier"), FEE_RISK_OTHER, "decimal(9,4)"))
    if noise is not None:
        rate = rate + noise.cast("decimal(9,4)")
    rate = F.least(F.greatest(rate, F.lit(FEE_RATE_MIN).cast("decimal(9,4)")), F.lit(FEE_RATE_MAX).cast("decimal(9,4)"))
    fixed = F.when(F.col("currency") == "USD", F.lit(FIXED_FEE_USD)).otherwise(F.lit(FIXED_FEE_OTHER)).cast("decimal(18,2)")
    usd = (F.col("amount_usd_exact") if "amount_usd_exact" in df.columns else F.col("amount_usd")).cast("decimal(24,6)")
    out = df.withColumn("fee_rate", rate.cast("decimal(9,4)"))
    out = out.withColumn("fee_amount", F.round(usd * F.col("fee_rate") + fixed, 2).cast("decimal(18,2)"))
    net = (usd - F.col("fee_amount") - F.col("refund_amount").cast("decimal(18,2)")
           - F.lit(DISPUTE_FEE_SHARE).cast("decimal(9,4)") * F.col("dispute_fee").cast("decimal(18,2)"))
    return out.withColumn("net_amount", F.round(net, 2).cast("decimal(18,2)"))


def settlement_times(df: DataFrame, settlement_lag: str = "settlement_lag_hours",
                     payout_lag: str = "payout_lag_hours") -> DataFrame:
    """OP-66: for COMPLETED events event_time + lag hours; otherwise NULL
    times and NULL lags."""
    done = F.col("status") == "COMPLETED"

    def plus(lag: str) -> Column:
        return F.col("event_time_utc") + F.make_dt_interval(F.lit(0), F.col(lag).cast("int"))

    return (df.withColumn(settlement_lag, F.when(done, F.col(settlement_lag).cast("double")))
            .withColumn(payout_lag, F.when(done, F.col(payout_lag).cast("double")))
            .withColumn("settlement_time_utc", F.when(done, plus(settlement_lag)))
            .withColumn("payout_time_utc", F.when(done, plus(payout_lag))))


def cross_border(payer_country: Column | str, merchant_country: Column | str) -> Column:
    """OP-67."""
    return _c(payer_country) != _c(merchant_country)


def drift_regime(event_time: Column | str, ref: Column, days: int = DRIFT_DAYS_DEFAULT) -> Column:
    """OP-68: 1 from ``ref - days`` on, else 0."""
    return (_c(event_time) >= ref - F.make_dt_interval(F.lit(days))).cast("int")


def pseudonymise(prefix: str, value: Column | str) -> Column:
    """OP-69: sha256_hex(prefix || id)."""
    return F.sha2(F.concat(F.lit(prefix), _c(value).cast("string")), 256)


def merchant_policy(dim: DataFrame, state_pick: Column | None = None) -> DataFrame:
    """OP-70: processor fee by segment, reserve by risk tier, industry by MCC,
    state only for US merchants (``state_pick`` chooses among US states)."""
    out = (dim.withColumn("processor_fee_rate",
                          _lookup(FEE_BASE, F.col("merchant_segment"), FEE_BASE_OTHER, "decimal(9,4)"))
           .withColumn("reserve_rate", _lookup(RESERVE_BY_TIER, F.col("risk_tier"), RESERVE_OTHER, "decimal(9,4)"))
           .withColumn("industry_name", F.create_map(*[F.lit(x) for kv in MCC_INDUSTRY.items() for x in kv])
                       [F.col("mcc")]))
    if state_pick is not None:
        states = F.array(*[F.lit(s) for s in US_STATES])
        out = out.withColumn("state", F.when(F.col("country") == "US",
                                             F.element_at(states, (F.pmod(state_pick, F.lit(len(US_STATES))) + 1).cast("int"))))
    return out


def enrich_with_merchant(facts: DataFrame, dim: DataFrame,
                         columns: tuple[str, ...] = ("merchant_segment", "risk_tier", "mcc", "country")) -> DataFrame:
    """OP-30: attribute lookup by merchant.  Whether the dimension is broadcast is
    decided from its real size (``spark.sql.autoBroadcastJoinThreshold``, adaptive
    execution)."""
    return facts.join(dim.select("merchant_id", *columns), "merchant_id", "left")


#: Values that a percentile's last step may sort, and the accuracy of the sketch that narrows the range to them.
SORT_AT_MOST, SKETCH_ACCURACY = 100_000, 10_000


def exact_percentile(values: DataFrame, col: str, q: float) -> float | None:
    """Exact, interpolating quantile (``percentile_cont``), a one-number control value.

    A quantile sketch brackets the two neighbouring ranks; rows below the bracket
    are counted and the bracket is narrowed again (its bounds reach the scan)
    until few distinct values are left.  Those are counted, not sorted row by row,
    so a value that a third of all rows share is one row."""
    v = values.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    n = v.count()
    if not n:
        return None
    pos = q * (n - 1)
    ranks = (math.floor(pos), math.ceil(pos))
    part, below, size = v, 0, n
    while size > SORT_AT_MOST:
        margin = 3 / SKETCH_ACCURACY
        ps = [max(0.0, (ranks[0] - below) / size - margin), min(1.0, (ranks[1] - below) / size + margin)]
        lo, hi = part.agg(F.percentile_approx("v", ps, SKETCH_ACCURACY).alias("p")).first()["p"]
        inner = part.filter((F.col("v") >= lo) & (F.col("v") <= hi))
        c = part.agg(F.count_if(F.col("v") < lo).alias("under"),
                     F.count_if((F.col("v") >= lo) & (F.col("v") <= hi)).alias("inside")).first()
        if not below + c["under"] <= ranks[0] or not ranks[1] < below + c["under"] + c["inside"] or c["inside"] == size:
            break
        part, below, size = inner, below + c["under"], c["inside"]
    # distinct values of the bracket, with the rank behind each
    counted = part.groupBy("v").count()
    run = counted.select("v", (F.sum("count").over(Window.orderBy("v")) + F.lit(below)).alias("upto"))
    low, high = (run.filter(F.col("upto") > F.lit(r)).agg(F.min("v").alias("v")).first()["v"] for r in ranks)
    return low + (high - low) * (pos - ranks[0])


def anomaly_flag(df: DataFrame, amount: str, event_time: str, ref: Column,
                 q: float = ANOMALY_QUANTILE, recent_days: int = ANOMALY_RECENT_DAYS) -> DataFrame:
    """OP-39: label_anomaly = 1 for events of the last ``recent_days`` before
    ``ref`` whose amount exceeds that period's q-quantile ``p``; 0 otherwise."""
    recent = F.col(event_time) >= ref - F.make_dt_interval(F.lit(recent_days))
    p = exact_percentile(df.filter(recent), amount, q)
    over = F.lit(False) if p is None else F.coalesce(F.col(amount).cast("double") > F.lit(p), F.lit(False))
    return (df.withColumn("p", F.lit(p).cast("double"))
            .withColumn("label_anomaly", (recent & over).cast("int")))
