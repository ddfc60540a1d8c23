"""Point-in-time merchant features (OP-28, 31, 44, 49, 53).

For a bucket time ``T`` (the *exclusive* end of the windows):

  txn_count_15m / gmv_usd_15m : facts with event time in [T-15m, T)
  txn_count_1h  / gmv_usd_1h  : facts with event time in [T-1h,  T)

counting only facts ingested before ``T`` (late-data guard).  A merchant
gets a row for ``T`` when at least one such fact exists.  Sums skip NULL
amounts and are 0 when nothing is summed.

All 15-minute-aligned ``T`` are evaluated in one pass: every fact falls into
exactly four sliding 1-hour windows (``window(ts, '1 hour', '15 minutes')``,
an ``Expand`` in the plan), the guard is a filter, and one hash aggregation on
(merchant, T) produces every snapshot with map-side partial aggregation.  A hot
merchant is spread over its buckets, so no group grows with the data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_signals.functions.time import BUCKET, ceil15, floor15, interval, next15
from merchant_signals.session import spread

HORIZON_BUCKETS = 6


def _aggs(t: Column) -> list[Column]:
    in15 = F.col("event_time_utc") >= t - interval("15 MINUTES")
    return [
        F.count_if(in15).cast("int").alias("txn_count_15m"),
        F.coalesce(F.sum(F.when(in15, F.col("amount_usd"))), F.lit(0))
        .cast("decimal(18,2)").alias("gmv_usd_15m"),
        F.count("event_time_utc").cast("int").alias("txn_count_1h"),
        F.coalesce(F.sum("amount_usd"), F.lit(0)).cast("decimal(18,2)").alias("gmv_usd_1h"),
    ]


def merchant_features(facts: DataFrame, t_min=None, t_max=None,
                      late_guard: bool = True, keys: DataFrame | None = None) -> DataFrame:
    """OP-31 (+ OP-49 guard) for every aligned bucket time, optionally only
    for ``t_min <= T <= t_max`` (literals; they also prune the fact scan).
    keys: only these (merchant_id, snapshot_time_utc), which may repeat; they are marked in the same
    aggregation, so that neither they nor the features are sorted or moved for a join.

    Output: merchant_id, snapshot_time_utc, txn_count_15m, gmv_usd_15m,
    txn_count_1h, gmv_usd_1h."""
    f = facts.select("merchant_id", "event_time_utc", "ingested_at_utc", "amount_usd")
    if t_min is not None:
        f = f.filter(F.col("event_time_utc") >= F.lit(t_min).cast("timestamp") - interval("1 HOUR"))
    if t_max is not None:
        f = f.filter(F.col("event_time_utc") < F.lit(t_max).cast("timestamp"))
    w = f.withColumn("_w", F.window("event_time_utc", "1 hour", "15 minutes"))
    w = w.withColumn("snapshot_time_utc", F.col("_w.end"))
    if t_min is not None:
        w = w.filter(F.col("snapshot_time_utc") >= F.lit(t_min).cast("timestamp"))
    if t_max is not None:
        w = w.filter(F.col("snapshot_time_utc") <= F.lit(t_max).cast("timestamp"))
    if late_guard:
        w = w.filter(F.col("ingested_at_utc") < F.col("snapshot_time_utc"))
    if keys is None:
        return w.groupBy("merchant_id", "snapshot_time_utc").agg(*_aggs(F.col("snapshot_time_utc")))
    # a key is a row without an event, which counts and adds nothing
    cols = ["merchant_id", "snapshot_time_utc", "event_time_utc", "amount_usd"]
    asked = keys.filter(F.col("merchant_id").isNotNull()).select(
        *cols[:2], *[F.lit(None).cast(w.schema[c].dataType).alias(c) for c in cols[2:]], F.lit(True).alias("_asked"))
    both = w.select(*cols, F.lit(False).alias("_asked")).unionByName(asked)
    marked = both.groupBy("merchant_id", "snapshot_time_utc").agg(
        *_aggs(F.col("snapshot_time_utc")), F.max("_asked").alias("_asked"))
    return marked.filter(F.col("_asked") & (F.col("txn_count_1h") > 0)).drop("_asked")


def windowed_features(facts: DataFrame, delay: str) -> DataFrame:
    """OP-31 + OP-49 as a stateful streaming aggregation (OP-50): the same sums, with a watermark of ``delay`` behind the
    newest event time, after which a bucket's state is given up and further rows of it are dropped.  The grouping is on
    the window itself, which carries the watermark."""
    f = facts.select("merchant_id", "event_time_utc", "ingested_at_utc", "amount_usd").withWatermark("event_time_utc", delay)
    w = f.select("*", F.window("event_time_utc", "1 hour", "15 minutes").alias("_w")).filter(F.col("ingested_at_utc") < F.col("_w.end"))
    out = w.groupBy("merchant_id", "_w").agg(*_aggs(F.col("_w.end")))
    return out.select("merchant_id", F.col("_w.end").alias("snapshot_time_utc"), "txn_count_15m", "gmv_usd_15m", "txn_count_1h", "gmv_usd_1h")


def late_excluded(facts: DataFrame) -> DataFrame:
    """OP-49 audit: per (merchant, T) the facts inside [T-1h, T) by event time
    that the ingest guard keeps out (ingested at or after T)."""
    f = facts.select("merchant_id", "event_time_utc", "ingested_at_utc")
    w = (f.withColumn("_w", F.window("event_time_utc", "1 hour", "15 minutes"))
         .withColumn("snapshot_time_utc", F.col("_w.end"))
         .filter(F.col("ingested_at_utc") >= F.col("snapshot_time_utc")))
    return w.groupBy("merchant_id", "snapshot_time_utc").agg(
        F.count(F.lit(1)).cast("int").alias("late_events_1h"),
        F.count_if(F.col("event_time_utc") >= F.col("snapshot_time_utc") - interval("15 MINUTES"))
        .cast("int").alias("late_events_15m"))


def horizon_bounds(interval_end: _dt.datetime, buckets: int = HORIZON_BUCKETS):
    """OP-49/52: the buckets a run recomputes: ceil15(end) and the 5 before."""
    us = int((interval_end - _dt.datetime(1970, 1, 1)).total_seconds() * 1_000_000) - 1
    step = 15 * 60 * 1_000_000
    hi_us = us - (us % step) + step
    hi = _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=hi_us)
    lo = hi - _dt.timedelta(minutes=15 * (buckets - 1))
    return lo, hi


def recompute_horizon(facts: DataFrame, interval_end: _dt.datetime,
                      buckets: int = HORIZON_BUCKETS) -> DataFrame:
    """Features for the last ``buckets`` buckets of a run ending at ``interval_end``."""
    lo, hi = horizon_bounds(interval_end, buckets)
    return merchant_features(facts, lo, hi)


def bucket_series(lo: Column, hi: Column) -> Column:
    """OP-52: ``generate_series(lo, hi, 15 min)`` as an array to explode."""
    return F.sequence(lo, hi, BUCKET())


def backfill_buckets(facts: DataFrame) -> DataFrame:
    """OP-43 + OP-52: buckets next15(min event time) .. next15(max event time).
    One row per 15 minutes of the data's time span."""
    b = facts.agg(next15(F.min("event_time_utc")).alias("lo"),
                  next15(F.max("event_time_utc")).alias("hi"))
    return b.select(F.explode(bucket_series(F.col("lo"), F.col("hi"))).alias("snapshot_time_utc"))


def snapshot_backfill(facts: DataFrame) -> DataFrame:
    """OP-53: snapshots for every bucket in next15(min) .. next15(max).  Trailing
    buckets after next15(max) are not computed (as in the reference)."""
    hi = facts.agg(next15(F.max("event_time_utc")).alias("hi")).first()["hi"]  # one-row control value
    # four groups a fact: a task's share must not follow the file's row groups
    f = facts.select("merchant_id", "event_time_utc", "ingested_at_utc", "amount_usd")
    return merchant_features(spread(f, "merchant_id", F.date_trunc("hour", F.col("event_time_utc"))), t_max=hi)


def features_at_times(facts: DataFrame, times: DataFrame, time_col: str = "snapshot_time_utc") -> DataFrame:
    """OP-28: features at arbitrary (possibly unaligned) times.

    A fact lies in one 15-minute slot; the hour before a time ``T`` touches at
    most five.  Facts and times are equi-joined on the slot and the exact range is
    checked after, so a fact meets only the times of its slot.  The first and last
    time (a one-row control value) bound the fact scan."""
    t = times.select(F.col(time_col).cast("timestamp").alias("_T")).distinct()
    span = t.agg(F.min("_T").alias("lo"), F.max("_T").alias("hi")).first()
    lo, hi = (F.lit(span[k]).cast("timestamp") for k in ("lo", "hi"))
    e = F.col("event_time_utc")
    f = (facts.filter((e >= lo - interval("1 HOUR")) & (e < hi))
         .select("merchant_id", "event_time_utc", "ingested_at_utc", "amount_usd", floor15(e).alias("_slot")))
    first = floor15(F.col("_T") - interval("1 HOUR"))
    last = floor15(F.col("_T") - interval("1 MICROSECOND"))
    slots = t.select("_T", F.explode(F.sequence(first, last, BUCKET())).alias("_slot"))
    j = f.join(slots, "_slot").filter((e >= F.col("_T") - interval("1 HOUR")) & (e < F.col("_T"))
                                      & (F.col("ingested_at_utc") < F.col("_T")))
    return (j.groupBy("merchant_id", F.col("_T").alias("snapshot_time_utc"))
            .agg(*_aggs(F.col("_T"))))


def latest_per_merchant(snapshots: DataFrame, order_col: str = "snapshot_time_utc") -> DataFrame:
    """OP-44: each merchant's newest snapshot (times are unique per merchant):
    a fixed-width max per merchant, then the rows with those times."""
    newest = snapshots.groupBy("merchant_id").agg(F.max(order_col).alias(order_col))
    return snapshots.join(newest, ["merchant_id", order_col], "left_semi")


def merge_latest(latest: DataFrame, changed: DataFrame, order_col: str = "snapshot_time_utc") -> DataFrame:
    """OP-44 kept up: a table of one row per merchant after snapshots changed.  Of a merchant's rows in both the newest
    stays, and the changed one if both have that time.  The changed rows are first cut to each merchant's newest by a
    fixed-width max: rows as values of an aggregate are sorted, so only a row per merchant and table goes there."""
    newest = changed.groupBy("merchant_id").agg(F.max(order_col).alias("_newest")).withColumnRenamed("merchant_id", "_m")
    changed = changed.join(newest, F.col("merchant_id").eqNullSafe(F.col("_m")) & F.col(order_col).eqNullSafe(F.col("_newest")), "left_semi")
    rest = [c for c in latest.columns if c != "merchant_id"]
    both = latest.withColumn("_new", F.lit(0)).unionByName(changed.select(*latest.columns).withColumn("_new", F.lit(1)))
    best = both.groupBy("merchant_id").agg(F.max_by(F.struct(*rest), F.struct(order_col, "_new")).alias("_r"))
    return best.select("merchant_id", "_r.*").select(*latest.columns)


def newest_buckets(snapshots: DataFrame, n: int = 5, time_col: str = "snapshot_time_utc") -> DataFrame:
    """OP-41: rows per bucket for the ``n`` newest buckets that have any.  Looks at
    the last day first and doubles the span until it holds ``n`` buckets or all
    of the history (bounds are literals, so older files aren't read)."""
    ends = snapshots.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).first()
    counts = snapshots.groupBy(time_col).agg(F.count(F.lit(1)).alias("snapshot_rows"))
    if ends["hi"] is not None:
        days = 1
        while True:
            since = ends["hi"] - _dt.timedelta(days=days)
            recent = snapshots.filter(F.col(time_col) > F.lit(since).cast("timestamp"))
            if since < ends["lo"] or recent.select(time_col).distinct().limit(n).count() == n:
                break
            days *= 2
        counts = recent.groupBy(time_col).agg(F.count(F.lit(1)).alias("snapshot_rows"))
    return counts.orderBy(F.col(time_col).desc()).limit(n)


__all__ = [
    "merchant_features", "late_excluded", "horizon_bounds", "recompute_horizon",
    "bucket_series", "backfill_buckets", "snapshot_backfill", "features_at_times",
    "latest_per_merchant", "merge_latest", "newest_buckets", "ceil15",
]
