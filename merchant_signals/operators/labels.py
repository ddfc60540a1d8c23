"""Outcome labels over the next 24 hours and the training set (OP-19, 21, 27, 34, 08).

The reference left-joins every snapshot with every fact of the same merchant
in [T, T+24h) and takes ``COALESCE(MAX(COALESCE(label, 0)), 0)``.  Here no
snapshot meets a fact:

1. facts are pre-aggregated to (merchant, 15-minute bin) label maxima -- a
   combinable aggregate, at most 96 rows per merchant and day;
2. snapshot times are 15-minute aligned, so [T, T+24h) covers whole bins: the
   rest of T's day from T on, and the next day before T+24h;
3. a running maximum over the bins of a (merchant, day), backwards and forwards,
   gives both parts; snapshot times stand between the bins as further rows (at
   most 288 rows a key, whatever the volume of the merchant);
4. the two parts fold on the snapshot key and join the snapshots by it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchant_signals.functions.time import floor15, interval, next15
from merchant_signals.schemas import SNAPSHOT_KEY, TRAINING_COLUMNS
from merchant_signals.session import spread

LABELS = ["label_bad_outcome", "label_anomaly", "label_dispute_lost"]


def label_bins(facts: DataFrame) -> DataFrame:
    """(merchant_id, _bin, _day, label maxima) from the fact table."""
    b = facts.select("merchant_id", floor15("event_time_utc").alias("_bin"),
                     *[F.coalesce(F.col(l), F.lit(0)).alias(l) for l in LABELS])
    return (b.groupBy("merchant_id", "_bin").agg(*[F.max(l).alias(l) for l in LABELS])
            .withColumn("_day", F.date_trunc("day", F.col("_bin"))))


def next_24h_labels(snapshots: DataFrame, facts: DataFrame) -> DataFrame:
    """OP-27 + OP-34: ``snapshots`` (unique on merchant_id, snapshot_time_utc)
    with label_*_24h (0 when no fact)."""
    t = F.col("snapshot_time_utc")
    day = F.date_trunc("day", t)
    none = [F.lit(None).cast("int").alias(l) for l in LABELS]
    # each snapshot twice: at T in its own day, and at T + 24h in the next one
    marks = snapshots.select("merchant_id", F.explode(F.array(
        F.struct(day.alias("_day"), t.alias("_at"), F.lit(0).alias("_next")),
        F.struct((day + interval("1 DAY")).alias("_day"), (t + interval("24 HOURS")).alias("_at"), F.lit(1).alias("_next")),
    )).alias("_x")).select("merchant_id", "_x.*", *none)
    bins = label_bins(facts).select("merchant_id", "_day", F.col("_bin").alias("_at"), F.lit(None).cast("int").alias("_next"),
                                    *[F.col(l).cast("int").alias(l) for l in LABELS])
    rows = spread(bins.unionByName(marks).withColumn("_us", F.unix_micros("_at")), "merchant_id", "_day")
    key = Window.partitionBy("merchant_id", "_day")
    later = key.orderBy(F.col("_us").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = key.orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
    seen = rows.select("merchant_id", "_at", "_next", *[
        F.when(F.col("_next") == 0, F.max(l).over(later)).otherwise(F.max(l).over(before)).alias(l) for l in LABELS])
    own = F.when(F.col("_next") == 0, F.col("_at")).otherwise(F.col("_at") - interval("24 HOURS"))
    found = (spread(seen.filter(F.col("_next").isNotNull()).select("merchant_id", own.alias("snapshot_time_utc"), *LABELS), *SNAPSHOT_KEY)
             .groupBy(*SNAPSHOT_KEY).agg(*[F.coalesce(F.max(l), F.lit(0)).cast("int").alias(f"{l}_24h") for l in LABELS]))
    return spread(snapshots, *SNAPSHOT_KEY).join(found, SNAPSHOT_KEY, "left").select(
        *snapshots.columns, *[F.coalesce(f"{l}_24h", F.lit(0)).alias(f"{l}_24h") for l in LABELS])


def mature_snapshots(snapshots: DataFrame, start: Column, end: Column, now: Column) -> DataFrame:
    """OP-19: start <= T < end and T + 24h <= now (all literals, prunable)."""
    t = F.col("snapshot_time_utc")
    return snapshots.filter((t >= start) & (t < end) & (t + interval("24 HOURS") <= now))


def training_dataset(snapshots: DataFrame, facts: DataFrame, start: Column, end: Column,
                     now: Column) -> DataFrame:
    """``export_risk_training_dataset(start, end)``: 12 columns, unordered
    (sinks order by (snapshot_time_utc, merchant_id))."""
    base = mature_snapshots(snapshots, start, end, now).select(*TRAINING_COLUMNS[:9])
    # Every label window [T, T+24h) lies inside [start, end + 24h): only those
    # facts are binned (literal bounds, pushed to the scan).
    t = F.col("event_time_utc")
    near = facts.filter((t >= start) & (t < end + interval("24 HOURS")))
    return next_24h_labels(base, near).select(*TRAINING_COLUMNS)


def scheduled_window(interval_end: _dt.datetime) -> tuple[_dt.datetime, _dt.datetime]:
    """OP-21, scheduled run: [end - 8 days, end - 24 hours)."""
    return interval_end - _dt.timedelta(days=8), interval_end - _dt.timedelta(hours=24)


def history_window(facts: DataFrame, now: Column) -> DataFrame:
    """OP-21, historical seed: one row (snapshot_start_utc, snapshot_end_utc) =
    [max(next15(min event), now - 30d), min(next15(max event), now - 24h))."""
    b = facts.agg(next15(F.min("event_time_utc")).alias("_lo"), next15(F.max("event_time_utc")).alias("_hi"))
    return b.select(F.greatest(F.col("_lo"), now - F.expr("INTERVAL 30 DAYS")).alias("snapshot_start_utc"),
                    F.least(F.col("_hi"), now - interval("24 HOURS")).alias("snapshot_end_utc"))


def training_dataset_history(snapshots: DataFrame, facts: DataFrame, now: Column) -> DataFrame:
    """The seed script's export.  Its bounds are a one-row control value read
    first, so the export itself runs on literal bounds: the snapshot filter and
    the fact range [start, end + 24h) reach the scans, with no extra join."""
    b = history_window(facts, now).first()
    if b is None or b["snapshot_start_utc"] is None:  # no facts: nothing to export
        return snapshots.limit(0).select(*TRAINING_COLUMNS[:9]).select(
            "*", *[F.lit(0).alias(f"{l}_24h") for l in LABELS]).select(*TRAINING_COLUMNS)
    start = F.lit(b["snapshot_start_utc"]).cast("timestamp")
    end = F.lit(b["snapshot_end_utc"]).cast("timestamp")
    return training_dataset(snapshots, facts, start, end, now)
