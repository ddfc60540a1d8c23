"""Shared building blocks of the registered queries: the driver tables mapped
to raw rows, live facts (through the JSON path), historical facts, the
snapshot table and the labelled training set."""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, FloatType, TimestampType

from merchant_signals.operators import facts as facts_op
from merchant_signals.operators.features import latest_per_merchant, merchant_features, snapshot_backfill
from merchant_signals.operators.scoring import risk_score_v1
from merchant_signals.session import ensure_session, fingerprint, path_exists, scratch_path
from merchant_signals.sources import driver


_STORED: dict[tuple, str] = {}
_STORED_LOCK = threading.RLock()


#: The driver tables that the stored tables are made from.
INPUTS = ("events", "customer", "nation")


def _input_key(spark: SparkSession, sf_dir: str) -> tuple:
    files = fingerprint(spark, *[f"{sf_dir.rstrip('/')}/{t}.parquet" for t in INPUTS])
    return (spark.sparkContext.applicationId, sf_dir, files)


def stored(spark: SparkSession, sf_dir: str, name: str, build, day_of: str | None = None) -> DataFrame:
    """A derived table of the data product, written once per application as
    Parquet below the shared checkpoint folder and read back by every later
    query (as the reference keeps raw events, facts, snapshots and the
    training export as stored tables).  Writing it also cuts the lineage.
    day_of: a time column whose rows are kept sorted, so that row groups outside
    a time range are skipped."""
    ensure_session(spark)
    key = (*_input_key(spark, sf_dir), name)
    with _STORED_LOCK:  # one build per table, even with concurrent callers
        path = _STORED.get(key)
        if path is not None and not path_exists(spark, path):
            path = None  # folder removed since: build again
        if path is None:
            path = scratch_path(spark, "tables", name, hashlib.sha1(repr(key).encode()).hexdigest()[:16])
            df = build()
            if day_of:
                df = df.repartitionByRange(F.col(day_of)).sortWithinPartitions(day_of)
            df.write.mode("overwrite").parquet(path)
            _STORED[key] = path
    return spark.read.parquet(path)


def stored_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of a stored table (built on first use)."""
    live = {"raw": raw, "live_facts": live_facts, "live_snapshots": live_snapshots, "live_latest": live_latest, "hist_snapshots": hist_snapshots,
            "training_set": training_set}
    live[name](spark, sf_dir)
    return _STORED[(*_input_key(spark, sf_dir), name)]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw landing table (``raw_realtime_events``) for the driver tables."""
    from merchant_signals.functions.time import to_utc

    t = stored(spark, sf_dir, "raw", lambda: driver.raw_events(spark, sf_dir))
    return t.withColumn("received_at", to_utc("received_at"))


def build_live_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw rows loaded as one batch: validity filter, JSON projection,
    first-wins dedup (same result as the reference's 20,000-row increments,
    because first-wins is by raw_id either way)."""
    return facts_op.first_facts(raw(spark, sf_dir))


def live_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored fact table built from the raw landing table."""
    return stored(spark, sf_dir, "live_facts", lambda: build_live_facts(spark, sf_dir), "event_time_utc")


def live_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored snapshot table of the live facts, which the monitors read."""
    return stored(spark, sf_dir, "live_snapshots", lambda: scored_features(live_facts(spark, sf_dir)), "snapshot_time_utc")


def live_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each merchant's newest snapshot, stored (a store keeps it up itself, see ``TableStore.latest_snapshots``)."""
    return stored(spark, sf_dir, "live_latest", lambda: latest_per_merchant(live_snapshots(spark, sf_dir)))


def hist_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session(spark)
    return driver.historical_facts(spark, sf_dir)


def scored_features(facts: DataFrame, computed_at=None) -> DataFrame:
    """Snapshot rows: features + heuristic + computed_at (a parameter, not now())."""
    return scored(merchant_features(facts), computed_at)


def scored(features: DataFrame, computed_at=None) -> DataFrame:
    at = computed_at if computed_at is not None else driver.now_lit()
    return risk_score_v1(features).withColumn("computed_at_utc", at)


def for_compare(df: DataFrame, digits: int = 6) -> DataFrame:
    """Output convention shared with the oracles: decimals as double,
    timestamps as timestamp_ntz, doubles rounded to ``digits`` places."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def hist_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored snapshot table of the historical seed: the backfill's buckets (OP-53)."""
    return stored(spark, sf_dir, "hist_snapshots", lambda: scored(snapshot_backfill(hist_facts(spark, sf_dir))),
                  "snapshot_time_utc")


def build_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled training set of the historical seed (history window rule),
    from the stored snapshot table."""
    from merchant_signals.operators.labels import training_dataset_history

    return training_dataset_history(hist_snapshots(spark, sf_dir), hist_facts(spark, sf_dir), driver.now_lit())


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored training export (what the trainer, scorer and backtest read)."""
    return stored(spark, sf_dir, "training_set", lambda: build_training_set(spark, sf_dir))


def snapshot_table(facts: DataFrame, computed_at=None) -> DataFrame:
    """Snapshot rows with the (empty) model columns, in table column order."""
    return with_model_columns(scored_features(facts, computed_at))


def with_model_columns(t: DataFrame) -> DataFrame:
    from merchant_signals.schemas import MODEL_COLUMNS, SNAPSHOT_COLUMNS

    types = {"local_model_score": "decimal(6,5)", "local_model_band": "string",
             "local_model_version": "string", "local_model_scored_at_utc": "timestamp"}
    for c in MODEL_COLUMNS:
        t = t.withColumn(c, F.lit(None).cast(types[c]))
    return t.select(*SNAPSHOT_COLUMNS)
