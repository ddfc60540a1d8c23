"""One increment of the data product (OP-47), as the scheduler runs it every
15 minutes:

  lag check -> load one raw batch -> recompute the last 6 buckets
  -> (a) export the training set -> train when rows > 0
  -> (b) score the last 6 buckets when a model exists

The reference leaves (a) and (b) unordered; here (a) runs first, so (b)
uses the model trained in the same run.  Nothing runs when no raw row is
pending.  Only one-row control values reach the driver.

Two raw-id positions per source make a run restartable: ``load_position`` moves
when a batch's facts are in, ``watermark`` when everything after it is done.
A run that finds the first ahead of the second finishes that work, with or
without new raw rows; loading a batch again adds nothing (insert-ignore), and
recomputed, exported and scored rows are the same again.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from merchant_signals.operators import facts as facts_op
from merchant_signals.operators import model as model_op
from merchant_signals.operators.features import horizon_bounds, merchant_features
from merchant_signals.operators.labels import scheduled_window, training_dataset
from merchant_signals.operators.mutate import update_columns, upsert_snapshots
from merchant_signals.operators.row_ids import dense_row_id
from merchant_signals.operators.scoring import MODEL_VERSION, persist_scores, risk_score_v1
from merchant_signals.schemas import MODEL_COLUMNS, SNAPSHOT_KEY
from merchant_signals.session import observed, path_exists, release_temp
from merchant_signals.sources.files import export_training_csv, read_csv
from merchant_signals.sources.store import TableStore


def _ts(x: _dt.datetime):
    return F.lit(x).cast("timestamp")


def position(store: TableStore, name: str, source: str) -> int:
    """Raw id up to which ``name`` (watermark or load_position) has come."""
    row = store.read(name).filter(F.col("source") == source).select("last_raw_id").first()
    return int(row[0]) if row else 0


def set_position(store: TableStore, name: str, source: str, raw_id: int) -> None:
    new = store.spark.createDataFrame([(int(raw_id),)], "updated_watermark long")
    store.replace(name, facts_op.advance_watermark(store.read(name), new, source))


def loaded_to(store: TableStore, source: str) -> int:
    return max(position(store, "load_position", source), position(store, "watermark", source))


def load_raw_batch(store: TableStore, source: str, batch_size: int = facts_op.BATCH_SIZE) -> dict:
    """OP-15..17, 22, 23, 33, 35: one ``process_raw_events`` call."""
    last = loaded_to(store, source)
    return _load(store, source, facts_op.incremental_batch(store.read("raw"), source, last, batch_size), last)[0]


def load_pending(store: TableStore, source: str, batch_size: int = facts_op.BATCH_SIZE) -> list[dict]:
    """All pending batches, in passes of 1, 2, 4, ... batches, each a load against the fact table that the one before left:
    the passes grow with the logarithm of the pending rows, and first-wins is by raw id either way.  Returns what
    ``load_raw_batch`` says of each batch; the driver holds a row a batch."""
    last = loaded_to(store, source)
    raw = store.read("raw")
    numbered = dense_row_id(raw.filter((F.col("source") == source) & (F.col("raw_id") > F.lit(last))).select("raw_id"), ["raw_id"], "rn")
    batch_of = store.stage(numbered.groupBy("raw_id").agg(F.min("rn").alias("rn"), F.count(F.lit(1)).alias("rows"))
                           .select("raw_id", "rows", F.floor((F.col("rn") - 1) / batch_size).alias("batch_no")))
    release_temp(store.spark, numbered)
    plan = batch_of.groupBy("batch_no").agg(F.sum("rows").alias("rows"), F.max("raw_id").alias("last")).orderBy("batch_no").collect()
    out, at, width = [], 0, 1
    while at < len(plan):
        part = plan[at:at + width]
        within = (F.col("raw_id") > F.lit(last)) & (F.col("raw_id") <= F.lit(part[-1]["last"]))
        out += _load(store, source, raw.filter((F.col("source") == source) & within), last, part, batch_of.filter(within))
        last, at, width = part[-1]["last"], at + width, width * 2
    store.unstage(batch_of)
    return out


def _load(store: TableStore, source: str, batch: DataFrame, last: int, plan: list | None = None, batch_of: DataFrame | None = None) -> list[dict]:
    """Load the raw rows of one pass; ``plan`` and ``batch_of`` say how they fall into batches if they are several."""
    # the raw rows are read once; counts are observed in the writes
    seen, added = Observation("batch"), Observation("inserted")
    batch = store.stage(batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.max("raw_id").alias("last")))
    # written, so that its size is known: the keys of a small batch are broadcast against the fact table
    typed = store.stage(facts_op.dedup_first_wins(facts_op.facts_from_raw(batch)))
    inserted = store.stage(facts_op.insert_ignore(typed, store.read("facts"), "event_id").select(*facts_op.FACT_COLUMNS)
                           .observe(added, F.count(F.lit(1)).alias("rows")))
    n = observed(seen)
    stats = {"processed_rows": n, "inserted_fact": observed(added), "updated_watermark": int(seen.get["last"]) if n else last}
    if stats["inserted_fact"]:
        store.append("facts", inserted)
    new_dim = facts_op.new_merchants(batch, store.read("dim_merchant"), F.current_timestamp())
    if new_dim.limit(1).count():
        store.append("dim_merchant", new_dim)
    bad = facts_op.rejects(batch).join(store.read("rejects").filter(F.col("raw_id") > F.lit(last)).select("raw_id"), "raw_id", "left_anti")
    if bad.limit(1).count():  # a load that broke off after this point doesn't keep them twice
        store.append("rejects", bad)
    each = [stats]
    if plan and len(plan) > 1:
        facts_in = dict(inserted.select("raw_id").join(batch_of, "raw_id").groupBy("batch_no").count().collect())
        each = [{"processed_rows": r["rows"], "inserted_fact": facts_in.get(r["batch_no"], 0), "updated_watermark": r["last"]} for r in plan]
    store.unstage(batch, typed, inserted)
    set_position(store, "load_position", source, stats["updated_watermark"])
    return each


def recompute_buckets(store: TableStore, lo: _dt.datetime, hi: _dt.datetime, computed_at) -> int:
    """OP-28/31/49 + OP-25: features for buckets lo..hi, upserted."""
    facts = store.read_dates("facts", (lo - _dt.timedelta(hours=1)).date(), hi.date())
    obs = Observation("recomputed")
    src = (risk_score_v1(merchant_features(facts, lo, hi)).withColumn("computed_at_utc", computed_at)
           .observe(obs, F.count(F.lit(1)).alias("rows")))
    current = store.read_dates("snapshots", lo.date(), hi.date())
    # the staged write inside replace_partitions always runs the plan, so the
    # observed count is ready afterwards (no second feature job)
    store.replace_partitions("snapshots", upsert_snapshots(current, src))
    return observed(obs)


def export_and_train(spark: SparkSession, store: TableStore, interval_end: _dt.datetime, now: _dt.datetime,
                     export_path: str, model_path: str) -> dict:
    """OP-08, 36, 12: the scheduled training export, and a model if it has rows."""
    start, end = scheduled_window(interval_end)
    snaps = store.read_dates("snapshots", start.date(), end.date())
    facts = store.read_dates("facts", start.date(), (end + _dt.timedelta(hours=24)).date())
    tset = training_dataset(snaps, facts, _ts(start), _ts(end), _ts(now))
    # The exported row count is observed while the file is written (no second pass).
    obs = Observation("training_export")
    export_training_csv(tset.observe(obs, F.count(F.lit(1)).alias("rows")), export_path)
    out = {"exported_rows": observed(obs)}
    if out["exported_rows"] > 0:
        model_op.save(model_op.train(read_csv(spark, export_path, tset.schema)), model_path)
        out["trained"] = True
    return out


def score_horizon(spark: SparkSession, store: TableStore, lo: _dt.datetime, hi: _dt.datetime, now: _dt.datetime,
                  model_path: str) -> int:
    """OP-20, 26, 56, 57: model columns of the buckets lo..hi."""
    model = model_op.load(spark, model_path)
    touched = store.read_dates("snapshots", lo.date(), hi.date())
    window = touched.filter(F.col("snapshot_time_utc").between(_ts(lo), _ts(hi)))
    scores = persist_scores(window, model, _ts(now), MODEL_VERSION)
    n = window.count()  # before the partitions it reads are replaced
    store.replace_partitions("snapshots", update_columns(touched, scores, SNAPSHOT_KEY, MODEL_COLUMNS))
    return n


def finish_increment(spark: SparkSession, store: TableStore, interval_end: _dt.datetime, source: str,
                     now: _dt.datetime, export_path: str | None = None, model_path: str | None = None) -> dict:
    """Everything after the load; the watermark moves last."""
    lo, hi = horizon_bounds(interval_end)
    out = {"rows_upserted": recompute_buckets(store, lo, hi, _ts(now))}
    model_path = model_path or f"{store.root}/_models/{MODEL_VERSION}"
    export_path = export_path or f"{store.root}/_exports/risk_training_dataset_latest"
    out |= export_and_train(spark, store, interval_end, now, export_path, model_path)
    if path_exists(spark, model_path):
        out["scored_rows"] = score_horizon(spark, store, lo, hi, now, model_path)
    set_position(store, "watermark", source, loaded_to(store, source))
    return out


def _pending(store: TableStore, source: str) -> bool:
    """OP-40: any raw row beyond the load position (a literal, so row groups below it are skipped)."""
    last = loaded_to(store, source)
    rows = store.read("raw").filter((F.col("source") == source) & (F.col("raw_id") > F.lit(last)))
    return rows.limit(1).count() > 0


def _unfinished(store: TableStore, source: str) -> bool:
    return position(store, "load_position", source) > position(store, "watermark", source)


def run_increment(spark: SparkSession, store: TableStore, interval_end: _dt.datetime,
                  source: str | None = None, now: _dt.datetime | None = None,
                  batch_size: int = facts_op.BATCH_SIZE, export_path: str | None = None,
                  model_path: str | None = None) -> dict:
    src = facts_op.resolve_source(source)
    store.recover()
    if _pending(store, src):
        out = {"ran": True, **load_raw_batch(store, src, batch_size)}
    elif _unfinished(store, src):
        out = {"ran": True, "processed_rows": 0, "inserted_fact": 0, "updated_watermark": loaded_to(store, src)}
    else:
        return {"ran": False}
    return out | finish_increment(spark, store, interval_end, src, now or interval_end, export_path, model_path)


def catch_up(spark: SparkSession, store: TableStore, interval_end: _dt.datetime, source: str | None = None,
             now: _dt.datetime | None = None, batch_size: int = facts_op.BATCH_SIZE,
             export_path: str | None = None, model_path: str | None = None) -> dict:
    """After an outage: load every pending batch first, then recompute, export,
    train and score once."""
    src = facts_op.resolve_source(source)
    store.recover()
    batches = []
    while _pending(store, src):
        batches += load_pending(store, src, batch_size)
    if not batches and not _unfinished(store, src):
        return {"ran": False, "batches": []}
    done = finish_increment(spark, store, interval_end, src, now or interval_end, export_path, model_path)
    return {"ran": True, "batches": batches, **done}
