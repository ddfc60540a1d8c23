"""Streaming twins of the increment (OP-01, 02, 50).

The raw landing table is the stream source.  Each micro-batch runs the
reference's increment on exactly its new rows inside ``foreachBatch``:

  facts     <- insert-ignore(first-wins(typed(valid(batch))))      (OP-16/17/22/23)
  snapshots <- recompute the (merchant, bucket) keys that the batch's facts
               touch, from the fact table                          (OP-31/25)
  watermark <- max raw id of the batch, last                       (OP-48)

Every step is idempotent, and the keys to recompute come from the batch itself,
not from what it happened to insert: a micro-batch replayed after a loss at any
point leaves the same tables.  Rows may arrive in any order and however late;
no state store is kept, so nothing is dropped behind an event-time watermark.
Dedup state is the fact table itself: ``dropDuplicates`` would grow forever and
the watermark variant would drop the reference's "forever" key.

Run it as ``trigger(availableNow=True)`` on the scheduler's 15-minute
cadence, or with ``processingTime`` for continuous upkeep.

``run_window_stream`` is the form with state: sliding windows under a watermark over
the fact table, in update mode, so that a batch costs its own rows and not the history of
its keys.  The engine drops rows behind its watermark without a word; ``append_facts``
therefore keeps the keys of all that it may drop (``late``), and each run ends by
recomputing those from the fact table.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from merchant_signals import schemas as S
from merchant_signals.operators import facts as facts_op
from merchant_signals.operators.features import merchant_features, windowed_features
from merchant_signals.operators.mutate import upsert_snapshots
from merchant_signals.operators.scoring import risk_score_v1
from merchant_signals.session import delete_path, list_names, observed
from merchant_signals.sources.files import REPLAY_SOURCE, raw_rows, replay_lines
from merchant_signals.sources.store import TableStore

RAW_JSON_SCHEMA = "source string, payload string"


def raw_table_stream(spark: SparkSession, store: TableStore, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(S.RAW)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(store.path("raw"))


def touched_keys(facts: DataFrame) -> DataFrame:
    """(merchant_id, snapshot_time_utc) of the four buckets whose hour each fact lies in; facts of a bucket repeat it."""
    return (facts.select("merchant_id", F.window("event_time_utc", "1 hour", "15 minutes").alias("_w"))
            .select("merchant_id", F.col("_w.end").alias("snapshot_time_utc")))


def process_facts(store: TableStore, typed: DataFrame) -> dict:
    """Insert a batch of typed facts and refresh the buckets they touch.  Only the
    days that hold touched buckets are read and rewritten."""
    store.recover()
    typed = store.stage(typed.select(*S.FACT_COLUMNS))
    # the keys that are there already, written: if they are few, their known size lets the batch stay where it is
    there = store.stage(store.read("facts").select("event_id").join(typed.select("event_id"), "event_id", "left_semi"))
    added = Observation("inserted")
    new = facts_op.insert_ignore(typed, there, "event_id")
    store.append("facts", new.observe(added, F.count(F.lit(1)).alias("rows")))
    out = {"inserted_fact": observed(added), "rows_upserted": recompute_keys(store, touched_keys(typed))}
    store.unstage(typed, there)
    return out


def _days(rows: DataFrame) -> set[_dt.date]:
    """One value per day of the rows' time span."""
    return {r["d"] for r in rows.select(F.to_date("snapshot_time_utc").alias("d")).distinct().collect()}


def _upsert(store: TableStore, features: DataFrame, days: set[_dt.date]) -> int:
    obs = Observation("touched")
    src = (risk_score_v1(features).withColumn("computed_at_utc", F.current_timestamp())
           .observe(obs, F.count(F.lit(1)).alias("rows")))
    store.replace_partitions("snapshots", upsert_snapshots(store.read_days("snapshots", days), src))
    return observed(obs)


def recompute_keys(store: TableStore, keys: DataFrame) -> int:
    """Features of (merchant_id, snapshot_time_utc) keys, which come from a written table and may repeat, from the fact
    table; reads and rewrites only their days."""
    days = _days(keys)
    if not days:
        return 0
    near = store.read_days("facts", days | {d - _dt.timedelta(days=1) for d in days})
    near = near.join(keys.select("merchant_id").distinct(), "merchant_id", "left_semi")
    return _upsert(store, merchant_features(near, keys=keys), days)


def process_batch(store: TableStore, batch: DataFrame, source: str | None = None) -> dict:
    """Load one micro-batch of raw rows, refresh the touched buckets, move the watermark."""
    b = batch.select(*[f.name for f in S.RAW.fields])
    # OP-18: one known source, as the increment loads it; all known ones if none is named
    known = [facts_op.resolve_source(source)] if source else list(facts_op.KNOWN_SOURCES)
    b = store.stage(facts_op.parsed(b.filter(F.col("source").isin(known))))
    out = process_facts(store, facts_op.dedup_first_wins(facts_op.facts_from_raw(b)))
    new_dim = facts_op.new_merchants(b, store.read("dim_merchant"), F.current_timestamp())  # OP-33
    if new_dim.limit(1).count():
        store.append("dim_merchant", new_dim)
    hi_ids = b.groupBy("source").agg(F.max("raw_id").alias("last_raw_id"))
    store.replace("watermark", store.read("watermark").unionByName(hi_ids)
                  .groupBy("source").agg(F.max("last_raw_id").alias("last_raw_id")))
    store.unstage(b)
    return out


def start_feature_stream(spark: SparkSession, store: TableStore, checkpoint_location: str,
                         available_now: bool = True, processing_time: str | None = None,
                         source: str | None = None, max_files_per_trigger: int | None = None):
    """OP-50: keep facts and snapshots current from the raw landing table."""
    q = (raw_table_stream(spark, store, max_files_per_trigger).writeStream
         .option("checkpointLocation", checkpoint_location)
         .foreachBatch(lambda df, _batch_id: process_batch(store, df, source)))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime=processing_time or "15 minutes")
    return q.start()


def _landing(store: TableStore, stream: DataFrame, checkpoint_location: str, available_now: bool, every: str):
    """Each micro-batch is a landing named after the stream (the id in its checkpoint) and the batch: replayed, it lands once."""
    named: list[str] = []

    def land(df: DataFrame, batch_id: int) -> None:
        if not named:
            noted = store.spark.read.text(f"{checkpoint_location.rstrip('/')}/metadata").first()["value"]
            named.append(json.loads(noted)["id"])
        store.append_raw(df, key=f"{named[0]}.{batch_id}")

    q = stream.writeStream.option("checkpointLocation", checkpoint_location).foreachBatch(land)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime=every)
    return q.start()


def start_raw_landing(spark: SparkSession, store: TableStore, json_dir: str, checkpoint_location: str,
                      available_now: bool = True):
    """OP-01: ``{source, payload}`` JSON objects from a folder appended to the
    raw table (default source 'HTTP', received_at = arrival time, dense ids).  A line that is no such object is
    refused as a whole, with itself as the payload; a payload that is no object is refused with its source."""
    lines = spark.readStream.text(json_dir).filter(F.trim("value") != "")
    line = F.from_json("value", RAW_JSON_SCHEMA + ", _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    whole = F.when(F.ltrim("value").startswith("{"), line)
    told = lines.select("value", whole.alias("o")).select(
        F.col("o.source").alias("source"), F.when(F.col("o").isNull() | F.col("o._broken").isNotNull(), F.col("value"))
        .otherwise(F.col("o.payload")).alias("payload"))
    return _landing(store, raw_rows(told), checkpoint_location, available_now, "1 minute")


def start_replay(spark: SparkSession, store: TableStore, jsonl_dir: str, checkpoint_location: str, source: str = REPLAY_SOURCE,
                 max_files: int | None = None, max_bytes: str | None = None, available_now: bool = True,
                 every: str = "1 minute"):
    """OP-02 as a throttled stream: a trigger lands at most ``max_files`` files (or about ``max_bytes``) of payload lines; it goes on
    from the checkpoint's offsets."""
    r = spark.readStream
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    return _landing(store, replay_lines(r.text(jsonl_dir), source), checkpoint_location, available_now, every)


def start_fact_stream(facts_stream: DataFrame, store: TableStore, checkpoint_location: str,
                      available_now: bool = True):
    """OP-50 from typed facts: each micro-batch is inserted and its touched
    (merchant, bucket) keys are recomputed from the fact table, so files may come
    in any order."""
    q = (facts_stream.writeStream.option("checkpointLocation", checkpoint_location)
         .foreachBatch(lambda df, _batch_id: process_facts(store, facts_op.dedup_first_wins(df))))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="15 minutes")
    return q.start()


# ---- the stateful form (OP-50) -------------------------------------------------------

#: How long a bucket's state is kept behind the newest event time.
WATERMARK_MINUTES = 60


def append_facts(store: TableStore, rows: DataFrame, minutes: int = WATERMARK_MINUTES) -> dict:
    """Insert facts, and keep under ``late`` the keys of those that the stateful stream may drop.

    The clock is the newest event time of this load and all before.  The file source reads older files first, so no
    file of this load meets a watermark above ``clock - minutes``: a row whose last window ends after that is never
    dropped, and all others are kept (a few more than the engine drops).  The clock moves first, late keys are written
    next, facts last: a load that broke off and runs again keeps its keys twice, which changes nothing."""
    store.recover()
    typed = store.stage(facts_op.dedup_first_wins(rows.select(*S.FACT_COLUMNS)))
    new = store.stage(facts_op.insert_ignore(typed, store.read("facts"), "event_id").select(*S.FACT_COLUMNS))
    clock = store.read("fact_clock").select("newest").unionByName(new.select(F.col("event_time_utc").alias("newest")))
    newest = clock.agg(F.max("newest").alias("m")).first()["m"]  # a one-row control value
    out = {"inserted_fact": 0, "late_facts": 0}
    if newest is not None:
        store.replace("fact_clock", store.spark.createDataFrame([(newest,)], "newest timestamp"))
        bound = F.lit(newest - _dt.timedelta(minutes=minutes)).cast("timestamp")
        seen, behind = Observation("facts"), Observation("late")
        # the first of the four windows ends at most an hour before the last: any of them may be behind
        first_end = F.window("event_time_utc", "15 minutes").getField("end")
        late = new.withColumn("_end", first_end).filter(F.col("_end") <= bound)
        store.append("late", late.select(F.lit(uuid.uuid4().hex).alias("load"), "merchant_id", "event_time_utc")
                     .observe(behind, F.count(F.lit(1)).alias("rows")))
        store.append("facts", new.observe(seen, F.count(F.lit(1)).alias("rows")))
        out = {"inserted_fact": observed(seen), "late_facts": observed(behind)}
    store.unstage(typed, new)
    return out


def run_window_stream(spark: SparkSession, store: TableStore, checkpoint_location: str, minutes: int = WATERMARK_MINUTES,
                      max_files_per_trigger: int | None = None) -> dict:
    """OP-50 with state: all facts that have come since the last run, then the late keys that stood there before it.

    A batch upserts the buckets that it changed, which a replay repeats.  A late key is recomputed only after the
    stream has passed its rows: state of that bucket, if there was any, was given up before one of them was dropped, so
    nothing overwrites the recomputed row with a partial one.  ``minutes`` must not be less than that of the loads."""
    store.recover()
    loads = [n for n in list_names(spark, store.path("late")) if n.startswith("load=")]
    r = spark.readStream.schema(store._full_schema("facts"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    upserted = []

    def upsert(df: DataFrame, _batch_id: int) -> None:
        store.recover()
        changed = store.stage(df)
        if days := _days(changed):
            upserted.append(_upsert(store, changed, days))
        store.unstage(changed)

    q = (windowed_features(r.parquet(store.path("facts")), f"{minutes} minutes").writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint_location).foreachBatch(upsert).trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = sum(int(o["numRowsDroppedByWatermark"]) for p in q.recentProgress for o in p["stateOperators"])
    repaired = 0
    if loads:
        late = spark.read.schema("merchant_id string, event_time_utc timestamp").parquet(*[f"{store.path('late')}/{n}" for n in loads])
        repaired = recompute_keys(store, touched_keys(late))
        for n in loads:
            delete_path(spark, f"{store.path('late')}/{n}")
    return {"rows_upserted": sum(upserted), "dropped": dropped, "rows_repaired": repaired}
