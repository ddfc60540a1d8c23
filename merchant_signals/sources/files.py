"""File sources and sinks (OP-01, 02, 05-08, 10, 11).

CSV follows PostgreSQL ``COPY ... CSV``: an unquoted empty field is NULL, a
quoted ``""`` is an empty string.  Spark reads both as NULL by default; the
``nullValue``/``emptyValue`` options below keep them apart.  Timestamps are
written and read with microseconds and an offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from merchant_signals.functions.json import checked_json
from merchant_signals.schemas import DIM_CSV22, FACT, FACT_COLUMNS, FACT_CSV14, TRAINING_COLUMNS
from merchant_signals.session import observed, release_temp, temp_table

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
DEFAULT_RAW_SOURCE = "HTTP"
REPLAY_SOURCE = "SYNTH_STREAM"

_CSV_READ = {"header": "true", "enforceSchema": "true", "mode": "FAILFAST",
             "timestampFormat": TS_FORMAT, "nullValue": "\\N", "emptyValue": ""}
_CSV_WRITE = {"header": "true", "timestampFormat": TS_FORMAT, "emptyValue": '""', "nullValue": ""}


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Positional, typed CSV read: the header line is skipped without a name
    check (``enforceSchema``) and any malformed row fails the load."""
    r = spark.read
    for k, v in _CSV_READ.items():
        r = r.option(k, v)
    return r.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, order_by: list[str] | None = None) -> None:
    w = df.orderBy(*order_by) if order_by else df
    w = w.write.mode("overwrite")
    for k, v in _CSV_WRITE.items():
        w = w.option(k, v)
    w.csv(path)


def read_fact_csv14(spark: SparkSession, path: str) -> DataFrame:
    """OP-06 / OP-07 input: the 14 named positional fact columns."""
    return read_csv(spark, path, FACT_CSV14)


def file_order(rows: DataFrame) -> DataFrame:
    """Rows read from files, with ``_at``: their place by file name, split and place in the split.  To be used on the
    read itself: a split is read by one task, in its order."""
    return rows.select("*", F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                                     F.monotonically_increasing_id().alias("i")).alias("_at"))


def read_dim_csv22(spark: SparkSession, path: str) -> DataFrame:
    """OP-05 input: the 22 positional merchant columns."""
    return read_csv(spark, path, DIM_CSV22)


def export_training_csv(df: DataFrame, path: str) -> None:
    """OP-08: 12 named columns with a header, ordered by (snapshot, merchant),
    overwriting the 'latest' export (a directory of part files)."""
    write_csv(df.select(*TRAINING_COLUMNS), path, ["snapshot_time_utc", "merchant_id"])


def export_table(df: DataFrame, path: str, fmt: str = "parquet",
                 partition_by: list[str] | None = None) -> None:
    """OP-10: table export to CSV or Parquet, optionally partitioned."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        for k, v in _CSV_WRITE.items():
            w = w.option(k, v)
        w.csv(path)
    else:
        w.parquet(path)


def realtime_tail(facts: DataFrame, ref: Column, minutes: int = 60) -> DataFrame:
    """OP-11: events of the last ``minutes`` before ``ref``, in event-time order."""
    return (facts.filter(F.col("event_time_utc") >= ref - F.expr(f"INTERVAL {minutes} MINUTES"))
            .orderBy("event_time_utc"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines with ISO-8601 UTC times."""
    df.write.mode("overwrite").option("timestampFormat", TS_FORMAT).json(path)


def raw_rows(payloads: DataFrame, received_at: Column | None = None,
             source: Column | None = None) -> DataFrame:
    """OP-01: wrap ``{source, payload}`` objects (payload a struct, map or JSON
    text) into raw rows; default source 'HTTP'; stamp ``received_at``.
    ``raw_id`` is assigned by the store (``sources.store.append_raw``)."""
    p = payloads.schema["payload"].dataType.simpleString()
    payload = F.col("payload") if p == "string" else F.to_json(F.col("payload"))
    src = F.coalesce(F.col("source") if "source" in payloads.columns else F.lit(None).cast("string"),
                     F.lit(DEFAULT_RAW_SOURCE)) if source is None else source
    return payloads.select(src.alias("source"), payload.alias("payload"),
                           (received_at if received_at is not None else F.current_timestamp())
                           .alias("received_at"))


def replay_lines(lines: DataFrame, source: str = REPLAY_SOURCE,
                 received_at: Column | None = None) -> DataFrame:
    """OP-02: each non-blank line of a JSONL file is one payload tagged with
    ``source``; a line that isn't JSON fails the replay, and the landing refuses one
    that is no object.  Works on a batch and on a stream (which throttles with ``maxFilesPerTrigger``)."""
    text = F.trim(F.col("value"))
    return lines.filter(text != "").select(
        F.lit(source).alias("source"), checked_json(text).alias("payload"),
        (received_at if received_at is not None else F.current_timestamp()).alias("received_at"))


def replay_file(spark: SparkSession, path: str, source: str = REPLAY_SOURCE, limit: int | None = None,
                received_at: Column | None = None) -> DataFrame:
    """OP-02 from files; ``limit`` takes the first N non-blank lines, by file name and place in the file."""
    lines = spark.read.text(path)
    if limit is not None:
        lines = (lines.filter(F.trim("value") != "")
                 .select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"),
                         F.monotonically_increasing_id().alias("_i"))
                 .orderBy("_f", "_b", "_i").limit(int(limit)).select("value"))
    return replay_lines(lines, source, received_at)


def load_dim_csv(spark: SparkSession, path: str, target: DataFrame) -> tuple[DataFrame, int]:
    """OP-05 + OP-24: stage the 22-column file and upsert it (last state wins, a
    key missing or repeated inside the file aborts).  An empty file is an error.
    Returns (new dimension state, staged row count)."""
    from merchant_signals.operators.mutate import upsert_last_state

    staged = read_dim_csv22(spark, path)
    n = staged.count()
    if n == 0:
        raise ValueError("the merchant file has no rows")
    return upsert_last_state(target, staged, ["merchant_id"]), n


def load_fact_csv(spark: SparkSession, path: str, existing: DataFrame) -> tuple[DataFrame, dict]:
    """OP-06 + OP-22: stage the 14-column file, keep one row per event_id, insert-
    ignore on event_id.  An empty file, or a row without event_id or event_type,
    fails the whole load.  Of repeated ids the first in file order stays, over any number
    of files (by name) and splits of a file; a quoted field over several lines fails the load.
    The file is read once: the first rows are written, and the counts observed in that write; what
    is to be appended is a temp table too, that ``release_temp`` removes once it is appended.
    Returns (rows to append, {"staged_rows", "fact_total_rows"})."""
    from merchant_signals.operators.facts import insert_ignore

    obs, added = Observation("fact_csv"), Observation("fact_csv_new")
    first = file_order(read_fact_csv14(spark, path)).observe(
        obs, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("event_id").isNull() | F.col("event_type").isNull()).alias("bad"))
    rest = [f.name for f in FACT_CSV14.fields if f.name != "event_id"]
    one = temp_table(first.groupBy("event_id").agg(F.min_by(F.struct(*rest), "_at").alias("_r")).select("event_id", "_r.*"), "fact-csv")
    n = observed(obs)
    if n == 0 or observed(obs, "bad"):
        release_temp(spark, one)
        raise ValueError(f"{observed(obs, 'bad')} rows of the fact file have no event_id or no event_type" if n else "the fact file has no rows")
    new = one.select(*[
        F.col("source_system").alias("source") if c == "source" else F.col("ingested_at_utc").alias(c) if c == "received_at"
        else F.col(c) if c in one.columns else F.lit(None).cast(FACT[c].dataType).alias(c) for c in FACT_COLUMNS])
    rows = temp_table(insert_ignore(new, existing, "event_id").observe(added, F.count(F.lit(1)).alias("rows")), "fact-csv-new")
    release_temp(spark, one)
    return rows, {"staged_rows": n, "fact_total_rows": int(existing.count()) + observed(added)}
