"""Parquet tables of the data product, kept under one root folder.

* ``raw``        append-only, partitioned by ``landing`` and ``source``; raw ids assigned here.  A landing is
                 one append: a micro-batch's folder is named after its stream and batch, so that a replay finds it
* ``refused``    payloads that are no JSON object, with the reason; partitioned like ``raw``
* ``landings``   the raw-id range of each keyed landing, one folder a key
* ``facts``      append-only (insert-ignore upstream), partitioned by ``event_date``
* ``snapshots``  partitioned by ``snapshot_date``; an upsert rewrites only the
                 dates it touches
* ``latest``     each merchant's newest snapshot, kept up by every change of ``snapshots`` (``latest_snapshots``)
* ``late``       (merchant, event time) of facts behind the clock of the stateful stream, partitioned by ``load``
* ``dim_merchant``  append-only (new merchants) or replaced whole (file load)
* ``watermark``, ``load_position``, ``raw_sequence``, ``fact_clock``, ``pending``  small state

Tables that are replaced whole are versioned: a new state goes to the next
``v=<n>`` folder, readers take the newest complete one, older ones are removed
afterwards, so that a crash at any point leaves the old or the new state.

Partitions are replaced from a staged copy.  Its place is noted in ``pending``
first; if the job dies while the partitions are being swapped, ``recover``
does the same swap again from the copy.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from merchant_signals import schemas as S
from merchant_signals.session import delete_path, list_names, path_exists, release_temp, temp_table


def _schema(fields: list[tuple[str, object]]) -> StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


SNAPSHOT_SCHEMA = _schema([
    ("merchant_id", T.StringType()), ("snapshot_time_utc", T.TimestampType()),
    ("computed_at_utc", T.TimestampType()), ("txn_count_15m", T.IntegerType()),
    ("gmv_usd_15m", T.DecimalType(18, 2)), ("txn_count_1h", T.IntegerType()),
    ("gmv_usd_1h", T.DecimalType(18, 2)), ("risk_score_v1", T.DecimalType(5, 2)),
    ("risk_band_v1", T.StringType()), ("local_model_score", T.DecimalType(6, 5)),
    ("local_model_band", T.StringType()), ("local_model_version", T.StringType()),
    ("local_model_scored_at_utc", T.TimestampType())])
SEQUENCE_SCHEMA = _schema([("last_raw_id", T.LongType())])
LANDING_SCHEMA = _schema([("first_raw_id", T.LongType()), ("last_raw_id", T.LongType())])
REFUSED_SCHEMA = _schema([("source", T.StringType()), ("payload", T.StringType()), ("received_at", T.TimestampType()),
                          ("reason", T.StringType())])
PENDING_SCHEMA = _schema([("table", T.StringType()), ("staged", T.StringType())])

REJECT_SCHEMA = _schema([("raw_id", T.LongType()), ("source", T.StringType()), ("received_at", T.TimestampType()),
                         ("reason", T.StringType()), ("payload", T.StringType())])

LATE_SCHEMA = _schema([("load", T.StringType()), ("merchant_id", T.StringType()), ("event_time_utc", T.TimestampType())])
CLOCK_SCHEMA = _schema([("newest", T.TimestampType())])

SCHEMAS = {"raw": S.RAW, "facts": S.FACT, "snapshots": SNAPSHOT_SCHEMA, "latest": SNAPSHOT_SCHEMA, "dim_merchant": S.DIM,
           "watermark": S.WATERMARK, "load_position": S.WATERMARK, "raw_sequence": SEQUENCE_SCHEMA,
           "refused": REFUSED_SCHEMA, "rejects": REJECT_SCHEMA, "late": LATE_SCHEMA, "fact_clock": CLOCK_SCHEMA, "pending": PENDING_SCHEMA}
VERSIONED = {"latest", "dim_merchant", "watermark", "load_position", "raw_sequence", "fact_clock", "pending"}
PARTITIONS = {"raw": ["landing", "source"], "refused": ["landing", "source"], "rejects": ["source"], "late": ["load"], "facts": ["event_date"], "snapshots": ["snapshot_date"]}
DATE_OF = {"facts": "event_time_utc", "snapshots": "snapshot_time_utc"}


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._staged: dict[int, str] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _versions(self, name: str) -> list[int]:
        """Complete versions of a replaced table, oldest first."""
        root = self.path(name)
        found = [n for n in list_names(self.spark, root) if n.startswith("v=")]
        return sorted(int(n[2:]) for n in found if path_exists(self.spark, f"{root}/{n}/_SUCCESS"))

    def _data_path(self, name: str) -> str | None:
        """Where the table's current files are; None before the first write."""
        if name in VERSIONED:
            done = self._versions(name)
            return f"{self.path(name)}/v={done[-1]}" if done else None
        return self.path(name) if path_exists(self.spark, self.path(name)) else None

    def _full_schema(self, name: str) -> StructType:
        """Data columns plus the partition column (typed), for schema-explicit reads
        that also work on a folder holding no data file yet."""
        schema = SCHEMAS[name]
        part = PARTITIONS.get(name, [])
        extra = [T.StructField(p, T.DateType() if p.endswith("_date") else T.StringType()) for p in part
                 if p not in schema.fieldNames()]
        return T.StructType([f for f in schema.fields if f.name not in part] + extra)

    def read(self, name: str) -> DataFrame:
        schema = SCHEMAS[name]
        path = self._data_path(name)
        if path is None:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(self._full_schema(name)).parquet(path)
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])

    def read_dates(self, name: str, lo, hi) -> DataFrame:
        """Rows of the date partitions lo..hi only (partition pruning)."""
        return self._read_where(name, lambda d: d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")))

    def read_days(self, name: str, days) -> DataFrame:
        """Rows of the given date partitions only (partition pruning)."""
        return self._read_where(name, lambda d: d.isin([F.lit(x).cast("date") for x in sorted(days)]))

    def _read_where(self, name: str, keep) -> DataFrame:
        schema = SCHEMAS[name]
        path = self._data_path(name)
        if path is None:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(self._full_schema(name)).parquet(path).filter(keep(F.col(PARTITIONS[name][0])))
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])

    def _with_partition_cols(self, name: str, df: DataFrame) -> DataFrame:
        if "landing" in PARTITIONS.get(name, []):
            df = df.withColumn("landing", F.lit(uuid.uuid4().hex))
        if name in DATE_OF:
            df = df.withColumn(PARTITIONS[name][0], F.to_date(DATE_OF[name]))
        return df

    def _clustered(self, name: str, df: DataFrame) -> DataFrame:
        """Rows of a partition together, so that a small date is one file; adaptive
        execution splits large dates and merges small ones."""
        return df.hint("rebalance", PARTITIONS[name][-1]) if name in PARTITIONS else df

    def append(self, name: str, df: DataFrame) -> None:
        schema = SCHEMAS[name]
        rows = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in schema.fields])
        if name in VERSIONED:  # further files of the present version
            rows.write.mode("append").parquet(self._data_path(name) or f"{self.path(name)}/v=1")
            return
        out = self._clustered(name, self._with_partition_cols(name, rows))
        out.write.mode("append").partitionBy(*PARTITIONS[name]).parquet(self.path(name))

    def replace(self, name: str, df: DataFrame) -> None:
        """The next version of a small table; the plan may read the present one."""
        schema = SCHEMAS[name]
        done = self._versions(name)
        version = done[-1] + 1 if done else 1
        df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode("overwrite").parquet(
            f"{self.path(name)}/v={version}")
        for old in done[:-1]:  # the version before stays for readers that have just opened it
            delete_path(self.spark, f"{self.path(name)}/v={old}")

    def stage(self, df: DataFrame) -> DataFrame:
        """``df`` written below the store and read back; ``unstage`` removes it."""
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._staged[id(out)] = path
        return out

    def unstage(self, *frames: DataFrame) -> None:
        for df in frames:
            delete_path(self.spark, self._staged.pop(id(df)))

    def replace_partitions(self, name: str, new_state: DataFrame) -> None:
        """Overwrite exactly the partitions present in ``new_state``, which may be
        computed from them."""
        schema = SCHEMAS[name]
        if self.read("pending").limit(1).count():
            raise RuntimeError("a partition swap broke off: call recover() before reading and replacing partitions")
        out = self._with_partition_cols(name, new_state.select(*[F.col(f.name).cast(f.dataType)
                                                                 for f in schema.fields]))
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        self._clustered(name, out).write.parquet(path)
        self.replace("pending", self.spark.createDataFrame([(name, path)], PENDING_SCHEMA))
        self.recover()

    def recover(self) -> None:
        """Finish a partition swap that is noted as pending."""
        for r in self.read("pending").collect():  # one row at most
            if path_exists(self.spark, f"{r['staged']}/_SUCCESS"):
                self._swap(r["table"], r["staged"])
                self.replace("pending", self.spark.createDataFrame([], PENDING_SCHEMA))
                delete_path(self.spark, r["staged"])

    def _swap(self, name: str, path: str) -> None:
        part = PARTITIONS[name]
        staged = self.spark.read.schema(self._full_schema(name)).parquet(path)
        if not staged.isEmpty():  # else no partition to replace
            # the copy's rows lie together already: they are sorted by partition, not moved again
            (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*part).parquet(self.path(name)))
            if name == "snapshots":
                self._keep_latest(staged)

    def _keep_latest(self, changed: DataFrame) -> None:
        from merchant_signals.operators.features import merge_latest

        if self._versions("latest"):
            self.replace("latest", merge_latest(self.read("latest"), changed))
        else:
            self.rebuild_latest()

    def rebuild_latest(self) -> None:
        """``latest`` from all snapshots (a table from before it was kept)."""
        from merchant_signals.operators.features import latest_per_merchant

        self.replace("latest", latest_per_merchant(self.read("snapshots")))

    def latest_snapshots(self) -> DataFrame:
        """OP-44: each merchant's newest snapshot, a read of one row per merchant."""
        if not self._versions("latest") and path_exists(self.spark, self.path("snapshots")):
            self.rebuild_latest()
        return self.read("latest")

    # ---- raw landing (OP-01 / OP-02 / OP-04) ----------------------------------------
    def _landed(self, key: str) -> tuple[int, int] | None:
        """The raw-id range noted for a landing."""
        path = f"{self.path('landings')}/{key}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            return None
        r = self.spark.read.schema(LANDING_SCHEMA).parquet(path).first()
        return int(r["first_raw_id"]), int(r["last_raw_id"])

    def _take_ids(self, last: int) -> None:
        self.replace("raw_sequence", self.spark.createDataFrame([(int(last),)], SEQUENCE_SCHEMA))

    def last_raw_id(self) -> int:
        """The last id that was given out (initialised from the raw ids once)."""
        seq = self.read("raw_sequence").first()
        if seq is None:
            seq = self.read("raw").agg(F.coalesce(F.max("raw_id"), F.lit(0)).alias("last_raw_id")).first()
        return int(seq["last_raw_id"])

    def append_raw(self, rows: DataFrame, order_by: list[str] | None = None, key: str | None = None) -> int:
        """Assign dense raw ids after the last assigned one, in ``order_by`` order (default: received_at, payload), and
        append; payloads that are no JSON object go to ``refused`` with the reason.  Returns the new last id.

        The last id lives in a one-row ``raw_sequence`` table (single writer, like a serial), so landing never scans
        the raw table.  key: a name for these rows (stream and batch): landing them again does nothing if all of it is
        there, and else writes the same folder with the same ids.  Ids are taken, then noted under the key, then the
        refused rows and the rows are written, each at once (a folder with ``_SUCCESS``): a crash before the note
        leaves a gap in the ids, one after it is repaired by the replay."""
        from merchant_signals.functions.json import json_reject
        from merchant_signals.operators.row_ids import dense_row_id

        landing = key or uuid.uuid4().hex
        if not re.fullmatch(r"[\w.-]+", landing):
            raise ValueError(f"a landing's key names a folder: {landing!r}")
        target = f"{self.path('raw')}/landing={landing}"
        noted = self._landed(landing) if key else None
        if noted and path_exists(self.spark, f"{target}/_SUCCESS"):
            return noted[1]
        start = noted[0] - 1 if noted else self.last_raw_id()
        told = temp_table(rows.select("source", "payload", "received_at", json_reject("payload").alias("reason")), "landing")
        good = told.filter(F.col("reason").isNull()).drop("reason")
        numbered = dense_row_id(good, order_by or ["received_at", "payload"], "raw_id", start=start + 1)
        last = numbered.agg(F.max("raw_id").alias("m")).first()["m"]
        last = start if last is None else int(last)
        if noted and last != noted[1]:
            raise RuntimeError(f"landing {landing} had ids {noted[0]} to {noted[1]}, its replay has {last - start} rows")
        if not noted:
            if last > start:
                self._take_ids(last)
            if key:
                self.spark.createDataFrame([(start + 1, last)], LANDING_SCHEMA).write.mode("overwrite").parquet(
                    f"{self.path('landings')}/{landing}")
        refused = told.filter(F.col("reason").isNotNull())
        if refused.limit(1).count():
            refused.write.mode("overwrite").partitionBy("source").parquet(f"{self.path('refused')}/landing={landing}")
        if last > start or key:
            out = numbered.select(*[F.col(f.name).cast(f.dataType) for f in S.RAW.fields])
            # ranges of ids stay together: a task sorts its rows by source, nothing is moved again
            out.write.mode("overwrite").partitionBy("source").parquet(target)
        release_temp(self.spark, told, numbered)
        return last
