"""Session settings the operators rely on.

* session time zone UTC (the reference stores TIMESTAMPTZ and reasons in UTC);
* ANSI mode on, so a malformed amount or timestamp fails the batch, as the
  reference's ``::numeric`` / ``::timestamptz`` casts do;
* AQE on (coalesced shuffle partitions, skew-join splitting).

``spark.checkpoint.dir`` is read from the session.  We only set our own when
it is unset and the master is local; on a cluster it must name a shared folder.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # OP-71: a later key overrides an earlier one in map_concat.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # a key repeated inside one JSON object is valid, the last one counts (as JSONB keeps it)
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def get_spark(master: str | None = None, app: str = "merchant-signals",
              shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Build (or reuse) a session with the settings above. UI stays off."""
    builder = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for k, v in _SQL_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in extra.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_session(spark)


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session someone else created."""
    for k, v in _SQL_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Order: SparkContext's dir, then ``spark.checkpoint.dir``; only if both
    are unset and all of Spark runs in this process, a private temp folder is
    created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ms-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "merchant_signals", *parts])


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Hadoop FileSystem check (works for local, HDFS and object stores)."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it doesn't exist."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows dealt by their keys over all ``spark.sql.shuffle.partitions`` tasks.  Adaptive execution merges partitions up to
    a size of compressed bytes, and rows of near-equal keys and times compress so well that a merged one takes gigabytes
    to sort; a number that is asked for is kept."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


_TEMP: list[str] = []


def temp_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, removed by ``release_temp``."""
    _TEMP.append(scratch_path(spark, "temp", f"{name}-{uuid.uuid4().hex}"))
    return _TEMP[-1]


def temp_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back: computed
    once, lineage cut, nothing persisted.  ``release_temp`` removes the files."""
    path = temp_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._temp_path = path
    return out


def release_temp(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete the folders of these temp tables (of all, if none is named); results that still read them must be
    written first."""
    if tables:
        for t in tables:
            path = t._temp_path
            delete_path(spark, path)
            if path in _TEMP:
                _TEMP.remove(path)
        return
    while _TEMP:
        delete_path(spark, _TEMP.pop())


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """A digest of the files below the paths (names, sizes, times of change), in any store that Spark reads."""
    seen = []
    for path in paths:
        fs, p = _fs(spark, path)
        if fs.exists(p):
            files = fs.listFiles(p, True)
            while files.hasNext():
                f = files.next()
                seen.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha1(repr(sorted(seen)).encode()).hexdigest()


def observed(obs: Observation, name: str = "rows") -> int:
    """An observed count of a plan that has run; 0 if the optimiser saw that the
    plan is empty and left the observation out."""
    try:
        return int(obs.get[name] or 0)
    except Py4JJavaError:
        return 0
