"""Helpers shared by the operators: input tables, staged tables, Arrow passes over texts."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import merchant_signals
from merchant_signals.session import delete_path, ensure_session, scratch_path


#: Bound of an Arrow batch: what a Python worker holds at once, whatever the texts' lengths (a longer text is alone).
BATCH_BYTES = "12m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    ensure_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once an application: their Python workers import it, wherever the driver
    was started."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(merchant_signals.__file__).parent
        target = Path(tempfile.mkdtemp(prefix="ms-package-")) / "merchant_signals_package.zip"  # the driver serves it
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(target))
        _shipped.add(sc.applicationId)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: what follows starts from the files, so
    a lost executor costs no more than its own tasks, and two readers don't compute ``df`` twice."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: all that was made from them has been written."""
    for t in tables:
        delete_path(t.sparkSession, t._staged_path)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: Python workers outlive their tasks, and what they keep
    for themselves adds up beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # other C libraries have no such call
        pass


def arrow_map(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
              done: Callable[[], None] | None = None) -> DataFrame:
    """``f`` on each Arrow batch of each partition, ``done`` after the last."""

    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = f(b)
            if out is not None and out.num_rows:
                yield out
        if done:
            done()
        give_back()

    return df.mapInArrow(run, schema)
