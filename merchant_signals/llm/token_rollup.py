"""Token totals by source, language and tokenizer version, kept by signed deltas.

A rollup is a folder: ``ledger/<n>-<batch>`` holds the signed rows of a batch (document, tokenizer version, source,
language, tokens, sign), ``totals/<n>-<batch>`` the totals after it.  Applying a batch takes back the rows that the
ledger holds for its documents (sign -1) and adds their new ones (+1), so an insert, a revised count, a move to
another source and a delete are all sums.  A batch is committed when its totals folder is complete (``_SUCCESS``);
applying a committed batch again does nothing, and a batch that broke off is overwritten when it is applied again.

Cases: null texts have 0 tokens; null ids, sources and languages are values of their own; of several rows of a batch
with one id the one with the largest (source, language, tokens) counts; an empty batch commits and changes nothing;
deleting what isn't there changes nothing; further columns of the documents aren't used.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_signals.llm.common import arrow_map, release, staged
from merchant_signals.llm.tokens import encoder, forget
from merchant_signals.llm.words import texts_of, words_of

LEDGER = "doc_id bigint, tokenizer_version string, source string, lang string, n_tokens bigint, sign int"
TOTALS = "source string, lang string, tokenizer_version string, n_docs bigint, n_tokens bigint"
GROUP = ["source", "lang", "tokenizer_version"]


def word_counter(column: pa.Array) -> np.ndarray:
    """Words between ASCII white space."""
    return np.concatenate([np.zeros(0, np.int64), *(w.counts for w in words_of(column))])


def bpe_counter(vocabulary: str) -> Callable[[pa.Array], np.ndarray]:
    def count(column: pa.Array) -> np.ndarray:
        data, offset = texts_of(column)
        enc, raw = encoder(vocabulary), data.tobytes()
        return np.array([len(enc.encode(raw[offset[i]:offset[i + 1]])) // 4 for i in range(len(column))], np.int64)

    return count


def counted(docs: DataFrame, version: str, counter: Callable[[pa.Array], np.ndarray], id_col: str = "doc_id",
            text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """doc_id, tokenizer_version, source, lang, n_tokens: the inserts or revisions of a batch."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(counter(b.column(3)).astype(np.int64))],
                                          names=["doc_id", "source", "lang", "n_tokens"])

    own = docs.select(F.col(id_col).cast("long"), F.col(source_col).cast("string"), F.col(lang_col).cast("string"),
                      F.col(text_col).cast("string"))
    return (arrow_map(own, run, "doc_id bigint, source string, lang string, n_tokens bigint", forget)
            .withColumn("tokenizer_version", F.lit(version)))


class TokenRollup:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _committed(self) -> list[str]:
        """Folder names of the committed batches, in order."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/totals")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        done = [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/totals/{n}/_SUCCESS"))]
        return sorted(done, key=lambda n: int(n.partition("-")[0]))

    def totals(self) -> DataFrame:
        if not (done := self._committed()):
            return self.spark.createDataFrame([], TOTALS)
        return self.spark.read.schema(TOTALS).parquet(f"{self.path}/totals/{done[-1]}")

    def counts(self, touched: DataFrame | None = None) -> DataFrame:
        """The rows that hold: those whose signs add up to more than 0. touched (d, v): only of these documents."""
        if not (done := self._committed()):
            return self.spark.createDataFrame([], LEDGER).drop("sign")
        rows = self.spark.read.schema(LEDGER).parquet(*[f"{self.path}/ledger/{n}" for n in done])
        if touched is not None:
            rows = rows.join(touched, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tokenizer_version") == F.col("v")), "left_semi")
        key = [c for c in rows.columns if c != "sign"]
        return rows.groupBy(key).agg(F.sum("sign").alias("sign")).where(F.col("sign") > 0).select(key)

    def apply(self, batch: str, upserts: DataFrame | None = None, deletes: DataFrame | None = None) -> bool:
        """upserts: as from ``counted``. deletes: doc_id, tokenizer_version. False if the batch is committed already."""
        done = self._committed()
        if any(n.partition("-")[2] == batch for n in done):
            return False
        name = f"{len(done) + 1}-{batch}"
        key = ["doc_id", "tokenizer_version"]
        columns = [*key, "source", "lang", "n_tokens"]
        new = upserts if upserts is not None else self.spark.createDataFrame([], LEDGER)
        # written, so that what it replaces is looked up without counting the tokens again
        new = staged(new.groupBy(key).agg(F.max(F.struct("source", "lang", "n_tokens")).alias("v")).select(*key, "v.*"), "rollup-batch")
        gone = new.select(key)
        if deletes is not None:
            gone = gone.unionByName(deletes.select(key)).distinct()
        touched = gone.select(F.col("doc_id").alias("d"), F.col("tokenizer_version").alias("v"))
        old = self.counts(touched)
        rows = new.select(*columns, F.lit(1).alias("sign")).unionByName(old.select(*columns, F.lit(-1).alias("sign")))
        if deletes is not None:
            dropped = deletes.select(F.col("doc_id").alias("d"), F.col("tokenizer_version").alias("v")).distinct()
            rows = rows.join(dropped, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("tokenizer_version") == F.col("v"))
                             & (F.col("sign") > 0), "left_anti")
        rows.select("doc_id", "tokenizer_version", "source", "lang", "n_tokens", "sign").write.mode("overwrite").parquet(
            f"{self.path}/ledger/{name}")
        release(new)
        delta = (self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger/{name}").groupBy(GROUP)
                 .agg(F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens")))
        (self.totals().unionByName(delta).groupBy(GROUP)
         .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where(F.col("n_docs") != 0)
         .write.mode("overwrite").parquet(f"{self.path}/totals/{name}"))
        return True
