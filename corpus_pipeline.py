"""Corpus pipeline: language ID, near duplicates, benchmark decontamination, PII, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``.  All but the last return the columns of ``documents``;
columns of the input that are named like an operator's own come through unchanged.

Cases: texts that are null or hold no letter go in the first stage; of rows with one id a single one passes the second;
rows with a null id never count as duplicates; an empty table gives an empty result of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchant_signals.llm import decontaminate, langid, near_dups, packing, pii
from merchant_signals.llm.common import staged, table
from merchant_signals.llm.tokens import word_bpe_path

#: A text goes if less than this share of its 4-grams belongs to the language found.
MIN_COVERAGE = 0.2
#: Near duplicates: shingles of five words, similarity 0.8 or more.
NEAR = near_dups.Rule(k=5, num=80, den=100)
#: Bits of the bitmap of ids of rows that may go.
ID_BITS = 1 << 24


#: The columns that operators read.
OWN = ("doc_id", "text", "lang")


def _plain(docs: DataFrame) -> DataFrame:
    """All other columns under names that no operator uses."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in OWN else f"__{i}") for i, c in enumerate(docs.columns)])


def _named(df: DataFrame, docs: DataFrame) -> DataFrame:
    """Back to the columns of ``docs``."""
    return df.select(*[F.col(c if c in OWN else f"__{i}").alias(c) for i, c in enumerate(docs.columns)])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language can be told; a missing language is filled in."""
    df = _plain(docs)
    told = langid.identify(df, langid.fit_on_documents(spark, df))
    kept = told.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("coverage") >= MIN_COVERAGE))
    return _named(kept.withColumn("lang", F.coalesce("lang", "lang_pred")), docs)


def _apart(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of docs that have none of the ids (doc_id), and the few that may have one.

    A bitmap of hashed ids tells them: it is broadcast, at most ID_BITS / 64 rows of 64 bits however many ids there are,
    and the texts of all other rows stay where they are."""
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(ID_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    words = ids.groupBy(F.shiftright(place, 6).alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    marked = (docs.withColumn("__word", F.shiftright(place, 6)).join(F.broadcast(words), "__word", "left")
              .withColumn("__hit", F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))))
    return marked.where(~F.col("__hit")).select(docs.columns), marked.where("__hit").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest id."""
    found = staged(near_dups.near_duplicates(docs, NEAR), "pipeline-groups")
    gone = found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    again = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id")
    plain, rest = _apart(docs, staged(gone.unionByName(again), "pipeline-ids"))
    # both sides grow with the corpus: a sorted join at every size
    kept = rest.join(gone.hint("merge"), "doc_id", "left_anti").select(docs.columns)
    if again.limit(1).count():
        rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", *docs.columns))
        one = kept.join(again, "doc_id", "left_semi").withColumn("__rank", rank).where("__rank = 1")
        kept = kept.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(one.select(docs.columns))
    return plain.unionByName(kept)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without an occurrence of a window of the benchmark."""
    hits = decontaminate.find_hits(_plain(docs), table(spark, sf_dir, "benchmark"))
    return _named(hits.where(F.col("n_hit") == 0), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; n_chars follows the text."""
    new = _named(pii.pseudonymise(_plain(docs), pii.key_of(spark)), docs)
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return new.select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts and their places in sequences of 4,096 tokens."""
    return packing.pack(docs, word_bpe_path())


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: The last stage is byte-pair encoding and packing, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
