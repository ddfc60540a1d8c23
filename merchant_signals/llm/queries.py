"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_signals.llm import alignment, decontaminate, html_extract, labelled_pages, langid, manifest, near_dups, packing, pii, quality, substring_dedup, token_rollup, url_filter, warc
from merchant_signals.llm.common import fresh_path, table
from merchant_signals.llm.tokens import tokenizer_paths, word_bpe_path

#: Host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate.find_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return decontaminate.report(hits)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pii.key_of(spark))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = fresh_path(spark, "warc")
    warc.write_archive(pages, path)
    return warc.read_archive(spark, path)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals under two tokenizer versions after inserts, a correction and a second delivery of the inserts.

    The inserts come with faults that the rows themselves decide (by crc32 of the id): a third of a text is missing in one
    of seven, the source is wrong in one of five, and one of eleven comes a second time under an id that the corpus lacks.
    The correction revises, moves and deletes them; the totals are those of the documents as they are.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    rollup = token_rollup.TokenRollup(spark, fresh_path(spark, "token-rollup"))
    code = F.crc32(F.col("doc_id").cast("string"))
    short, moved, twice = code % 7 == 0, code % 5 == 0, code % 11 == 0
    early = docs.select("doc_id", F.when(short, F.substring("text", F.lit(1), (F.length("text") * 2 / 3).cast("int"))).otherwise(F.col("text")).alias("text"),
                        F.when(moved, F.concat(F.lit("wrong-"), "source")).otherwise(F.col("source")).alias("source"), "lang")
    stray = docs.where(twice).select((-F.col("doc_id") - 1).alias("doc_id"), "text", "source", "lang")
    for version, counter in (("words", token_rollup.word_counter), ("word_bpe_49k", token_rollup.bpe_counter(word_bpe_path()))):
        first = token_rollup.counted(early.unionByName(stray), version, counter)
        rollup.apply(f"{version}-inserts", first)
        rollup.apply(f"{version}-correction", token_rollup.counted(docs.where(short | moved), version, counter),
                     stray.select("doc_id", F.lit(version).alias("tokenizer_version")))
        rollup.apply(f"{version}-inserts", first)
    return rollup.totals()


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_bpe_path())


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_on_documents(spark, docs)
    return (langid.identify(docs.select("doc_id", "text"), model)
            .select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "coverage"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = html_extract.fit(labelled_pages.labelled_pages(table(spark, sf_dir, "documents")))
    found = html_extract.extract(table(spark, sf_dir, "pages"), model)
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), *tokenizer_paths())
    sha = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", sha).drop("groups")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = manifest.verify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
                        F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_ngram_jaccard_join, op3_substring_dedup, op4_pii, op5_quality_rules, op6_warc_archive, op7_token_counts,
                                  op8_best_fit_packing, op9_url_filter, op10_language_id, op11_html_extraction, op12_cross_tokenizer_alignment, op13_merkle_manifest)}
