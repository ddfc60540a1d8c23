"""The Merkle manifest against plain Python."""

import pytest
from pyspark.sql import functions as F

from merchant_signals.llm import manifest
from tests.llm import brute

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

CASES = {
    "one": [(1, "A", "x", "s", 1)],
    # nulls, ties, repeated rows, equal groups, trees of heights 0 to 3, a last run of one, a long text
    "many": ([(i, f"Tü{i % 7}", None, "ab"[i % 2] if i % 5 else None, i) for i in range(300)] + 2 * [(3, "Q", "l", "a", 3)] + [(3, None, "l", "a", 3)]
             + [(i, "T", None, f"s{i}", i) for i in range(40)] + [(i, "T", None, "seventeen", i) for i in range(17)]
             + [(7, "T", None, "equal", 7)] * 40 + [(i, "T", "l", "big", i) for i in range(300)]
             + [(None, None, None, None, None), (None, "x" * 300_000, None, "s", None), (None, "", "", "", 0), (5, "Y", "l", "s", 1)]),
}


def _rows(found):
    cols = ["doc_id", "leaf", "subroot", "root", F.sha2("proof", 256), "folded"]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[4])
    return sorted(map(tuple, found.select(*cols).collect()), key=key)


@pytest.mark.parametrize("case", CASES)
def test_manifest_equals_plain_python(spark, case):
    docs = spark.createDataFrame(CASES[case], DOCS).repartition(3)
    got = _rows(manifest.verify(docs))
    assert got == sorted(brute.merkle(docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]))
    changed = {r["doc_id"] for r in docs.collect() if r["doc_id"] is not None and r["text"] and r["text"] != r["text"].lower()
               and brute.zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert {r[0] for r in got if r[5] != r[3]} <= changed


def test_manifest_of_an_empty_table_and_clashing_names(spark):
    assert manifest.verify(spark.createDataFrame([], DOCS)).collect() == []
    docs = spark.createDataFrame([(i, "T", "l", "s", 1, "k") for i in range(20)], DOCS + ", leaf string").withColumn("s", F.lit(9)).withColumn("path", F.lit(1))
    assert len(manifest.verify(docs).collect()) == 20


def test_descent_answers_single_requests(spark):
    """A few runs of leaves, each with its own way; the other groups' records aren't in the answer."""
    rows = spark.createDataFrame([(i, "T", "l", "ab"[i % 2], 1) for i in range(900)], DOCS)
    made = manifest.build(rows.select(F.col("source").alias("grp"), F.col("doc_id").alias("id"),
                                      manifest.leaf_digest(*[F.col(c) for c in manifest.FIELDS]).alias("leaf")), [])
    found = made.descend(spark.createDataFrame([(0, 3, 450), (1, 27, 450)], "s bigint, run bigint, n bigint")).collect()
    assert {(r["s"], r["run"]) for r in found} == {(0, 3), (1, 27)}
    for r in found:
        h = r["digest"]
        assert h == brute._digest(*r["children"])
        for x in r["path"]:
            h = brute._digest(x["left"], h, x["right"])
        assert h == made.root


def test_equal_subtrees_share_a_record(spark):
    docs = spark.createDataFrame([(7, "T", None, "s", 7)] * 40, DOCS)
    made = manifest.build(docs.select(F.col("source").alias("grp"), F.col("doc_id").alias("id"),
                                      manifest.leaf_digest(*[F.col(c) for c in manifest.FIELDS]).alias("leaf")), [])
    assert made.nodes.count() == 3  # two whole runs are one record, a run of 8, the top
