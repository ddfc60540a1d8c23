"""Cross-tokenizer alignment against plain Python, and the minimal perfect hash."""

import hashlib

import numpy as np
import pytest

from merchant_signals.llm import alignment, mph, queries
from merchant_signals.llm.tokens import tokenizer_paths
from tests.llm import brute

ODD = ["a  b\n\n c\t d  ", "\n x", "ab  cd   x \x85y", " lead", "trail \n", "\u2581x y", "<|endoftext|> <s> </s> <0x41> hi", "日本語 テキスト 🙂🙂\u200d x",
       "'s don't I'll  'll", "12 345 6,789", "\x00\x01 \x1c a\x1cb", "x" * 3000, "e\u0301 \u0301 a", "", "  ", "\n", "\r\n a \r\n;\r", "   a", "\u00a8 x",
       "\ufb01 \ufb00", "\ufeff a", None, "a" + " " * 3000 + "b", "same text", "same text", "same text"]
DOCS = "doc_id bigint, text string"


@pytest.mark.parametrize("max_pairs", [alignment.MAX_PAIRS, 10])
def test_alignment_equals_plain_python(spark, max_pairs):
    """With broadcast counts, and with more pairs than are broadcast."""
    rows = list(enumerate(ODD)) + [(1000 + i, t) for i, t in brute.corpus(30)]
    paths = tokenizer_paths()
    t = alignment.tokenizers(*paths)
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(docs, *paths, max_pairs=max_pairs).collect()}
    assert got == brute.aligned(rows, *paths, t.a_bytes, t.b_bytes)
    assert {i for i, x in enumerate(ODD) if got[i][0] == 0} == {i for i, x in enumerate(ODD) if not x or "\u2581" in x}


def test_both_libraries_of_a_agree():
    t = alignment.tokenizers(*tokenizer_paths())
    assert t.fast is not None
    for text in [x for x in ODD if x and len(x) < 2000] + [x for _, x in brute.corpus(30, seed=5) if x]:
        assert t.fast.encode_ordinary(" " + text) == t.whole.encode(" " + text, add_special_tokens=False).ids
    assert len(t.encode_a(" " * 200_000)) > 0  # runs that the faster library can't take


def test_alignment_of_an_empty_table_repeated_ids_and_further_columns(spark):
    assert alignment.align(spark.createDataFrame([], DOCS), *tokenizer_paths()).collect() == []
    docs = spark.createDataFrame([(1, "a b", 7, "x"), (1, "a b", 7, "x"), (None, "a b", 7, "x")], DOCS + ", n_a int, groups string")
    got = alignment.align(docs, *tokenizer_paths()).collect()
    assert len(got) == 3 and {r["n_a"] for r in got} == {2} and {r["count_sum"] for r in got} == {3 * r["n_links"] for r in got}


def test_query_digests(spark, tmp_dir):
    spark.createDataFrame([(1, "Hello, world"), (2, None)], DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op12_cross_tokenizer_alignment(spark, tmp_dir).collect()}
    groups = alignment.align(spark.createDataFrame([(1, "Hello, world")], DOCS), *tokenizer_paths()).first()["groups"]
    assert got[1]["groups_sha256"] == hashlib.sha256(groups.encode()).hexdigest() and got[2]["groups_sha256"] == ""


def test_minimal_perfect_hash(spark):
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 40, 20_000))
    h = mph.build_mph(spark.createDataFrame([(int(k),) for k in keys], "k bigint"), "k", len(keys))
    at = h.index(keys)
    assert sorted(at.tolist()) == list(range(len(keys)))
    assert (h.keys[at] == keys).all()
    assert (h.index(np.array([1 << 41, int(keys[0]) + (1 << 42)])) == -1).all()
    assert mph.build_mph(spark.createDataFrame([], "k bigint"), "k", 0).index(np.array([5])).tolist() == [-1]
