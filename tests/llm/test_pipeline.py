"""The pipeline against plain Python, and its stages on awkward tables."""

import random

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from merchant_signals.llm import queries
from merchant_signals.llm.common import staged
from tests.llm import brute
from tests.llm.test_tables import _check_packing
from tests.llm.test_texts import _card, _lang_docs

UPPER = {ord(b): ord(b) - 32 for b in "abcdefghijklmnopqrstuvwxyz"}
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _corpus(seed=1):
    rng = random.Random(seed)
    rows = [(i, t, lang) for i, t, lang in _lang_docs(120, 8)]
    item = " ".join(rows[7][1].split()[:14])
    turned = lambda i: " ".join(reversed(rows[i][1].split()))
    secret = {200: f"{turned(8)} {_card(rng)} und so weiter", 201: f"{turned(9)} someone@mail.example.com +1 (988) 555-2485"}
    rows += [(i, t, "aa") for i, t in secret.items()]
    rows += [(300 + i, rows[20 + i][1], rows[20 + i][2]) for i in range(6)]  # exact copies
    for i in range(6):  # near copies of long texts
        t = max((r for r in rows[30 + 8 * i:38 + 8 * i]), key=lambda r: len(r[1]))
        w = t[1].split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((400 + i, " ".join(w), t[2]))
    rows += [(500, f"{rows[3][1]} {item.translate(UPPER)} end", None), (501, None, None), (502, "", "aa"), (503, "12 34", "aa"), (504, "?!", None)]
    rng.shuffle(rows)
    return rows, [(1, item), (2, "never seen in any text of this corpus, this one, I hope")], secret


def _write(spark, path, rows, items):
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows], DDL).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")


def test_pipeline_matches_brute_force(spark, tmp_dir):
    rows, items, secret = _corpus()
    _write(spark, tmp_dir, rows, items)
    docs, kept = spark.read.parquet(f"{tmp_dir}/documents.parquet"), {}
    for name, stage in P.STAGES[:-1]:
        docs = staged(stage(spark, docs, tmp_dir), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
    told = {i: t for i, t, _ in rows if any(c.isalpha() for c in t or "")}
    assert {i: r["text"] for i, r in kept["language_id"].items()} == told
    assert all(r["lang"] for r in kept["language_id"].values())
    groups = brute.near_groups(sorted(told.items()), 5, 80, 100)
    single = {i for i, (_, top) in groups.items() if top == i}
    assert set(kept["ngram_jaccard_join"]) == single and len(single) <= len(told) - 12
    marked = brute.decontaminated([(i, told[i]) for i in single], items)
    clean = {i for i in single if not marked[i][4]}
    assert set(kept["benchmark_decontamination"]) == clean and {7, 500}.isdisjoint(clean)
    for i in clean:
        r = kept["pii"][i]
        assert r["n_chars"] == len(r["text"])
        assert (r["text"] == told[i]) is (i not in secret)
    assert "example.com" not in kept["pii"][201]["text"] and brute.luhn(kept["pii"][200]["text"].split()[-4])
    out = P.run(spark, tmp_dir)
    n, least = _check_packing(out.collect(), [(i, kept["pii"][i]["text"]) for i in clean])
    assert n <= least + 1


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(None, "a b c d e", "aa"), (None, "a b c d e", "aa"), (5, "a b c d z", "aa"), (5, "a b c d q", "aa")]])
def test_stages_on_small_tables_with_clashing_columns(spark, tmp_dir, rows):
    extra = "n_hit string, component_id string, n_pii string, score string, items string, n string, lang_pred string"
    docs = spark.createDataFrame([(i, t, lang, None, None, *"abcdefg") for i, t, lang in rows], f"{DDL}, {extra}")
    spark.createDataFrame([(1, "z z z")], "item_id bigint, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    for name, stage in P.STAGES[:-1]:
        after = staged(stage(spark, docs, tmp_dir), "test")
        assert after.columns == docs.columns
        assert all(tuple(r)[5:] == tuple("abcdefg") for r in after.collect())
        docs = after
    got = sorted((r["doc_id"] or 0 for r in P.STAGES[-1][1](spark, docs, tmp_dir).collect()))
    assert got == ([] if len(rows) < 2 else [0, 0, 5])


def test_all_queries_are_registered():
    names = E.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(queries.QUERIES) <= set(names)
    assert len(P.STAGES) == 5


def _moved(plan):
    """Bytes that the shuffles of a finished plan have sent."""
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return _moved(plan.executedPlan())
    if plan.nodeName() == "Exchange":
        return plan.metrics().apply("dataSize").value()
    if plan.nodeName().endswith("QueryStage"):
        return _moved(plan.plan())
    below = plan.children()
    return sum(_moved(below.apply(i)) for i in range(below.size()))


def test_texts_of_rows_that_stay_are_not_shuffled(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(200)), "aa", "s", 0) for i in range(200)]
    rows += [(1000 + i, rows[i][1], "aa", "s", 0) for i in range(5)] + [(100, rows[100][1], "aa", "s", 1), (None, rows[0][1], "aa", "s", 2)]
    docs = staged(spark.createDataFrame(rows, DDL).repartition(4), "test")
    monkeypatch.setattr(P, "ID_BITS", 1 << 20)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as at size
    try:
        kept = P.near_duplicates(spark, docs, "")
        got = kept.collect()
        moved = _moved(kept._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    want = sorted([*range(200), -1])
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in got) == want
    assert 0 < moved < sum(len(t) for _, t, *_ in rows) / 4
    monkeypatch.setattr(P, "ID_BITS", 64)  # nearly all hashes are taken: the same rows, moved or not
    again = P.near_duplicates(spark, docs, "").collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
