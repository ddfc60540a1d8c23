"""Decontamination, near duplicates and substring dedup against plain Python."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from merchant_signals.llm import decontaminate, near_dups, repeats, substring_dedup
from merchant_signals.llm.components import connected_components
from merchant_signals.llm.words import windows, words_of
from tests.llm import brute

DOCS = "doc_id bigint, text string"


def _frame(spark, rows, ddl=DOCS, parts=3):
    return spark.createDataFrame(rows, ddl).repartition(parts) if rows else spark.createDataFrame([], ddl)


@pytest.mark.parametrize("lower", [False, True])
def test_words_and_windows(lower):
    docs = brute.corpus()
    column = pa.array([t for _, t in docs])
    got = {}
    for w in words_of(column, lower):
        text = w.data.tobytes().lower() if lower else w.data.tobytes()
        for t in range(len(w.first) - 1):
            got[w.row0 + t] = [text[s:e].decode() for s, e in zip(w.start[w.first[t]:w.first[t + 1]], w.end[w.first[t]:w.first[t + 1]])]
    assert got == {i: brute.words(t, lower) for i, (_, t) in enumerate(docs)}
    same = {}
    for w in words_of(column, lower):
        h, at, row = windows(w, 4, whole=True)
        for x, a, r in zip(h, at, row):
            n = min(4, len(got[w.row0 + r]))
            same.setdefault(int(x), set()).add(tuple(got[w.row0 + r][a - w.first[r]:][:n]))
    assert all(len(v) == 1 for v in same.values())
    assert len(same) == len({v for x in same.values() for v in x})


def test_decontamination_matches_brute_force(spark):
    docs, rng = brute.corpus(), random.Random(3)
    long = [t for _, t in docs if t and len(t.split()) > 25]
    items = [(1, " ".join(long[0].split()[3:20]).upper()), (2, "x, X. x"), (10, " ".join(long[1].split()[:30])), (3, None), (4, " .. "),
             (None, " ".join(long[2].split()[-12:])), (11, " ".join(long[1].split()[5:25])), (5, "nothing like it anywhere"), (1, "one")]
    rng.shuffle(items)
    bench = _frame(spark, items, "item_id bigint, text string")
    want = brute.decontaminated(docs, items)
    assert any(x[4] for x in want.values())
    for block_chars in (10**6, 150):  # one automaton, and several in turn
        hits = decontaminate.find_hits(_frame(spark, docs), bench, block_chars=block_chars)
        assert {r[0]: tuple(r)[1:] for r in decontaminate.report(hits).collect()} == want
    texts = dict(docs)
    for r in hits.collect():
        pieces = [texts[r["doc_id"]][s["start"]:s["end"]] for s in r["spans"]]
        assert sum(len(brute.NORMAL.findall(p)) for p in pieces) == r["n_hit"]


def test_decontamination_cases(spark):
    none = _frame(spark, [], "item_id bigint, text string")
    out = decontaminate.find_hits(_frame(spark, [(1, None), (1, "a b"), (1, "a b")]), none).collect()
    assert sorted((r["n_words"], r["n_hit"]) for r in out) == [(0, 0), (2, 0), (2, 0)]
    bench = _frame(spark, [(7, "a b")], "item_id bigint, text string")
    assert decontaminate.find_hits(_frame(spark, []), bench).collect() == []
    clash = spark.createDataFrame([(1, "a b c", "mine", "also")], "doc_id bigint, text string, n_hit string, item_id string")
    row = decontaminate.find_hits(clash, bench).first()
    assert (row["n_hit"], row["item_id"], row["items"]) == (2, "also", ["7"])


@pytest.mark.parametrize("seed, rule", [(1, near_dups.Rule()), (2, near_dups.Rule(5, 80, 100)), (3, near_dups.Rule(2, 60, 100))])
def test_near_duplicates_match_brute_force(spark, seed, rule):
    rng, docs = random.Random(seed), brute.corpus(60, seed)
    # chains: each text a few words from the one before
    w = docs[0][1].split() + brute.vocabulary(60, seed + 9)
    for i in range(25):
        w = list(w)
        w[rng.randrange(len(w))] = f"new{i}"
        docs.append((1000 + i, " ".join(w)))
    rng.shuffle(docs)
    got = near_dups.near_duplicates(_frame(spark, docs, parts=4), rule).collect()
    want = brute.near_groups(docs, rule.k, rule.num, rule.den)
    assert {r[0]: tuple(r)[1:] for r in got} == want
    assert len({c for _, c in want.values()}) < len(docs) - 10


def test_rows_of_blocks_are_sent_once(spark, monkeypatch):
    plans, write = {}, near_dups.staged

    def seen(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, **options)

    monkeypatch.setattr(near_dups, "staged", seen)
    near_dups.near_duplicates(_frame(spark, brute.corpus(20, 1))).collect()
    for name in ("members", "apart"):
        assert plans[name].count("Exchange hashpartitioning(block") == 1, name


def test_wide_sketches_have_a_bounded_size_and_distance():
    rng = np.random.default_rng(7)
    for n in (1, 600, 5000):
        union = rng.integers(1, 2**63, n + n // 2, dtype=np.uint64)
        a, b = union[:n], union[n // 2:]
        x, y = near_dups._wide(a), near_dups._wide(b)
        assert near_dups._distance(x, y) <= len(np.setxor1d(a, b)) and 8 * len(x) <= max(near_dups.PARITY_BITS, 2 * n)


def test_blocks_of_linked_sets_meet():
    """Sets at the very bound of similarity share a block, whatever their sizes."""
    rng, rule = np.random.default_rng(5), near_dups.Rule()
    for n in [*range(1, 60), 100, 163, 400, 1500]:
        for _ in range(4):
            union = rng.integers(1, 2**63, n, dtype=np.uint64)
            differ = n * (rule.den - rule.num) // rule.den
            split = rng.integers(0, differ + 1)
            a, b = np.sort(union[split:]), np.sort(np.concatenate([union[:split], union[differ:]]))
            common = n - differ
            assert rule.den * common >= rule.num * n
            h, first = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            keys, rows = near_dups.blocks_of(h, first, rule)
            assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist()), n


def test_parity_distance_is_a_lower_bound():
    rng = np.random.default_rng(6)
    for n in (3, 50, 5000):
        union = rng.integers(1, 2**63, n, dtype=np.uint64)
        a, b = union[: 2 * n // 3], union[n // 3:]
        p = near_dups._parity(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert np.bitwise_count(p[0] ^ p[1]).sum() <= len(np.setxor1d(a, b))


def test_near_duplicate_cases(spark):
    assert near_dups.near_duplicates(_frame(spark, [])).collect() == []
    rows = [(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (5, "A B C D E"), (4, None), (6, ""), (7, "a"), (8, "A")]
    got = sorted((tuple(r) for r in near_dups.near_duplicates(_frame(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 2, None), (3, 2, 3), (3, 2, 3), (5, 2, 3), (4, 0, 4), (6, 0, 6), (7, 1, 7), (8, 1, 7)], key=str)
    clash = spark.createDataFrame([(1, "a", "b", "c")], "doc_id bigint, text string, n string, component_id string")
    assert [tuple(r) for r in near_dups.near_duplicates(clash).collect()] == [(1, 1, 1)]


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 95), (200, 201), (5, 5)] + [(300, x) for x in rng.sample(range(310, 400), 20)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert all(got[i] == 0 for i in range(1, 31)) and got[100] == got[95] == 90 and got[201] == 200
    assert all(got[b] == 300 for a, b in links[-20:]) and len(got) == 30 + 2 + 1 + 20
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 5)])
def test_substring_dedup_matches_brute_force(spark, seed, parts):
    docs = brute.corpus(80, seed, common=25)
    random.Random(seed).shuffle(docs)
    got = substring_dedup.remove_repeats(_frame(spark, docs, parts=parts)).collect()
    have = {r[0]: (r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in got}
    want = brute.without_repeats(docs)
    assert have == want and any(x[1] for x in want.values())


def test_substring_dedup_loses_nothing_when_the_sketch_is_full(spark, monkeypatch):
    monkeypatch.setattr(repeats, "MIN_CELLS", 64)
    monkeypatch.setattr(repeats, "MAX_CELLS", 64)
    docs = brute.corpus(40, 7, common=25)
    got = substring_dedup.remove_repeats(_frame(spark, docs)).collect()
    assert {r[0]: r[2] for r in got} == {d: x[1] for d, x in brute.without_repeats(docs).items()}


def test_substring_dedup_with_other_batches_at_each_reading(spark):
    passage = " ".join(f"w{i}" for i in range(20))

    def docs(batches):
        for _ in batches:
            ids = list(range(40))
            random.SystemRandom().shuffle(ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([f"{passage} x{i}" for i in ids])], names=["doc_id", "text"])

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "2")
    try:
        df = spark.range(0, 1, 1, 1).mapInArrow(docs, "doc_id bigint, text string")
        got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(df).collect()}
    finally:
        spark.conf.set(setting, before)
    assert got == {i: 20 if i else 0 for i in range(40)}


def test_substring_dedup_cases(spark):
    assert substring_dedup.remove_repeats(_frame(spark, [])).collect() == []
    t = " ".join(brute.vocabulary(13, 5))
    rows = [(2, t), (2, t), (1, "a " + t), (None, t), (None, t), (3, None), (4, ""), (5, t + " z")]
    got = sorted((tuple(r) for r in substring_dedup.remove_repeats(_frame(spark, rows)).collect()), key=str)
    assert got == sorted([(2, 13, 13, ""), (2, 13, 13, ""), (1, 14, 0, "a " + t), (None, 13, 13, ""), (None, 13, 13, ""),
                          (3, 0, 0, ""), (4, 0, 0, ""), (5, 14, 13, "z")], key=str)
    # the same document, twice: nothing stands in an earlier one
    assert {r[2] for r in substring_dedup.remove_repeats(_frame(spark, [(9, t), (9, t)])).collect()} == {0}


def _thue_morse(n, flip=0):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


def test_long_words_that_polynomial_hashes_take_for_equal(spark):
    words = [_thue_morse(1024), _thue_morse(1024, 1), _thue_morse(4096), _thue_morse(4096, 1)]
    hashes = [int(h) for w in words_of(pa.array(words)) for h in w.hash]
    assert len(set(hashes)) == 4
    docs = [(1, " ".join([words[0]] * 13)), (2, " ".join([words[1]] * 13)), (3, " ".join([words[0]] * 13))]
    cut = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(_frame(spark, docs)).collect()}
    assert cut == {1: 0, 2: 0, 3: 13}
    near = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(_frame(spark, docs)).collect()}
    assert near == {1: 1, 2: 2, 3: 1}


def test_words_differ_by_length_place_and_trailing_zero_bytes():
    words = ["a", "a\0", "a\0\0", "\0a", "abcdefgh" + "ijklmnop", "ijklmnop" + "abcdefgh", "abcdefgh", "abcdefgh\0", "é", "e"]
    column = pa.array([" ".join(words), "xyz " + " ".join(words)])
    (w,) = words_of(column)
    assert len(set(w.hash[:len(words)].tolist())) == len(words)
    assert w.hash[:len(words)].tolist() == w.hash[len(words) + 1:].tolist()
