"""WARC archive, token rollups, packing and URL filters."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from merchant_signals.llm import packing, token_rollup, tokens, url_filter, warc
from tests.llm import brute

PAGES = "page_id bigint, url string, html string"


def test_archive_round_trip(spark, tmp_dir):
    rows = [(1, "http://a/", "x"), (5, "http://b/", "x"), (3, None, "x"), (2, "http://c/\r\nX: 1", "ü" * 9), (4, "u", None), (9, "u", ""),
            (8, "u", "y" * 200_000), (7, "u", "\r\n\r\nWARC/1.1\r\n"), (6, "u", "z")]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    warc.write_archive(pages, f"{tmp_dir}/a")
    got = {r["page_id"]: tuple(r)[1:] for r in warc.read_archive(spark, f"{tmp_dir}/a").collect()}
    top = {}
    for i, _, t in rows:
        top[t or ""] = max(top.get(t or "", 0), i)
    for i, _, t in rows:
        body = (t or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        last = top[t or ""]
        assert got[i] == (len(body), digest, "response" if i == last else "revisit", None if i == last else last)
    assert spark.read.parquet(f"{tmp_dir}/a/payloads").count() == len(top)
    for r in warc.records(spark, f"{tmp_dir}/a").collect():
        fields, payload = warc.parse_record(bytes(r["record"]))
        page = int(fields["warc-record-id"][10:-1])
        url, text = next((u, t) for i, u, t in rows if i == page)
        if r["kind"] == "response":
            assert payload == (text or "").encode()
        assert fields.get("warc-target-uri") == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
    # small payloads are all responses
    warc.write_archive(pages, f"{tmp_dir}/b", min_bytes=2)
    kinds = {r["page_id"]: r["record_type"] for r in warc.read_archive(spark, f"{tmp_dir}/b").collect()}
    assert set(kinds.values()) == {"response"}


def test_archive_cases(spark, tmp_dir):
    warc.write_archive(spark.createDataFrame([], PAGES), f"{tmp_dir}/e")
    assert warc.read_archive(spark, f"{tmp_dir}/e").collect() == []
    rows = [(1, "u", "x", "k"), (1, "u", "x", "k"), (None, "u", "x", "k"), (None, None, "only", "k")]
    warc.write_archive(spark.createDataFrame(rows, PAGES + ", digest string"), f"{tmp_dir}/d")
    got = sorted(((r[0], r[3], r[4]) for r in warc.read_archive(spark, f"{tmp_dir}/d").collect()), key=str)
    assert got == sorted([(1, "response", None), (1, "response", None), (None, "revisit", 1), (None, "response", None)], key=str)
    broken = spark.read.parquet(f"{tmp_dir}/d/payloads").withColumn("gz", F.first("gz").over(__import__("pyspark").sql.Window.orderBy("digest").rowsBetween(-9, 9)))
    broken.write.parquet(f"{tmp_dir}/x/payloads")
    spark.read.parquet(f"{tmp_dir}/d/headers").write.parquet(f"{tmp_dir}/x/headers")
    with pytest.raises(Exception, match="payload"):
        warc.read_archive(spark, f"{tmp_dir}/x")


DOCS = "doc_id bigint, text string, source string, lang string"


def _totals(rollup):
    return {(r["source"], r["lang"], r["tokenizer_version"]): (r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect()}


def test_rollup_follows_inserts_revisions_and_deletes(spark, tmp_dir):
    rng, now = random.Random(1), {}
    rollup = token_rollup.TokenRollup(spark, f"{tmp_dir}/r")
    assert _totals(rollup) == {}
    for batch in range(4):
        rows = [(rng.randrange(40), " ".join("w" * rng.randint(0, 9)), rng.choice(["s", "t", None]), rng.choice(["en", None])) for _ in range(15)]
        rows = list({r[0]: r for r in rows}.values())
        gone = rng.sample(range(40), 6) if batch else []
        up = token_rollup.counted(spark.createDataFrame(rows, DOCS), "words", token_rollup.word_counter)
        deletes = spark.createDataFrame([(d, "words") for d in gone], "doc_id bigint, tokenizer_version string") if gone else None
        assert rollup.apply(f"b{batch}", up, deletes)
        assert not rollup.apply(f"b{batch}", up, deletes)
        now.update({r[0]: r for r in rows})
        for d in gone:
            now.pop(d, None)
        want = {}
        for _, t, s, lang in now.values():
            n, m = want.get((s, lang, "words"), (0, 0))
            want[s, lang, "words"] = (n + 1, m + len(t.split()))
        assert _totals(rollup) == want


def test_a_broken_batch_is_applied_again(spark, tmp_dir, monkeypatch):
    rollup = token_rollup.TokenRollup(spark, f"{tmp_dir}/r")
    one = token_rollup.counted(spark.createDataFrame([(1, "a b", "s", "en"), (2, None, "s", "en")], DOCS), "words", token_rollup.word_counter)
    two = token_rollup.counted(spark.createDataFrame([(1, "a b c d", "s", "en")], DOCS), "words", token_rollup.word_counter)
    rollup.apply("one", one)
    with monkeypatch.context() as m:
        m.setattr(rollup, "totals", lambda: 1 / 0)  # after the ledger is written, before the totals are
        with pytest.raises(ZeroDivisionError):
            rollup.apply("two", two)
    assert _totals(rollup) == {("s", "en", "words"): (2, 2)}
    assert rollup.apply("two", two)
    assert _totals(rollup) == {("s", "en", "words"): (2, 4)}


def test_rollup_cases(spark, tmp_dir):
    rollup = token_rollup.TokenRollup(spark, f"{tmp_dir}/r")
    empty = token_rollup.counted(spark.createDataFrame([], DOCS), "words", token_rollup.word_counter)
    assert rollup.apply("empty", empty) and _totals(rollup) == {}
    rows = [(1, "a", "s", "en", 9), (1, "a b", "s", "en", 9), (None, "a b c", None, None, 9), (None, "a b c", None, None, 9)]
    up = token_rollup.counted(spark.createDataFrame(rows, DOCS + ", n_tokens int"), "words", token_rollup.word_counter)
    assert rollup.apply("odd", up) and _totals(rollup) == {("s", "en", "words"): (1, 2), (None, None, "words"): (1, 3)}
    none = spark.createDataFrame([(77, "words"), (None, "words")], "doc_id bigint, tokenizer_version string")
    assert rollup.apply("gone", None, none) and _totals(rollup) == {("s", "en", "words"): (1, 2)}


def test_piecewise_encoding_equals_the_tokenizers(monkeypatch):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.word_bpe_path())
    own = tokens.PieceEncoder(tokens.word_bpe_path())
    texts = [t or "" for _, t in brute.corpus(40)] + [
        "It's Größe, ÉTÉ. İI ΑΣ ΣΑΣ ẛ̣ ﬁ ½ K Å", "a\x1cb c\x85d\u00a0e\u2028f", "x<|endoftext|>y <|endoftext|>", "a. ,, .a a.b ... 12.5, ªº µ", "e ́a ̸b"]
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 50)
    for t in texts * 2:
        assert own.encode(t.encode()) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def _check_packing(rows, docs, max_len=4096, end_id=1):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.word_bpe_path())
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, t in docs:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, end_id], "<u4")
        want = [(k, s, len(ids[s:s + max_len]), zlib.crc32(ids[s:s + max_len].tobytes())) for k, s in enumerate(range(0, len(ids), max_len))]
        assert sorted(pieces[d]) == want
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= max_len
    total = sum(n for own in places.values() for _, n in own)
    return len(places), -(-total // max_len)


def test_packing(spark):
    docs = brute.corpus(120, 4)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    n, least = _check_packing(packing.pack(df, tokens.word_bpe_path()).collect(), docs)
    assert n <= least + 1
    rows = packing.pack(df, tokens.word_bpe_path(), max_len=64, with_ids=True).collect()
    n, least = _check_packing(rows, docs, 64)
    assert n <= 1.05 * least + 1
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)


def test_packing_cases(spark):
    ddl = "doc_id bigint, text string, length string, offset string"
    assert packing.pack(spark.createDataFrame([], ddl), tokens.word_bpe_path()).collect() == []
    rows = [(1, "a", "x", "y"), (1, "a", "x", "y"), (None, None, None, None), (2, "", None, None)]
    got = packing.pack(spark.createDataFrame(rows, ddl), tokens.word_bpe_path()).collect()
    assert sorted(r["length"] for r in got) == [1, 1, 2, 2] and len({r["sequence_id"] for r in got}) == 1
    assert sorted(r["offset"] + r["length"] for r in got)[-1] == 6


@pytest.mark.parametrize("lengths", [[4000, 100, 96, 2048, 2048], [1] * 5000, [4096] * 9, [1366] * 30 + [1365] * 60, list(range(1, 4097, 3)),
                                     [3000] * 400 + [1096] * 390 + [500] * 20])
def test_plan_places_every_piece_once(lengths):
    count = np.bincount(lengths, minlength=4097)
    rows = packing.plan(count, 4096)
    spans, taken = {}, np.zeros(4097, np.int64)
    for k, (length, rank, copies, seq, offset) in enumerate(rows):
        last = rows[k + 1][1] if k + 1 < len(rows) and rows[k + 1][0] == length else count[length]
        assert rank == taken[length] and (last - rank) % copies == 0
        taken[length] = last
        for s in range((last - rank) // copies):
            spans.setdefault(seq + s, []).append((offset, copies * length))
    assert (taken == count).all()
    for own in spans.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 4096
    # best fit decreasing, as a yardstick
    room = []
    for x in sorted(lengths, reverse=True):
        fit = min((r for r in room if r >= x), default=None)
        if fit is None:
            room.append(4096 - x)
        else:
            room[room.index(fit)] -= x
    assert len(spans) <= 1.02 * len(room) + 1


def test_nnls_solves_small_systems():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, x = rng.random((8, 12)), np.where(rng.random(12) < 0.4, rng.random(12), 0)
        got = packing.nnls(a, a @ x)
        assert (got >= 0).all() and np.allclose(a @ got, a @ x, atol=1e-6)


def test_piece_ids_and_counts_agree():
    docs = [t for _, t in brute.corpus(20)]
    counts = token_rollup.bpe_counter(tokens.word_bpe_path())(pa.array(docs))
    enc = tokens.encoder(tokens.word_bpe_path())
    assert counts.tolist() == [len(enc.encode((t or "").encode())) // 4 for t in docs]
    assert token_rollup.word_counter(pa.array(docs)).tolist() == [len(brute.words(t)) for t in docs]


def _verdict(url, rules):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url[url.index("://") + 3:]
    host = rest
    for c in "/?#":
        host = host.partition(c)[0]
    path = rest[len(host):].partition("?")[0].partition("#")[0]
    host = host.translate(brute.LOWER)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("org", "/fr/a", "block"), ("a.org", "", "block"), ("b.org", "/x", "allow"), ("b.org", "/x", "block")]


def test_urls_match_brute_force(spark):
    rng = random.Random(2)
    hosts = ["net", "example.net", "A.Example.NET", "xexample.net", "example.com", "www.example.com:80", "a.org", "x.a.org", "b.org", "org.", "", "fr.org", "nét"]
    paths = ["", "/", "/en/", "/en", "/en/1?x=/de/", "/de/#a", "/fr/ab", "/fr/b", "/fr/a/b/c/d", "//en/", "/x", "/xy/z", "?q=/", "#/en/"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "://", "a://b://c/d", "http://net/\n/en"]
    urls += urls[:20]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rules = spark.createDataFrame(RULES + RULES[:2], "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(df, rules).collect()}
    assert got == {i: _verdict(u, RULES) for i, u in enumerate(urls)}


def test_url_cases(spark):
    ddl = "host string, path string, verdict string"
    rules = spark.createDataFrame([("net", None, "block"), (None, "/", "block")], ddl)
    pages = spark.createDataFrame([(1, "http://a.net/x", "mine"), (1, "http://a.net/x", "mine")], "page_id bigint, url string, host string")
    rows = url_filter.filter_urls(pages, rules).collect()
    assert rows[0] == rows[1] and (rows[0]["host"], rows[0]["rule"], rows[0]["verdict"]) == ("a.net", "net", "block")
    assert {r["verdict"] for r in url_filter.filter_urls(pages, rules.limit(0)).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), rules).collect() == []
    assert "Python" not in url_filter.filter_urls(pages, rules)._jdf.queryExecution().toString()


def test_urls_expand_to_the_depths_of_rules_only(spark):
    rules = [("net", "/" * 3, "block"), ("a.b.net", "/x/", "allow"), ("É.net", "/", "block")]
    urls = ["http://a.b.net/x/" + "y/" * 50000, "http://" + "z." * 20000 + "net///", "http://É.net/", "http://é.net/", "http://net//"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in url_filter.filter_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert got == {i: _verdict(u, rules) for i, u in enumerate(urls)}
    assert [got[i][2] for i in range(5)] == ["a.b.net/x/", "net///", "É.net/", None, None]


def test_token_query_equals_a_recount(spark, tmp_dir):
    from merchant_signals.llm.queries import op7_token_counts

    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "βeta", "7", "x-y"]) for _ in range(rng.randrange(30))), f"s{rng.randrange(3)}", rng.choice(["en", None]))
            for i in range(200)] + [(500, None, "s0", "en"), (None, "no id", None, "de")]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    got = {(r["source"], r["lang"], r["tokenizer_version"]): (r["n_docs"], r["n_tokens"]) for r in op7_token_counts(spark, tmp_dir).collect()}
    want = {}
    enc = tokens.encoder(tokens.word_bpe_path())
    for _, text, source, lang in rows:
        for version, n in (("words", len((text or "").split())), ("word_bpe_49k", len(enc.encode((text or "").encode())) // 4)):
            d, t = want.get((source, lang, version), (0, 0))
            want[source, lang, version] = (d + 1, t + n)
    assert got == want
