"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark, one scan of each text.

Words are the runs of ASCII letters (lower-cased), digits and non-ASCII characters.  A window is ``k`` consecutive
words of a benchmark item; an item of fewer words, but not none, is one window.  The automaton holds each window as
``" w1 w2 ... wk "``; a text is normalised the same way and scanned once, and the ends of the matches are mapped to
word numbers and, for ``spans``, to character offsets of the original text.

The benchmark's size is summed before anything is sent out.  Its items are dealt into blocks of at most
``BLOCK_CHARS`` characters of windows (one automaton each, about 50 bytes a character); with several blocks the texts
pass through one automaton after another.

Cases: null and empty texts have no words and no hits; null items and items without words have no window; an empty
benchmark hits nothing; an item without an id counts as ``null``; repeated rows are judged one by one.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchant_signals.llm.common import arrow_map
from merchant_signals.llm.words import texts_of

#: Bound of the characters of windows in one automaton.
BLOCK_CHARS = 4_000_000

_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b > 127 else 32
                for b in range(256))
_WORD_BYTE = np.frombuffer(_NORMAL, np.uint8) != 32
_automata: dict[str, object] = {}


def norm_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split()


def item_windows(text: str | None, k: int) -> list[tuple[bytes, int]]:
    """Each window as bytes between spaces, with its number of words."""
    w = norm_words(text)
    n = min(k, len(w))
    return [(b" " + b" ".join(w[i:i + n]) + b" ", n) for i in range(len(w) - n + 1)] if n else []


def _automaton(shared):
    """Built once in each Python worker."""
    import ahocorasick

    if (a := _automata.get(shared.value["id"])) is None:
        found: dict[bytes, tuple[int, set]] = {}
        for item, text in shared.value["items"]:
            for win, n in item_windows(text, shared.value["k"]):
                found.setdefault(win, (n, set()))[1].add(item)
        a = ahocorasick.Automaton()
        for win, (n, items) in found.items():
            a.add_word(win.decode("latin-1"), (n, tuple(items)))
        if found:
            a.make_automaton()
        _automata.clear()
        _automata[shared.value["id"]] = a
    return a


def blocks_of(benchmark: DataFrame, k: int, id_col: str, text_col: str, block_chars: int) -> list[DataFrame]:
    """The items in groups of at most about ``block_chars`` characters of windows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), text.alias("text"))
    total = items.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    n = max(1, -(-total * k // block_chars))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [items.where(part == i) if n > 1 else items for i in range(n)]


def find_hits(docs: DataFrame, benchmark: DataFrame, k: int = 10, text_col: str = "text", id_col: str = "item_id",
              item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Adds n_words, n_hit (words inside an occurrence of a window), items (their ids as sorted strings) and spans
    (character ranges of the original text, ``[start, end)``, merged).  Columns of these names are replaced."""
    added = ("n_words", "n_hit", "items", "spans")
    df = docs.select(*[c for c in docs.columns if c.lower() not in added])
    out = T.StructType([*df.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                        T.StructField("items", T.ArrayType(T.StringType())),
                        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                                         T.StructField("end", T.LongType())])))])
    df = df.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                   F.array().cast("array<string>").alias("items"),
                   F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    for block in blocks_of(benchmark, k, id_col, item_text, block_chars):
        # at most block_chars / k characters of items, by the sum above
        shared = docs.sparkSession.sparkContext.broadcast(
            {"id": uuid.uuid4().hex, "k": k, "items": [(r["item"], r["text"]) for r in block.collect()]})

        def scan(b: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            return _scan_batch(b, _automaton(shared), text_col)

        df = arrow_map(df, scan, out)
    return df


def _scan_batch(b: pa.RecordBatch, a, text_col: str) -> pa.RecordBatch:
    data, offset = texts_of(b.column(text_col))
    raw = data.tobytes()
    before_items, before_spans = b.column("items").to_pylist(), b.column("spans").to_pylist()
    n_words, n_hit, items, spans = [], [], [], []
    for i in range(b.num_rows):
        own = raw[offset[i]:offset[i + 1]]
        norm = own.translate(_NORMAL).split()
        n_words.append(len(norm))
        got, ranges = set(before_items[i]), []
        if len(a) and norm:
            joined = b" " + b" ".join(norm) + b" "
            for end, (n, ids) in a.iter(joined.decode("latin-1")):
                got.update(ids)
                ranges.append((end, n))
        if not ranges and not before_spans[i]:
            n_hit.append(0), items.append(sorted(got)), spans.append([])
            continue
        # word numbers: the match that ends at the space behind word e covers words e-n+1 .. e
        hit = np.zeros(len(norm) + 1, np.int64)
        if ranges:
            space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
            last = np.searchsorted(space, np.array([e for e, _ in ranges]))
            np.add.at(hit, last - np.array([n for _, n in ranges]), 1)
            np.add.at(hit, last, -1)
        hit = np.cumsum(hit[:-1]) > 0
        # byte offsets of the words, then characters
        byte = np.frombuffer(own, np.uint8)
        inside = np.concatenate([[False], _WORD_BYTE[byte], [False]])
        start, stop = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
        char = np.concatenate([[0], np.cumsum((byte & 0xC0) != 0x80)])
        for s in before_spans[i]:
            hit |= (char[start] >= s["start"]) & (char[stop] <= s["end"])
        edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
        n_hit.append(int(hit.sum()))
        items.append(sorted(got))
        spans.append([{"start": int(char[start[x]]), "end": int(char[stop[y]])} for x, y in zip(lo, hi)])
    new = {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
           "items": pa.array(items, pa.list_(pa.string())),
           "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))}
    return pa.RecordBatch.from_arrays([new.get(c, b.column(c)) for c in b.schema.names], names=b.schema.names)


def report(hits: DataFrame) -> DataFrame:
    """The digest columns of the query."""
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))
