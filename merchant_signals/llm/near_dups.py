"""N-gram Jaccard join by parity sketches: exact links and components of near-equal texts.

A text's set holds its distinct ``k``-word shingles (a text of fewer words, but not none, has one of all its words).
Texts link when ``den * |A and B| >= num * |A or B|``.

*Sketch.* Every shingle is hashed to one bit of a sketch and flips it, so that the Hamming distance of two sketches
is at most the size of the sets' symmetric difference.  Linked sets differ in at most ``(den - num) / num`` of the
smaller set.  *Bands.* Set sizes fall into bands, each ``RATIO`` times the one below; the sketch of a band has one
block for each possible difference, one more, and ``spare`` more.  By the pigeonhole principle linked sets agree on at
least ``spare + 1`` whole blocks of the smaller one's band, so a set of the next band joins that band's sketch too if
its size allows.  A set with at most ``spare`` empty blocks leaves those out: one block with content still agrees.  A
block's bits are kept as the XOR of a 64-bit code of each of them.

*Join.* A count-min sketch drops the blocks that no other text has (``repeats``).  The smallest id of a block is its
hub, found by a window over the block, and every other text of the block is paired with the hub only.  A sketch of
``PARITY_BITS`` bits of both texts then drops pairs whose Hamming distance exceeds what their sizes allow, and the
sets decide the rest.  Where the verified links leave a block's texts in several components, the pairs of that block
between different components are checked as well, inside a join whose condition is the Hamming distance: no link
between components is lost, and none inside is spent on.  Each text carries the first of its blocks there: a pair that has
met in one of them isn't given out again.  Before texts are fetched, pairs pass sketches as wide as their sets are large:
sketches of one width for all saturate, and let unlinked texts of a thousand shingles through.  Only texts of pairs that
pass are packed and sent.  Both sides of every join grow with the corpus, so all are sorted joins at every size.
Texts with equal sets are linked by a grouping of the sets' 128-bit digests and appear once a batch in the join.

Cases: null and empty texts have no set, link with nothing and are their own component; rows with a null id get no
component; rows with equal ids are one node, and each gets its own count; an empty table gives no rows; further
columns aren't carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchant_signals.llm.common import arrow_map, release, staged
from merchant_signals.llm.components import connected_components
from merchant_signals.llm.repeats import cells_for, repeated, sketch
from merchant_signals.llm.words import mix, texts_of, windows, words_of

#: Least ratio of neighbouring bands' sizes.
RATIO = 1.4
#: Bits of the sketch that pairs are compared by, and of the bitmap of texts that pairs ask for.
PARITY_BITS, ASKED_BITS = 512, 1 << 24
#: A text's first blocks that say whether a pair has met before.
FIRST_BLOCKS = 4
PARITY = [f"p{i}" for i in range(PARITY_BITS // 64)]


@dataclass(frozen=True)
class Rule:
    k: int = 4
    num: int = 85
    den: int = 100

    def bands(self, most: int) -> np.ndarray:
        """Largest size of each band, up to one that holds ``most``."""
        ratio, out = max(RATIO, 1.01 * self.den / self.num), [1]
        while out[-1] < most:
            out.append(max(out[-1] + 1, int(out[-1] * ratio)))
        return np.array(out, np.int64)

    def differences(self, size: np.ndarray) -> np.ndarray:
        """Most shingles by which a set can differ from a linked one that isn't smaller."""
        return size * (self.den - self.num) // self.num


def shingle_sets(column: pa.Array, rule: Rule) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Chunk by chunk: number of the first text, all sets' hashes (each set sorted) and where each set starts."""
    for w in words_of(column, lower=True):
        h, _, row = windows(w, rule.k, whole=True)
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[new], row[new]
        yield w.row0, h, np.searchsorted(row, np.arange(len(w.first)))


def _digests(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sums = []
    for seed in (21, 22):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h, seed), dtype=np.uint64)])
        sums.append(mix(total[first[1:]] - total[first[:-1]], seed))
    return sums[0], sums[1]


def blocks_of(h: np.ndarray, first: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Key of each block that a set joins by, and the set's number."""
    n = np.diff(first)
    keys, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    top = rule.bands(int(n.max(initial=1)))
    own = np.searchsorted(top, n)
    place, code = mix(h, 11), mix(h, 12)
    for down in range(len(top)):
        band = own - down
        part = (n > 0) & (band >= 0)
        if down:
            part &= n * rule.num <= top[np.maximum(band, 0)] * rule.den
        if not part.any():
            break
        at = np.flatnonzero(part)
        differ = rule.differences(top[band[at]])
        spare = np.where(differ > 0, 1 + differ // 10, 0)
        size = differ + 1 + spare
        base = np.concatenate([[0], np.cumsum(size)])
        # shingles of the sets that take part
        own_h = np.repeat(part, n)
        block = base[:-1].repeat(n[at]) + (place[own_h] % size.repeat(n[at]).astype(np.uint64)).astype(np.int64)
        bits = np.zeros(base[-1], np.uint64)
        np.bitwise_xor.at(bits, block, code[own_h])
        filled = np.bincount(block, minlength=base[-1]) > 0
        empty = np.add.reduceat((~filled).astype(np.int64), base[:-1])
        send = filled | np.repeat(empty > spare, size)
        number = np.arange(base[-1]) - base[:-1].repeat(size)
        name = mix((band[at].astype(np.uint64) << np.uint64(32)).repeat(size) | number.astype(np.uint64), 13)
        keys.append(mix(bits ^ name, 14)[send]), rows.append(at.repeat(size)[send])
    return np.concatenate(keys), np.concatenate(rows)


def _distinct_blocks(b: pa.RecordBatch, rule: Rule) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and ids of the blocks of a batch (id, text); of equal sets the smallest id's only."""
    doc = b.column(0).to_numpy(zero_copy_only=False)
    parts = list(shingle_sets(b.column(1), rule))
    digest = [_digests(h, first) for _, h, first in parts]
    one, two = (np.concatenate([np.zeros(0, np.uint64), *(d[i] for d in digest)]) for i in (0, 1))
    order = np.lexsort((doc, two, one))
    first_of = np.zeros(len(doc), bool)
    if len(doc):
        o1, o2 = one[order], two[order]
        first_of[order] = np.concatenate([[True], (o1[1:] != o1[:-1]) | (o2[1:] != o2[:-1])])
    for row0, h, first in parts:
        key, row = blocks_of(h, first, rule)
        own = first_of[row0 + row]
        yield key[own], doc[row0 + row[own]]


def _sets(b: pa.RecordBatch, rule: Rule) -> pa.RecordBatch:
    """doc_id, size, 128-bit digest and parity sketch of each text's set."""
    parts = [np.column_stack([np.diff(first).astype(np.uint64), *_digests(h, first), _parity(h, first)])
             for _, h, first in shingle_sets(b.column(1), rule)]
    cols = np.concatenate([np.zeros((0, 3 + len(PARITY)), np.uint64), *parts]).T
    return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in cols)],
                                      names=["doc_id", "n", "d1", "d2", *PARITY])


def _parity(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A sketch of PARITY_BITS bits for each set, as 64-bit words."""
    out = np.zeros((len(first) - 1, PARITY_BITS // 64), np.uint64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    p = mix(h, 31) % np.uint64(PARITY_BITS)
    np.bitwise_xor.at(out, (row, (p >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (p & np.uint64(63)))
    return out


def _wide(h: np.ndarray) -> bytes:
    """A set's parity sketch of at least a bit a shingle."""
    bits = max(PARITY_BITS, 1 << int(len(h) - 1).bit_length())
    return np.packbits(np.bincount((mix(h, 32) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def _distance(x: bytes, y: bytes) -> int:
    """Hamming distance of two sketches; the wider one is folded to the width of the other."""
    x, y = (np.frombuffer(v, np.uint8) for v in sorted((x, y), key=len))
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), 0)).sum())


def _asked(ids: DataFrame) -> np.ndarray:
    """A bitmap of hashed ids, ASKED_BITS / 8 bytes however many there are."""
    p = ids.select(F.pmod(F.xxhash64("id"), F.lit(ASKED_BITS)).cast("int").alias("p"))
    bits = np.zeros(ASKED_BITS, bool)
    for r in p.groupBy(F.floor(F.col("p") / 4096)).agg(F.collect_set("p").alias("p")).toLocalIterator():
        bits[r["p"]] = True
    return np.packbits(bits)


def _near(rule: Rule) -> Column:
    """Whether the sets of sizes na and nb with sketches pa and pb may link: linked sets differ by at most
    (den - num) / (den + num) of both sizes together, and the distance of the sketches is no larger."""
    distance = sum((F.bit_count(F.col(f"a{p}").bitwiseXOR(F.col(f"b{p}"))) for p in PARITY), F.lit(0))
    return ((distance * (rule.den + rule.num) <= (F.col("na") + F.col("nb")) * (rule.den - rule.num))
            & (F.least("na", "nb") * rule.den >= F.greatest("na", "nb") * rule.num))


def _sketches(sets: DataFrame, x: str) -> DataFrame:
    return sets.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), *[F.col(p).alias(f"{x}{p}") for p in PARITY])


def _meet(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str = "inner") -> DataFrame:
    """A sorted join: neither side has a bound, so neither is broadcast, however small it is here."""
    return left.join(right.hint("merge"), on, how)


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()


def _asked_texts(pairs: DataFrame, docs: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, name: str) -> DataFrame:
    """``f`` of the texts (doc_id, text) that the pairs ask for."""
    asked = docs.sparkSession.sparkContext.broadcast(_asked(_ids(pairs)))
    hashed = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(ASKED_BITS)).cast("int").alias("p"))

    def wanted(b: pa.RecordBatch) -> pa.RecordBatch:
        p = b.column(2).to_numpy(zero_copy_only=False)
        return f(b.filter(pa.array((asked.value[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1 == 1)))

    return staged(arrow_map(hashed, wanted, schema), name)


def verify(near: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Of the pairs (a, b) of ids of docs (id, text), those that link."""

    def sketched(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = [x for _, h, first in shingle_sets(b.column(1), rule) for x in np.split(h, first[1:-1])]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([_wide(x) for x in sets], pa.binary())],
                                          names=["doc_id", "n", "wide"])

    def packed(b: pa.RecordBatch) -> pa.RecordBatch:
        data, offset = texts_of(b.column(1))
        pack = zstandard.ZstdCompressor(3).compress
        z = [pack(data[offset[i]:offset[i + 1]].tobytes()) for i in range(b.num_rows)]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(z, pa.binary())], names=["doc_id", "data"])

    def close(b: pa.RecordBatch) -> pa.RecordBatch:
        """Pairs whose wide sketches are no further apart than their sizes allow."""
        na, nb, wa, wb = (b.column(k).to_pylist() for k in range(2, 6))
        fits = [_distance(x, y) * (rule.den + rule.num) <= (m + n) * (rule.den - rule.num) for m, n, x, y in zip(na, nb, wa, wb)]
        return b.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    def sets_of(column: pa.Array) -> list[np.ndarray]:
        unpack = zstandard.ZstdDecompressor().decompress
        texts = pa.array([unpack(x.as_py()) for x in column], pa.large_binary()).cast(pa.large_string())
        return [x for _, h, first in shingle_sets(texts, rule) for x in np.split(h, first[1:-1])]

    def equal(b: pa.RecordBatch) -> pa.RecordBatch:
        fits = np.zeros(b.num_rows, bool)
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            for k, (x, y) in enumerate(zip(sets_of(part.column(2)), sets_of(part.column(3))), i):
                common = len(np.intersect1d(x, y, assume_unique=True))
                fits[k] = common > 0 and rule.den * common >= rule.num * (len(x) + len(y) - common)
        return b.select(["a", "b"]).filter(pa.array(fits))

    wide = _asked_texts(near, docs, sketched, "doc_id bigint, n bigint, wide binary", "asked-sketches")
    a, b = (wide.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("wide").alias(f"w{x}")) for x in "ab")
    few = staged(arrow_map(_meet(_meet(near, a, "a"), b, "b").select("a", "b", "na", "nb", "wa", "wb"), close, "a bigint, b bigint"), "close-pairs")
    texts = _asked_texts(few, docs, packed, "doc_id bigint, data binary", "asked-texts")
    a, b = (texts.select(F.col("doc_id").alias(x), F.col("data").alias(f"d{x}")) for x in "ab")
    links = staged(arrow_map(_meet(_meet(few, a, "a"), b, "b").select("a", "b", "da", "db"), equal, "a bigint, b bigint"), "verified")
    release(wide, few, texts)
    return links


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links) of every row."""
    spark = docs.sparkSession
    every = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    own = every.where(F.col("doc_id").isNotNull())
    schema = ", ".join(f"{c} bigint" for c in ["doc_id", "n", "d1", "d2", *PARITY])
    sets = staged(arrow_map(every, lambda b: _sets(b, rule), schema), "sets")

    # equal sets
    some = sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    first = some.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("first"))
    copies = _meet(some, first, ["n", "d1", "d2"]).where(F.col("doc_id") != F.col("first")).select(
        F.col("doc_id").alias("a"), F.col("first").alias("b"))

    # blocks that several texts have
    bits = spark.sparkContext.broadcast(sketch(own, lambda b: (key for key, _ in _distinct_blocks(b, rule)),
                                               cells_for(own, "text", 1.5)))

    def live(b: pa.RecordBatch) -> pa.RecordBatch:
        keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for key, doc in _distinct_blocks(b, rule):
            kept = repeated(key, bits.value)
            keys.append(key[kept]), ids.append(doc[kept])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(ids))],
                                          names=["block", "doc"])

    blocks = staged(arrow_map(own, live, "block bigint, doc bigint"), "blocks")
    of_block = Window.partitionBy("block")  # each row is sent once
    members = staged(blocks.select("block", "doc", F.min("doc").over(of_block).alias("hub"), F.max("doc").over(of_block).alias("last"),
                                   F.count(F.lit(1)).over(of_block).alias("texts"))
                     .where(F.col("hub") < F.col("last")).drop("last"), "members")
    release(blocks)
    near = members.where(F.col("doc") != F.col("hub")).select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct()
    near = _meet(_meet(near, _sketches(some, "a"), "a"), _sketches(some, "b"), "b").where(_near(rule)).select("a", "b")
    near = staged(near, "near-pairs")
    links = verify(near, own, rule)
    found = connected_components(links.unionByName(copies))

    # blocks of three texts and more that are still in several components; of two texts the hub's pair is all
    part = found.select(F.col("node").alias("doc"), F.col("component").alias("c"))
    told = staged(_meet(members.where(F.col("texts") > 2).select("block", "doc"), part, "doc", "left")
                  .select("block", "doc", F.coalesce("c", "doc").alias("c")), "told")
    rest = staged(told.select("block", "doc", "c", F.min("c").over(of_block).alias("lo"), F.max("c").over(of_block).alias("hi"))
                  .where(F.col("lo") < F.col("hi")).select("block", "doc", "c"), "apart")
    release(members, told, near)
    lows = rest.groupBy("doc").agg(F.array_sort(F.collect_set("block")).alias("k")).select("doc", F.slice("k", 1, FIRST_BLOCKS).alias("k"))
    left, right = (_meet(_meet(rest, lows, "doc").select(F.col("block").alias(f"block{x}"), F.col("doc").alias(x), F.col("c").alias(f"c{x}"),
                                                         F.col("k").alias(f"k{x}")), _sketches(some, x), x) for x in "ab")
    met = F.exists(F.array_intersect("ka", "kb"), lambda k: k < F.col("blocka"))  # in a block before this one
    cross = _meet(left, right, (F.col("blocka") == F.col("blockb")) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
                  & _near(rule) & ~met).select("a", "b").distinct()
    cross = staged(cross, "cross-pairs")
    more = verify(cross, own, rule)
    if more.limit(1).count():
        found = connected_components(links.unionByName(more).unionByName(copies))
    release(rest, cross, links, more)

    node = found.select(F.col("node").alias("doc_id"), "component")
    return _meet(sets, node, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
