"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, and in how many documents.

A text is encoded by A (byte-level BPE) and by B (sentence pieces).  Where a token of A and one of B end at the same byte,
a *group* ends; a *link* is a pair of occurrences whose byte ranges overlap.  The ends of both tokenizers cut a text into
segments, and every link is one segment: the tokens that cover it.

Texts are encoded whole, once; their ids are written.  Both passes align them in numpy, a few hundred thousand tokens at a time:
the ends of all tokens are marked on one line of bytes, on which a text's end is an end of both tokenizers.

*Counts.* The first pass aligns every document and writes, for each task, the pairs of ids that it met and in how many
documents.  A minimal perfect hash of the distinct pairs (``mph``) numbers them; tasks add their counts up in dense
vectors indexed by it, and the vectors are summed in a tree of ``FAN_IN``.  The second pass aligns again and looks the
counts up by the same hash; the keys stored at its places are compared, so a foreign pair is an error, not a wrong count.
Hash, keys and counts are broadcast (about 18 bytes a pair) if there are at most ``max_pairs`` pairs; above that, the second pass
gives each document's pairs as rows and a join adds the counts.

Cases: null and empty texts, and those whose tokens don't spell a space and the text (U+2581 is a space to B), have no tokens; rows are
documents, whatever their ids; an empty table gives none; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_signals.llm.common import give_back, release, ship_package, staged
from merchant_signals.llm.mph import Hash, build_mph
from merchant_signals.llm.tokens import _byte_characters
from merchant_signals.llm.words import chunks, texts_of

#: A pair of ids in one number.
SHIFT = 20
#: Distinct pairs that a task keeps before it writes their counts.
FLUSH = 1 << 21
#: Vectors that one task of the tree adds up, and pairs of one vector.
FAN_IN, SPAN = 16, 1 << 14
#: Pairs whose hash, keys and counts are broadcast (72 MB).
MAX_PAIRS = 4_000_000

#: A's own library gives the same ids in half the time as this one, but not for runs of white space that exhaust its stack.
_LONG_SPACE = re.compile(r"\s{1000}")


class Tokenizers:
    """Both vocabularies: ids, bytes and byte lengths of tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(a_path)
        self.whole.encode_special_tokens = True
        own = {c: bytes([b]) for b, c in enumerate(_byte_characters())}
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = b"".join([own[c] for c in entry])
        merges = json.loads(Path(a_path).read_bytes())["model"]["merges"]
        merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
        # ids that ascend with the merges are their ranks
        ranked = [vocabulary[m] for m in merged] == list(range(256, 256 + len(merged)))
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                      mergeable_ranks={x: i for i, x in enumerate(self.a_bytes)}) if ranked else None
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.kind = np.dtype("<u2" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "<u4")  # of written ids
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        n = max(len(self.a_bytes), len(self.b_bytes))
        text = np.arange(n).astype("S")
        self.digits = text.view(np.uint8).reshape(n, -1)
        self.n_digits = np.char.str_len(text).astype(np.int64)

    def encode_a(self, text: str) -> list[int]:
        if self.fast is None or _LONG_SPACE.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of a space and the text by A and by B, none if they don't spell it."""
        if not text:
            return [], []
        a, b, whole = self.encode_a(" " + text), self.b.encode(text), b" " + text.encode()
        spells = b"".join(map(self.a_bytes.__getitem__, a)) == whole == b"".join(map(self.b_bytes.__getitem__, b))
        return (a, b) if spells else ([], [])


_loaded: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Tokenizers(a_path, b_path)
    return _loaded[a_path, b_path]


@dataclass
class Aligned:
    """Texts one after another: their tokens, and of each segment (link) the ids."""

    a: np.ndarray
    b: np.ndarray
    a_first: np.ndarray  # number of each text's first token, and of all tokens
    b_first: np.ndarray
    a_group: np.ndarray  # number of the group of each token, over all texts
    b_group: np.ndarray
    group_first: np.ndarray
    link: np.ndarray  # pair of ids of each link
    link_first: np.ndarray


def align_tokens(t: Tokenizers, a: np.ndarray, b: np.ndarray, first: np.ndarray) -> Aligned:
    """Texts' ids one after another; first: of each text its first token of A and of B, and the numbers of all."""
    a_end, b_end = np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b])
    mark = np.zeros(int(a_end[-1]) + 1 if len(a) else 1, np.uint8)
    mark[a_end] = 1
    mark[b_end] |= 2
    ends = np.flatnonzero(mark)  # of the segments
    kind = mark[ends]
    is_a, is_b, both = kind & 1, kind >> 1, kind == 3
    link = (a[np.cumsum(is_a, dtype=np.int64) - is_a] << SHIFT) | b[np.cumsum(is_b, dtype=np.int64) - is_b]
    groups = np.concatenate([[0], np.cumsum(both, dtype=np.int64)])  # ended up to each segment
    link_first = np.searchsorted(ends, np.concatenate([[0], a_end])[first[:, 0]], "right")
    return Aligned(a, b, first[:, 0], first[:, 1], groups[:-1][is_a > 0], groups[:-1][is_b > 0], groups[link_first], link, link_first)


def group_texts(t: Tokenizers, x: Aligned) -> list[str]:
    """Of each text its groups: ``a1,a2|b1;a3|b2``.  The ids are put in the order of the text and written digit by digit."""
    every = np.arange(int(x.group_first[-1]) + 1)
    a_of, b_of = np.searchsorted(x.a_group, every), np.searchsorted(x.b_group, every)  # first token of each group
    a_at = np.arange(len(x.a)) + b_of[x.a_group]
    b_at = np.arange(len(x.b)) + a_of[x.b_group + 1]
    ids, end = np.empty(len(x.a) + len(x.b), np.int64), np.full(len(x.a) + len(x.b), ord(","), np.uint8)
    ids[a_at], ids[b_at] = x.a, x.b
    end[a_at[a_of[1:] - 1]] = ord("|")
    end[b_at[b_of[1:] - 1]] = ord(";")
    n = t.n_digits[ids]
    after = np.cumsum(n + 1)
    out = np.empty(int(after[-1]) if len(after) else 0, np.uint8)
    out[after - 1] = end
    start = after - 1 - n
    for k in range(t.digits.shape[1]):
        own = n > k
        out[start[own] + k] = t.digits[ids[own], k]
    edge = np.concatenate([[0], after])[x.a_first + x.b_first].tolist()
    data = out.tobytes()
    return [data[i:j - 1].decode() if j > i else "" for i, j in zip(edge, edge[1:])]


def _encoded(a_path: str, b_path: str, names: list[str]):
    """Batches of text and other columns -> the other columns and the text's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(a_path, b_path)
        for batch in batches:
            for i, j in chunks(texts_of(batch.column(0))[1]):
                found = [t.encode(x) for x in batch.column(0).slice(i, j - i).to_pylist()]
                ids = [pa.array([np.array(x, t.kind).tobytes() for x in own], pa.binary()) for own in zip(*found)]
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(i, j - i) for k in range(1, batch.num_columns)] + ids, names=names)
        give_back()

    return run


def _aligned(t: Tokenizers, batch: pa.RecordBatch) -> Iterator[tuple[int, int, Aligned]]:
    """Ranges of a batch of ids (a, b, ...), aligned; what a worker aligns at once is about a megabyte of ids, a longer text is alone."""

    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        wide = column.cast(pa.large_binary())
        offset = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
        data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)
        return data, offset

    (data_a, at_a), (data_b, at_b) = flat(batch.column(0)), flat(batch.column(1))
    for i, j in chunks(at_a):
        a, b = (d[x[i]:x[j]].copy().view(t.kind).astype(np.int64) for d, x in ((data_a, at_a), (data_b, at_b)))
        first = np.stack([(x[i:j + 1] - x[i]) // t.kind.itemsize for x in (at_a, at_b)], 1)
        yield i, j, align_tokens(t, a, b, first)


def _tally(a_path: str, b_path: str):
    """Batches of ids -> pair, docs: in how many of the task's documents a pair is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(a_path, b_path)
        pairs, docs, waiting, n = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def settle() -> None:
            nonlocal pairs, docs, waiting, n
            met = np.sort(np.concatenate([pairs, *waiting]), kind="stable")
            edge = np.flatnonzero(np.diff(met, prepend=-1))
            count = np.diff(edge, append=len(met))
            count[np.searchsorted(met[edge], pairs)] += docs - 1
            pairs, docs, waiting, n = met[edge], count, [], 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(docs)], names=["pair", "docs"])

        for batch in batches:
            for i, j, x in _aligned(t, batch):
                row = np.repeat(np.arange(j - i), np.diff(x.link_first))
                own = np.sort((row << 2 * SHIFT) | x.link)
                waiting.append(own[np.diff(own, prepend=-1) != 0] & ((1 << 2 * SHIFT) - 1))
                n += len(waiting[-1])
                if n >= FLUSH:
                    settle()
                if len(pairs) >= FLUSH:
                    yield rows()
                    pairs, docs = pairs[:0], docs[:0]
        if waiting:
            settle()
        if len(pairs):
            yield rows()
        give_back()

    return run


def _vectors(hash_: Hash):
    """pair, docs -> task, part, vector: the task's counts as dense vectors of ``SPAN`` pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for b in batches:
            at = hash_.index(b.column(0).to_numpy())
            if (at < 0).any():
                raise KeyError("a pair that isn't in the hash")
            total = np.zeros(hash_.n, np.int64) if total is None else total
            total += np.bincount(at, b.column(1).to_numpy(), hash_.n).astype(np.int64)
        if total is not None:
            parts = [(p, total[p * SPAN:(p + 1) * SPAN]) for p in range(-(-hash_.n // SPAN))]
            parts = [(p, v.tobytes()) for p, v in parts if v.any()]
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([task] * len(parts), pa.int32()), pa.array([p for p, _ in parts], pa.int32()),
                                              pa.array([v for _, v in parts], pa.binary())], names=["task", "part", "vector"])
        give_back()

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by task and part: one vector for each of them."""
    at, total = None, np.zeros(0, np.int64)

    def one() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                          names=["task", "part", "vector"])

    for b in batches:
        for task, part, vector in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            if (task, part) != at:
                if at is not None:
                    yield one()
                at, total = (task, part), np.zeros(len(vector.as_buffer()) // 8, np.int64)
            total = total + np.frombuffer(vector.as_buffer(), np.int64)
    if at is not None:
        yield one()


_VECTOR = "task int, part int, vector binary"


def tree_sum(vectors: DataFrame, tasks: int) -> DataFrame:
    """task, part, vector -> part, vector: ``FAN_IN`` vectors of a part are added at each level."""
    while tasks > 1:
        up = vectors.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
        vectors = up.repartition("task", "part").sortWithinPartitions("task", "part").mapInArrow(_added, _VECTOR)
        tasks = -(-tasks // FAN_IN)
    return vectors.select("part", "vector")


@dataclass
class Counts:
    """In how many documents each pair is linked, by the pairs' hash, and each A id's largest count."""

    hash: Hash
    docs: np.ndarray
    best: np.ndarray

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs' counts and whether they are the largest of their A id."""
        at = self.hash.index(pairs)
        if (at < 0).any():
            raise KeyError("a document links a pair that the first pass didn't meet")
        n = self.docs[at]
        return n, n == self.best[pairs >> SHIFT]


def _measured(a_path: str, b_path: str, counts, named: bool):
    """Batches of ids -> the other columns, n_a, n_b, n_groups, n_links, n_best, count_sum, groups; or, without counts,
    the pairs of a document and their links as two lists in place of n_best and count_sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(a_path, b_path)
        per_text = lambda values, x: np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[x.link_first])
        for batch in batches:
            for i, j, x in _aligned(t, batch):
                columns = [batch.column(k).slice(i, j - i) for k in range(2, batch.num_columns)]
                columns += [pa.array(np.diff(f)) for f in (x.a_first, x.b_first, x.group_first, x.link_first)]
                if counts:
                    n, best = counts.value.of(x.link)
                    columns += [pa.array(per_text(best, x)), pa.array(per_text(n, x))]
                else:
                    own = [np.unique(x.link[y:z], return_counts=True) for y, z in zip(x.link_first, x.link_first[1:])]
                    columns += [pa.array([p[k] for p in own], pa.list_(pa.int64())) for k in (0, 1)]
                columns.append(pa.array(group_texts(t, x), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=named)
        give_back()

    return run


def encode_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a, b: the ids of every document, written."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("doc_id"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(_encoded(a_path, b_path, ["doc_id", "a", "b"]), f"doc_id {kind}, a binary, b binary")
    return staged(found, "align-ids", compression="zstd")


def tally(ids: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """pair, docs, several rows a pair: the first pass, written."""
    return staged(ids.select("a", "b").mapInArrow(_tally(a_path, b_path), "pair bigint, docs bigint"), "align-pairs")


def count_pairs(found: DataFrame, max_pairs: int = MAX_PAIRS) -> Counts | None:
    """tally() -> counts by a minimal perfect hash; None if there are more than ``max_pairs`` pairs."""
    keys = staged(found.select("pair").distinct(), "align-keys")
    n = keys.count()
    if n > max_pairs:
        release(keys)
        return None
    hash_ = build_mph(keys, "pair", n)
    vectors = staged(found.mapInArrow(_vectors(hash_), _VECTOR), "align-vectors")
    tasks = (vectors.agg(F.max("task").alias("t")).first()["t"] or 0) + 1
    docs = np.zeros(n, np.int64)
    for r in tree_sum(vectors, tasks).toLocalIterator():  # n numbers, in parts of SPAN
        docs[r["part"] * SPAN:(r["part"] + 1) * SPAN] = np.frombuffer(bytes(r["vector"]), np.int64)
    release(keys, vectors)
    top = hash_.keys >> SHIFT
    best = np.zeros(int(top.max(initial=0)) + 1, np.int64)
    np.maximum.at(best, top, docs)
    return Counts(hash_, docs, best)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", max_pairs: int = MAX_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (as text) of every document."""
    spark = docs.sparkSession
    ids = encode_documents(docs, a_path, b_path, id_col, text_col)
    found = tally(ids, a_path, b_path)
    counts = count_pairs(found, max_pairs)
    ids = ids.select("a", "b", "doc_id")
    kind = ids.schema["doc_id"].dataType.simpleString()
    plain = ["n_a", "n_b", "n_groups", "n_links"]
    if counts is not None:
        release(found)
        names = ["doc_id", *plain, "n_best", "count_sum", "groups"]
        schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in names[1:-1]) + ", groups string"
        return ids.mapInArrow(_measured(a_path, b_path, spark.sparkContext.broadcast(counts), names), schema)
    names = ["doc_id", *plain, "pairs", "times", "groups"]
    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in plain) + ", pairs array<bigint>, times array<bigint>, groups string"
    own = staged(ids.mapInArrow(_measured(a_path, b_path, None, names), schema).withColumn("_row", F.monotonically_increasing_id()), "align-documents")
    totals = found.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.shiftright("pair", SHIFT))
    totals = staged(totals, "align-totals")
    totals = totals.join(totals.groupBy("a").agg(F.max("docs").alias("best")), "a").select("pair", "docs", (F.col("docs") == F.col("best")).alias("top"))
    rows = own.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("_row", "x.pairs", "x.times")
    sums = rows.join(totals, F.col("pairs") == F.col("pair")).groupBy("_row").agg(
        F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return own.join(sums, "_row", "left").select("doc_id", *plain, zero("n_best"), zero("count_sum"), "groups")
