"""Removal of passages that stand in an earlier document, with a count-min prefilter.

A window is ``k`` consecutive words of one text.  Each word covered by a window whose word sequence also starts in a
document with a smaller id is removed; windows are judged on the input.

1. Each task counts its windows' hashes in two rows of cells, saturating at 2, and sends the cells it met, sorted and
   delta-coded, by block of cells.  The blocks are merged into one bit a cell: met twice or more.  Counts are only
   ever too high, so that no repeated window is lost.  The rows have about four cells for each word of the corpus, at
   most ``repeats.MAX_CELLS``: the merged bits, which are broadcast, never exceed 2 x ``MAX_CELLS`` / 8 bytes.  Beyond that
   size more windows pass the filter; the result stays the same.
2. Only windows whose cells in both rows were met twice are grouped exactly, by 64-bit hash.  Inside a batch all but
   the smallest id of a window are settled at once, so that a passage of any number of documents sends one row a batch.
   Smallest and later ids are written once, by one pass: they come from the same batches, however often rows are read
   and in whichever order.
3. The hashes to be removed meet their texts again by id.

Cases: null and empty texts have no words; a text of fewer than ``k`` words keeps all; a null id counts as the largest
one; rows with equal ids are one document for the rule, and each gets its own result; an empty table gives no rows;
further columns aren't carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_signals.llm.common import arrow_map, give_back, staged
from merchant_signals.llm.repeats import cells_for, repeated, sketch
from merchant_signals.llm.words import mix, texts_of, windows, words_of

#: Words of a window.
WINDOW = 13
_LAST = (1 << 63) - 1


def _pairs(b: pa.RecordBatch, bits: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch (id, text): hash and id of its estimated repeats, sorted, each pair once; which are a hash's first."""
    doc = b.column(0).to_numpy(zero_copy_only=False)
    hs, ds = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for w in words_of(b.column(1)):
        h, _, row = windows(w, k)
        own = repeated(h, bits)
        hs.append(h[own]), ds.append(doc[w.row0 + row[own]])
    h, d = np.concatenate(hs), np.concatenate(ds)
    order = np.lexsort((d, h))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    return h, d, first


def remove_repeats(docs: DataFrame, k: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the kept words, one space between them)."""
    spark = docs.sparkSession
    own = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc_id"),
                      F.col(text_col).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(sketch(
        own.select("text"), lambda b: (windows(w, k)[0] for w in words_of(b.column(0))), cells_for(own, "text", 4.0)))

    def settled(b: pa.RecordBatch) -> pa.RecordBatch:
        """Of each id in a batch, the hashes that it is the smallest id of, and behind a 0 the others."""
        h, d, first = _pairs(b, shared.value, k)
        order = np.lexsort((~first, d))
        h, d, first = h[order], d[order], first[order]
        cut = np.concatenate([np.flatnonzero(np.diff(d, prepend=d[0] - 1)), [len(d)]]) if len(d) else np.zeros(1, np.int64)
        low, high = [], []
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
            mid = lo + int(first[lo:hi].sum())
            low.append(h[lo:mid].tobytes() if mid > lo else None)
            high.append(b"\0" + h[mid:hi].tobytes() if hi > mid else None)
        return pa.RecordBatch.from_arrays([pa.array(d[cut[:-1]], pa.int64()), pa.array(low, pa.binary()), pa.array(high, pa.binary())],
                                          names=["doc_id", "low", "z"])

    def smallest(b: pa.RecordBatch) -> pa.RecordBatch:
        """A row for each hash."""
        low = [np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()]
        d = np.repeat(b.column(0).to_numpy(), [len(x) for x in low])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *low])), pa.array(d)], names=["h", "doc_id"])

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by hash and id, those behind a smaller id of the same hash."""
        last_h, last_d = None, None
        for b in batches:
            h, d = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(h):
                continue
            opens = np.ones(len(h), bool)
            opens[1:] = h[1:] != h[:-1]
            opens[0] = last_h is None or h[0] != last_h
            run = np.cumsum(opens)  # 0: goes on from the batch before
            low = np.concatenate([[0 if last_d is None else last_d], d[opens]])[run]
            out = d > low
            last_h, last_d = h[-1], low[-1]
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(d[out]), pa.array(h[out]), pa.array([None] * int(out.sum()), pa.binary())],
                                                 names=["doc_id", "h", "z"])

    def packed(b: pa.RecordBatch) -> pa.RecordBatch:
        data, offset = texts_of(b.column(1))
        zip_ = zstandard.ZstdCompressor(3)
        z = [b"\1" + zip_.compress(data[offset[i]:offset[i + 1]].tobytes()) for i in range(b.num_rows)]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([None] * len(z), pa.int64()), pa.array(z, pa.binary())],
                                          names=["doc_id", "h", "z"])

    schema = "doc_id bigint, h bigint, z binary"
    once = staged(arrow_map(own, settled, "doc_id bigint, low binary, z binary"), "substring-windows")
    removed = (arrow_map(once.where(F.col("low").isNotNull()).select("doc_id", "low"), smallest, "h bigint, doc_id bigint")
               .repartition("h").sortWithinPartitions("h", "doc_id").mapInArrow(later, schema))
    others = once.where(F.col("z").isNotNull()).select("doc_id", F.lit(None).cast("long").alias("h"), "z")
    rows = removed.unionByName(others).unionByName(arrow_map(own, packed, schema))
    rows = rows.repartition("doc_id").sortWithinPartitions("doc_id", F.col("h").isNull(), F.substring("z", 1, 1))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A document's hashes stand before its texts."""
        at, hashes = None, [np.zeros(0, np.uint64)]
        for b in batches:
            doc, h, z = b.column(0).to_numpy(), b.column(1), b.column(2)
            is_hash = np.array(h.is_valid())
            value = h.fill_null(0).to_numpy().view(np.uint64)
            edge = np.flatnonzero(np.diff(doc, prepend=doc[0] - 1, append=doc[-1] + 1 if doc[-1] < _LAST else doc[-1] - 1))
            texts, ids, gone = [], [], []
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if doc[lo] != at:
                    at, hashes = doc[lo], [np.zeros(0, np.uint64)]
                plain = is_hash[lo:hi]
                if plain.any():
                    hashes.append(value[lo:hi][plain])
                for i in (lo + np.flatnonzero(~plain)).tolist():
                    data = z[i].as_py()
                    if data[0] == 0:
                        hashes.append(np.frombuffer(data[1:], np.uint64))
                    else:
                        texts.append(zstandard.ZstdDecompressor().decompress(data[1:]))
                        ids.append(int(at)), gone.append(np.concatenate(hashes))
            if texts:
                yield _cut_texts(ids, texts, gone, k)
        give_back()

    return rows.mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def _cut_texts(ids: list[int], texts: list[bytes], gone: list[np.ndarray], k: int) -> pa.RecordBatch:
    row_key = mix(np.arange(len(texts), dtype=np.uint64), 77)
    keys = np.concatenate([g ^ row_key[i] for i, g in enumerate(gone)])
    n_words, n_removed, kept = [], [], []
    column = pa.array(texts, pa.large_binary()).cast(pa.large_string())
    for w in words_of(column):
        counts = w.counts
        covered = np.zeros(len(w.hash) + 1, np.int64)
        if len(keys):
            h, at, row = windows(w, k)
            hit = at[np.isin(h ^ row_key[w.row0 + row], keys)]
            covered[hit] += 1  # a word starts one window at most
            np.subtract.at(covered, hit + k, 1)
        covered = np.cumsum(covered)[:-1] > 0
        for t in range(len(counts)):
            own = covered[w.first[t]:w.first[t + 1]]
            parts = texts[w.row0 + t].split()
            n_words.append(len(parts)), n_removed.append(int(own.sum()))
            kept.append(b" ".join([p for p, c in zip(parts, own.tolist()) if not c] if own.any() else parts))
    return pa.RecordBatch.from_arrays(
        [pa.array([None if i == _LAST else i for i in ids], pa.int64()), pa.array(n_words, pa.int64()),
         pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "n_removed", "kept_text"])
