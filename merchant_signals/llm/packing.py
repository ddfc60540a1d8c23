"""Best-fit packing of token sequences by fitted length patterns.

1. Each text becomes token ids and one end id; only what is longer than ``max_len`` is cut, into pieces of
   ``max_len``.  Pieces (no text, no ids unless asked for) go to a staged table.
2. The histogram of piece lengths, at most ``max_len`` numbers, is all that the driver gets.
3. Patterns of 2 to ``PATTERN_DOCS`` documents whose binned lengths fill a sequence are enumerated; repeat counts come
   from non-negative least squares of pattern counts against the binned histogram, rounded.
4. Patterns are realised with exact lengths (largest of each bin, the last slot takes the best fit), what is left
   is packed largest-first with best fits; each step repeats one combination of lengths as often as counts allow, so
   the plan's size depends on the number of lengths, not of documents.
5. Each piece finds its place from its rank among the pieces of its length.  Ranks are taken inside salted parts of a
   length, so that a length with a third of all pieces isn't one task's work.

Cases: a null or empty text is the end id alone; an empty table gives no rows; repeated rows are packed each; columns
other than the id and the text aren't carried.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchant_signals.llm.common import arrow_map, staged
from merchant_signals.llm.tokens import encoder, forget
from merchant_signals.llm.words import texts_of

#: Bins of the length axis and documents of a pattern.
BINS, PATTERN_DOCS = 64, 4
#: Weight of the residuals of lengths below an eighth of a sequence: they fill gaps later.
SHORT_WEIGHT = 0.1


def pieces_of(docs: DataFrame, vocabulary: str, max_len: int, end_id: int, id_col: str = "doc_id",
              text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each piece of each text."""
    kind = dict(docs.dtypes)[id_col]

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        data, offset = texts_of(b.column(1))
        enc, raw = encoder(vocabulary), data.tobytes()
        row, piece, start, length, crc, kept = [], [], [], [], [], []
        end = np.array([end_id], "<u4").tobytes()
        for i in range(b.num_rows):
            ids = enc.encode(raw[offset[i]:offset[i + 1]]) + end
            for k, at in enumerate(range(0, len(ids), 4 * max_len)):
                part = ids[at:at + 4 * max_len]
                row.append(i), piece.append(k), start.append(at // 4), length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if with_ids:
                    kept.append(np.frombuffer(part, "<u4").astype(np.int32))
        cols = [b.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            cols, names = [*cols, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
        return pa.RecordBatch.from_arrays(cols, names=names)

    return arrow_map(docs.select(F.col(id_col), F.col(text_col).cast("string")), cut,
                     f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids,
                     forget)


def patterns(bins: int, docs: int) -> np.ndarray:
    """Every way to write ``bins`` as a sum of 2 to ``docs`` parts, as counts of each part (bins x patterns)."""
    found: list[list[int]] = []

    def parts(left: int, most: int, chosen: list[int]) -> None:
        if not left:
            if len(chosen) > 1:
                found.append(chosen)
            return
        if len(chosen) < docs:
            for p in range(min(left, most), 0, -1):
                if p * (docs - len(chosen)) < left:
                    break
                parts(left - p, p, [*chosen, p])

    parts(bins, bins - 1, [])
    a = np.zeros((bins + 1, len(found)))
    for k, chosen in enumerate(found):
        for p in chosen:
            a[p, k] += 1
    return a


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """Non-negative least squares by the active-set method of Lawson and Hanson."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        grad = a.T @ (b - a @ x)
        grad[free] = -np.inf
        k = int(grad.argmax())
        if free.all() or grad[k] <= 1e-9 * scale:
            break
        free[k] = True
        while True:
            z = np.zeros_like(x)
            z[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if z[free].min(initial=0) >= 0:
                x = z
                break
            bad = free & (z < 0)
            step = float(np.min(x[bad] / np.maximum(x[bad] - z[bad], 1e-300)))
            x += step * (z - x)
            free &= x > 1e-12 * scale
            x[~free] = 0
    return x


def fit_patterns(count: np.ndarray, max_len: int, bins: int = BINS, docs: int = PATTERN_DOCS) -> list[tuple[list[int], int]]:
    """Patterns (bins, largest first) and their rounded repeat counts. count: pieces by length, 0..max_len."""
    bins = min(bins, max_len)
    bin_of = -(-np.arange(max_len + 1) * bins // max_len)
    hist = np.bincount(bin_of, weights=count, minlength=bins + 1)
    a = patterns(bins, docs)
    weight = np.where(np.arange(bins + 1) * 8 < bins, SHORT_WEIGHT, 1.0)
    weight[bins] = 0  # full sequences need no pattern
    x = np.rint(nnls(a * weight[:, None], hist * weight)).astype(np.int64)
    return [([p for p in range(bins, 0, -1) for _ in range(int(a[p, k]))], int(x[k]))
            for k in sorted(np.flatnonzero(x), key=lambda k: -x[k])]


def plan(count: np.ndarray, max_len: int) -> np.ndarray:
    """Rows (length, first rank, copies in a sequence, first sequence, offset), ordered by length and rank; the pieces
    of a length with ranks from this row's on, up to the next row's, go there."""
    left = count.astype(np.int64).copy()
    rank, rows = np.zeros(max_len + 1, np.int64), []
    sequence = 0
    bins = min(BINS, max_len)
    edge = [b * max_len // bins for b in range(bins + 1)]

    def largest(lo: int, hi: int, used: dict[int, int]) -> int:
        """The largest length in lo..hi of which a piece is left, or 0."""
        while hi >= lo and hi > 0:
            found = np.flatnonzero(left[max(lo, 1):hi + 1])
            if not len(found):
                return 0
            length = int(found[-1]) + max(lo, 1)
            if left[length] > used.get(length, 0):
                return length
            hi = length - 1
        return 0

    def fill(used: dict[int, int], room: int) -> None:
        """Best fits until nothing fits."""
        while room and (length := largest(1, room, used)):
            n = min(room // length, int(left[length]) - used.get(length, 0))
            used[length] = used.get(length, 0) + n
            room -= n * length

    def place(used: dict[int, int], most: int) -> int:
        """Repeat one combination of lengths as often as it goes."""
        nonlocal sequence
        n = min([most, *(int(left[length]) // m for length, m in used.items())])
        offset = 0
        for length, m in used.items():
            rows.append((length, rank[length], m, sequence, offset))
            rank[length] += m * n
            left[length] -= m * n
            offset += m * length
        sequence += n
        return n

    if left[max_len]:
        place({max_len: 1}, int(left[max_len]))
    for pattern, repeats in fit_patterns(left, max_len):
        while repeats > 0:
            used, room = {}, max_len
            for k, b in enumerate(pattern):
                lo = edge[b - 1] + 1
                length = largest(lo, room if k == len(pattern) - 1 else min(edge[b], room), used)
                if not length:
                    break
                used[length] = used.get(length, 0) + 1
                room -= length
            else:
                fill(used, room)
                repeats -= place(used, repeats)
                continue
            break
    while (length := largest(1, max_len, {})):
        used = {length: 1}
        fill(used, max_len - length)
        place(used, int(left[length]))
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, vocabulary: str, max_len: int = 4096, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of each piece."""
    spark = docs.sparkSession
    pieces = staged(pieces_of(docs, vocabulary, max_len, end_id, id_col, text_col, with_ids), "pieces")
    count = np.zeros(max_len + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most max_len rows
        count[r["length"]] = r["count"]
    total, shards = int(count.sum()), int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, -(-int(count.max()) // max(1000, total // (8 * shards))))

    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    first = (salted.groupBy("length", "salt").count()
             .select("length", "salt", (F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count"))
                     .alias("before")))
    ranked = (salted.withColumn("within", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")))
        .join(first, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("within") - 1).drop("before", "within", "salt"))
    rows = plan(count, max_len)
    shared = spark.sparkContext.broadcast(rows)  # a few rows for each of at most max_len lengths
    names = [*pieces.columns, "sequence_id", "offset"]

    def place(b: pa.RecordBatch) -> pa.RecordBatch:
        at = shared.value
        length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        k = np.searchsorted((at[:, 0] << 44) | at[:, 1], (length << 44) | rank, "right") - 1
        n = rank - at[k, 1]
        own = {"sequence_id": pa.array(at[k, 3] + n // at[k, 2]), "offset": pa.array(at[k, 4] + n % at[k, 2] * length)}
        return pa.RecordBatch.from_arrays([own.get(c) if c in own else b.column(c) for c in names], names=names)

    kinds = dict(pieces.dtypes) | {"sequence_id": "bigint", "offset": "bigint"}
    return arrow_map(ranked, place, ", ".join(f"{c} {kinds[c]}" for c in names))
