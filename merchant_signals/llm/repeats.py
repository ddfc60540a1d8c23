"""Which 64-bit hashes occur twice or more in a corpus: a count-min sketch of two rows that saturates at 2.

Each task counts the hashes that it meets and sends the cells, sorted and delta-coded, by block; blocks are merged in
a stream.  What comes back is a bit a cell, at most ``ROWS`` x ``MAX_CELLS`` / 8 bytes however large the corpus is:
above that more hashes seem repeated than are, below it few do, and those that are never get lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_signals.llm.common import give_back, ship_package
from merchant_signals.llm.words import mix

#: Bounds of the cells of a row, and blocks that a row is merged in.
MIN_CELLS, MAX_CELLS, BLOCKS = 1 << 20, 1 << 28, 128
ROWS = 2
#: Hashes that a task keeps before it sends their cells.
FLUSH = 2_000_000


def cells_for(docs: DataFrame, text_col: str, per_word: float) -> int:
    """Cells of a row: ``per_word`` for each word of about six bytes, in whole bytes of each block."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long")).alias("n")).first()["n"] or 0
    unit = 8 * BLOCKS
    return -(-min(MAX_CELLS, max(MIN_CELLS, int(size * per_word / 6))) // unit) * unit


def _cell(h: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (((mix(h, 100 + row) >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)).astype(np.uint32)


def _pack(sorted_cells: np.ndarray) -> bytes:
    step = np.diff(sorted_cells, prepend=np.uint32(0)).astype(np.uint32)
    kind = 0 if step.max(initial=0) < 1 << 8 else 1 if step.max(initial=0) < 1 << 16 else 2
    return bytes([kind]) + zstandard.ZstdCompressor(1).compress(step.astype((np.uint8, np.uint16, np.uint32)[kind]).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    kind = (np.uint8, np.uint16, np.uint32)[data[0]]
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), kind), dtype=np.int64)


def sketch(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterable[np.ndarray]], cells: int) -> list[np.ndarray]:
    """Of each row, the packed bits of the cells that were met twice or more. hashes: those of a batch, in parts."""
    ship_package(df.sparkSession)
    blocks, span = BLOCKS, cells // BLOCKS

    def send(kept: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(kept)
        part, many, data = [], [], []
        for row in range(ROWS):
            cell, n = np.unique(_cell(h, row, cells), return_counts=True)
            for twice in (False, True):
                own = cell[(n > 1) == twice]
                edge = np.searchsorted(own, np.arange(blocks + 1, dtype=np.int64) * span)
                for x in np.flatnonzero(np.diff(edge)):
                    part.append(row * blocks + int(x)), many.append(twice)
                    data.append(_pack(own[edge[x]:edge[x + 1]] - np.uint32(x * span)))
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(many), pa.array(data, pa.binary())],
                                          names=["part", "many", "data"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0
        for b in batches:
            for h in hashes(b):
                kept.append(h)
                n += len(h)
                if n >= FLUSH:
                    yield send(kept)
                    kept, n = [], 0
        if n:
            yield send(kept)
        kept = []
        give_back()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, met = None, np.zeros(span, np.uint8)

        def done() -> pa.RecordBatch:
            bits = zstandard.ZstdCompressor(1).compress(np.packbits(met >= 2, bitorder="little").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([bits], pa.binary())], names=["part", "bits"])

        for b in batches:
            for part, many, data in zip(*(c.to_pylist() for c in b.columns)):
                if part != at:
                    if at is not None:
                        yield done()
                    at, met = part, np.zeros(span, np.uint8)
                cell = _unpack(data)
                met[cell] = 2 if many else np.minimum(met[cell] + 1, 2)
        if at is not None:
            yield done()
        give_back()

    merged = (df.mapInArrow(count, "part int, many boolean, data binary")
              .repartition("part").sortWithinPartitions("part").mapInArrow(merge, "part int, bits binary"))
    found = [np.zeros(cells // 8, np.uint8) for _ in range(ROWS)]
    for r in merged.toLocalIterator():  # ROWS * blocks rows of span / 8 bytes
        row, x = divmod(r["part"], blocks)
        bits = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r["bits"])), np.uint8)
        found[row][x * span // 8:(x + 1) * span // 8] = bits
    return found


def repeated(h: np.ndarray, bits: list[np.ndarray]) -> np.ndarray:
    """Which of the hashes were met twice by the sketch's estimate."""
    out = np.ones(len(h), bool)
    for row, own in enumerate(bits):
        cell = _cell(h, row, len(own) * 8)
        out &= (own[cell >> np.uint32(3)] >> (cell & np.uint32(7)).astype(np.uint8)) & np.uint8(1) == 1
    return out
