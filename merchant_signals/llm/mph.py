"""Minimal perfect hashing of distinct 64-bit keys, built in blocks by Spark.

Keys fall into blocks of about ``BLOCK_KEYS`` by a hash.  In a block, keys are thrown into a bit array ``GAMMA`` times as
long; those that are alone in their place are settled by its bit, the others go on to the next array, until none is left.
A key's number is the count of bits set before its own, over all arrays of all blocks, so ``n`` keys get 0 to n - 1.  The
keys are kept by number: a key that isn't one of them is found out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_signals.llm.common import ship_package
from merchant_signals.llm.words import mix

BLOCK_KEYS, GAMMA = 4096, 2.0


def _block(keys: np.ndarray, blocks: int) -> np.ndarray:
    return ((mix(keys.astype(np.uint64), 1) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _place(keys: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    return ((mix(keys.astype(np.uint64), 2 + level) >> np.uint64(32)) * np.asarray(size, np.uint64) >> np.uint64(32)).astype(np.int64)


def _arrays(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The bit arrays of a block, and its keys in the order of their numbers."""
    levels, order, level = [], [], 0
    while len(keys):
        size = max(8, -(-int(GAMMA * len(keys)) // 8) * 8)
        at = _place(keys, level, size)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        order.append(keys[mine][np.argsort(at[mine])])
        levels.append(alone)
        keys = keys[~mine]
        level += 1
    return levels, np.concatenate(order) if order else keys


@dataclass
class Hash:
    """n keys -> 0 .. n - 1."""

    n: int
    blocks: int
    size: np.ndarray  # of the array of each block (row) and level (column)
    start: np.ndarray  # of each array in bits
    bits: np.ndarray  # packed, little end first
    before: np.ndarray  # bits set before each byte
    keys: np.ndarray

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; -1 for a key that the hash wasn't made of."""
        keys = np.asarray(keys, np.int64)
        out = np.full(len(keys), -1, np.int64)
        todo, block = np.arange(len(keys)), _block(keys, self.blocks)
        for level in range(self.size.shape[1]):
            size = self.size[block[todo], level]
            todo, size = todo[size > 0], size[size > 0]
            at = self.start[block[todo], level] + _place(keys[todo], level, size)
            byte, bit = self.bits[at >> 3], (at & 7).astype(np.uint8)
            hit = (byte >> bit) & np.uint8(1) == 1
            below = np.bitwise_count(byte[hit] & ((np.uint8(1) << bit[hit]) - np.uint8(1)).astype(np.uint8))
            out[todo[hit]] = self.before[at[hit] >> 3] + below
            todo = todo[~hit]
        if self.n:
            out[self.keys[out] != keys] = -1
        return out


def build_mph(keys: DataFrame, column: str, n: int) -> Hash:
    """Hash of ``n`` distinct keys; blocks are built apart, a block's arrays and keys (about 9 bytes a key) come to the driver,
    so the caller bounds ``n``."""
    blocks = max(1, -(-n // BLOCK_KEYS))
    ship_package(keys.sparkSession)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(_block(own, blocks)), b.column(0)], names=["block", "key"])

    def build(group: tuple, table: pa.Table) -> pa.Table:
        levels, order = _arrays(np.sort(table.column("key").to_numpy()))
        return pa.table({"block": pa.array([group[0].as_py()], pa.int64()), "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int64())),
                         "bits": pa.array([np.packbits(np.concatenate(levels), bitorder="little").tobytes()], pa.binary()),
                         "keys": pa.array([order.astype(np.int64).tobytes()], pa.binary())})

    made = (keys.select(F.col(column).cast("long").alias("key")).mapInArrow(number, "block bigint, key bigint")
            .groupBy("block").applyInArrow(build, "block bigint, sizes array<bigint>, bits binary, keys binary"))
    rows = sorted(made.toLocalIterator(), key=lambda r: r["block"])
    depth = max((len(r["sizes"]) for r in rows), default=0)
    size = np.zeros((blocks, depth), np.int64)
    for r in rows:
        size[r["block"], :len(r["sizes"])] = r["sizes"]
    start = (np.cumsum(size.ravel()) - size.ravel()).reshape(size.shape)
    bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in rows), np.uint8)
    count = np.bitwise_count(bits).astype(np.int64)
    order = np.frombuffer(b"".join(bytes(r["keys"]) for r in rows), np.int64)
    return Hash(n, blocks, size, start, bits, np.cumsum(count) - count, order)
