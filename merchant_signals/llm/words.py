"""Words, shingles and their 64-bit hashes for whole Arrow batches of texts, in numpy.

A text is handled as its UTF-8 bytes.  The word rules of this subpackage name ASCII separators only, and every byte
of a longer UTF-8 sequence is above 0x7F, so byte-wise splitting gives the same words as splitting by characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_STEP = np.uint64(int(_rng.integers(1, 2**62)) * 8 + 5)
_MASK = 2**64 - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

#: ``[^\x20\x09-\x0D]+``
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values; another seed gives an independent hash."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & _MASK)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word ``b[start:end]``: its blocks of eight bytes, each mixed with its place in the word, added up
    and mixed with the length.  (A polynomial modulo 2**64 would be equal for fixed pairs of long words, such as a
    Thue-Morse word and its complement, whatever its base.)"""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    blocks = (length + 7) // 8
    first = np.cumsum(blocks) - blocks
    place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    at = np.repeat(start, blocks) + 8 * place
    padded = np.concatenate([b, np.zeros(8, np.uint8)])
    block = np.ndarray(len(b) + 1, "<u8", padded, strides=(1,))[at]
    beyond = np.maximum(0, at + 8 - np.repeat(end, blocks)).astype(np.uint64) * np.uint64(8)
    block &= np.uint64(_MASK) >> beyond
    mixed = mix(mix(block, 3) ^ mix(place.astype(np.uint64), 5), 7)
    return mix(np.add.reduceat(mixed, first) ^ mix(length.astype(np.uint64), 9))


@dataclass
class Words:
    """Words of the texts ``row0 .. row0 + len(first) - 2`` of a batch."""

    row0: int
    data: np.ndarray  # the texts' bytes
    offset: np.ndarray  # where each text starts in data, and the end of the last
    start: np.ndarray  # of each word, in data
    end: np.ndarray
    first: np.ndarray  # number of each text's first word, and the number of all words
    hash: np.ndarray  # of each word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        """Number of each word's text, from 0."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and their offsets; null counts as empty."""
    a = column.cast(pa.large_string()).fill_null("")
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = a.buffers()
    offset = np.frombuffer(buffers[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offset


def chunks(offset: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes."""
    i, n = 0, len(offset) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offset, offset[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words_of(column: pa.Array, lower: bool = False, separator: np.ndarray = SPACE) -> Iterator[Words]:
    """The words of a column of texts, chunk by chunk."""
    data, offset = texts_of(column)
    for i, j in chunks(offset):
        off = offset[i:j + 1] - offset[i]
        b = data[offset[i]:offset[j]]
        inside = ~separator[b]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        edge = off[(off > 0) & (off < len(b))]
        opens[edge] = inside[edge]
        closes[edge - 1] = inside[edge - 1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        yield Words(i, b, off, start, end, np.searchsorted(start, off), word_hashes(LOWER[b] if lower else b, start, end))


def windows(w: Words, k: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of ``k`` words inside one text: hash, number of the first word, number of the text.

    whole: a text of fewer words, but not none, has one run of all its words.
    """
    n, counts, row = len(w.hash), w.counts, w.row
    if n >= k:
        h = w.hash[:n - k + 1].copy()
        for j in range(1, k):
            h *= _STEP
            h += w.hash[j:n - k + 1 + j]
        at = np.flatnonzero(row[:n - k + 1] == row[k - 1:])
        h, row = mix(h[at], k), row[at]
    else:
        h, at, row = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if whole and len(short := np.flatnonzero((counts > 0) & (counts < k))):
        own = np.zeros(len(short), np.uint64)
        for x, t in enumerate(short):
            v = np.uint64(0)
            for y in w.hash[w.first[t]:w.first[t + 1]]:
                v = np.uint64((int(v) * int(_STEP) + int(y)) & _MASK)
            own[x] = mix(np.array([v]), 1000 + int(counts[t]))[0]
        h, at, row = np.concatenate([h, own]), np.concatenate([at, w.first[short]]), np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        h, at, row = h[order], at[order], row[order]
    return h, at, row
