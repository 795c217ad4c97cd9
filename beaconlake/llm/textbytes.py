"""Words of many texts at once, found and hashed with numpy on their UTF-8 bytes.

A word is a run of bytes other than space and 09-0D, that is `[^\\x20\\x09-\\x0D]+`. Texts are
taken in chunks of about a megabyte of whole documents, so memory follows the chunk (or the one
document that is longer than a chunk), not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_GOLDEN = 0x9E3779B97F4A7C15


class Chunk(NamedTuple):
    """Rows `first_row` .. of a batch: bytes, and where each document begins and ends in them."""
    first_row: int
    buf: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """`start`, `end`: byte places of each word; `first`: number of words before each document."""
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole documents, about `limit` bytes at a time; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset: texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(row + 1, end))
        yield Chunk(row, raw[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row])
        row = end


def _not_separator() -> np.ndarray:
    table = np.ones(256, bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
    return table


def words(chunk: Chunk, inside: np.ndarray | None = None) -> Words:
    """Words of each document; `inside` (by byte) says what belongs to a word."""
    table = _not_separator() if inside is None else inside
    part = table[chunk.buf]
    n = len(part)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = part[:-1], part[1:]
    edges = chunk.offsets[1:-1]
    before[edges[edges < n]] = False
    after[edges[edges > 0] - 1] = False
    start = np.flatnonzero(part & ~before)
    end = np.flatnonzero(part & ~after) + 1
    return Words(start, end, np.searchsorted(start, chunk.offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which each bit depends on all (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def spread(n: int, seed: int) -> np.ndarray:
    """n numbers that look random, by a rule."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLDEN)
               + np.uint64((seed * 0xD1B54A32D192ED03) % 2**64))


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of ordered pairs of hashes."""
    return mix(a * np.uint64(0x9FB21C651E98DF25) + b * np.uint64(_GOLDEN) + np.uint64(0x2545F491))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of h[i : i + k] for each i that has k elements, by doubling."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64)
    whole, held, block, size = None, 0, h, 1
    while True:
        if k & size:
            if whole is None:
                whole = block
            else:
                m = n - held - size + 1
                whole = combine(whole[:m], block[held: held + m])
            held += size
        if held == k:
            return whole[: n - k + 1]
        block = combine(block[:-size], block[size:])
        size *= 2


class Hasher:
    """64-bit hashes of byte ranges of a chunk: a polynomial over a table of byte values,
    so that all ranges cost one pass over the bytes. `lower` reads A-Z as a-z."""

    def __init__(self, seed: int = 0, lower: bool = False):
        self.table = spread(256, seed)
        if lower:
            self.table[65:91] = self.table[97:123]
        self.base = int(spread(1, seed + 77)[0]) // 8 * 8 + 5
        self.power = self.inverse = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) >= n:
            return
        for name, base in (("power", self.base), ("inverse", pow(self.base, -1, 2**64))):
            steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
            steps[0] = 1
            setattr(self, name, np.multiply.accumulate(steps))

    def ranges(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(buf)
        self._grow(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.table[buf] * self.power[:n], out=sums[1:])
        h = (sums[end] - sums[start]) * self.inverse[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(_GOLDEN))
