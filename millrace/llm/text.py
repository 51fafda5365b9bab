"""Words, their hashes and shingles of a whole Arrow batch at once.

Words are ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes. A word's hash is a polynomial over
a table of random numbers per byte, taken from one running sum over the bytes, so no
Python loop runs per word. All arithmetic wraps at 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The arrays of a chunk take some thirty times this, and an idle worker keeps much of that.
CHUNK_BYTES = 1 << 18

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit value over all others."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def randoms(seed: int, count: int) -> np.ndarray:
    """``count`` fixed pseudo-random 64-bit values of a seed."""
    start = np.uint64((int(seed) * 0x9E3779B97F4A7C15 + 0x1234567) % (1 << 64))
    steps = np.arange(1, count + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    return mix(start + steps)


_BYTE = randoms(1, 256)
_BASE = 0x9FB21C651E98DF25 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_powers: dict[str, np.ndarray] = {}


def _power(base: int, count: int) -> np.ndarray:
    known = _powers.get(str(base))
    if known is None or len(known) < count:
        size = max(count, CHUNK_BYTES + 1)
        known = np.full(size, _U(base), dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known)
        if count <= 4 * CHUNK_BYTES:
            _powers[str(base)] = known
    return known[:count]


@dataclass
class Words:
    """The words of some rows: ``first[i]:first[i + 1]`` are the words of row ``i``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its offsets; a null is an empty text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(texts) else data[:0], offsets - offsets[0]


def chunks(batches, column: str | int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text, whole rows only."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffers(batch.column(column))
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            yield batch.slice(low, high - low)
            low = high


def split_words(texts: pa.Array, lower: bool = False, letters: np.ndarray | None = None) -> Words:
    """Words of each text. ``letters`` (a flag per byte) replaces the default word bytes."""
    data, offsets = buffers(texts)
    if lower:
        data = _LOWER[data]
    inside = (_WORD if letters is None else letters)[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, start, end, hash_spans(data, start, end), np.searchsorted(start, offsets).astype(np.int64))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each byte span, equal for equal bytes wherever they stand."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=total[1:])
    value = (total[end] - total[start]) * _power(_INVERSE, len(data) + 1)[start]
    return mix(value + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def grams(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``size`` words of one row, and the run's first word."""
    count = len(words.hash) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    factors = randoms(100 + size, size) | _U(1)
    value = np.zeros(count, dtype=np.uint64)
    for j in range(size):
        value += words.hash[j : j + count] * factors[j]
    row = words.row
    at = np.flatnonzero(row[:count] == row[size - 1 :])
    return mix(value[at]), at


def shingles(words: Words, size: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each row, ascending.

    A row of fewer words has its whole sequence as one shingle; a row without words none.
    """
    value, at = grams(words, size)
    bounds = np.searchsorted(at, words.first)
    found = []
    for i, count in enumerate(np.diff(words.first)):
        if count >= size:
            own = np.sort(value[bounds[i] : bounds[i + 1]])
            fresh = np.ones(len(own), dtype=bool)
            fresh[1:] = own[1:] != own[:-1]
            found.append(own[fresh])
        elif count:
            own = words.hash[words.first[i] : words.first[i + 1]]
            factors = randoms(100 + count, count) | _U(1)
            found.append(mix((own * factors).sum(dtype=np.uint64, keepdims=True)))
        else:
            found.append(np.empty(0, np.uint64))
    return found
