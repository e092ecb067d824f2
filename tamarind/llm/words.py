"""Vectorised words and shingles of UTF-8 texts, for use inside tasks.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D``; A-Z are lower-cased.
Words and shingles are named by 64-bit hashes that depend on their bytes only,
so every task of every run gives the same text the same hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20  # bytes of text that are handled at once
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD1342543DE82EF95)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 64)
        have = np.full(size, base & (2**64 - 1), np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, their bytes, offsets of the texts in them);
    as many whole texts as fit, one at least. A null text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the number of its first word
    (and of the last text the number after its last)."""
    inside = ~SEPARATOR[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    start[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans that don't overlap and ascend."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):  # in blocks, so that one very long text needs no more memory than many short ones
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, "right")))
        a, b = starts[i], ends[j - 1]
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * powers(_BASE, b - a), out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (total[e] - total[s]) * powers(_INVERSE, b - a)[s] + (e - s).astype(np.uint64) * _STEP
        i = j
    return mix(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the numbers of the texts' first words."""
    starts, ends, first = word_bounds(data, offsets)
    return span_hashes(LOWER[data], starts, ends), first


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles of ``k`` words, ascending. A text of
    fewer words has the whole sequence as its one shingle, a text without words none."""
    total = np.zeros(0, np.uint64)
    if len(hashes) >= k:
        total = hashes[: len(hashes) - k + 1].copy()
        for j in range(1, k):
            total *= _STEP
            total += hashes[j : len(hashes) - k + 1 + j]
        total = mix(total)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            yield np.unique(total[a : b - k + 1])
        elif b > a:
            one = np.uint64(b - a)  # apart from shingles of k words
            with np.errstate(over="ignore"):
                for h in hashes[a:b]:
                    one = one * _STEP + h
            yield mix(np.array([one], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
