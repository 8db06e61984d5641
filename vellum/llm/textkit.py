"""Vectorised work on the texts of an Arrow batch: bytes, words, lines, shingles and their 64-bit hashes.

Hashes are taken modulo 2**64 over random byte values, so that two different strings agree with probability
2**-64 or so; where that isn't enough, callers compare the strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(0x5EED)
BYTES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = np.ones(1, np.uint64)

#: A word is a maximal run of bytes other than space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
SLICE = 1 << 20


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 4096)
        p = np.full(size, _BASE, np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def mix_int(x: int) -> int:
    return int(mix(np.array([x & 0xFFFFFFFFFFFFFFFF], np.uint64))[0])


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (null: empty), and where each begins and ends in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offs


def slices(offs: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes each, one text at least."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Tokens(NamedTuple):
    """Maximal runs of bytes that aren't separators; no run spans two texts."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray  # number of the text
    hash: np.ndarray


def tokens(data: np.ndarray, offs: np.ndarray, separators: np.ndarray = SPACE, hashes: bool = True) -> Tokens:
    """``data``: the bytes from offs[0] to offs[-1]; positions are counted from offs[0]."""
    n = len(data)
    base = offs - offs[0]
    inside = ~separators[data]
    before = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
        before[base[:-1][base[:-1] < n]] = False
    first = inside & ~before
    start = np.flatnonzero(first)
    after = np.empty(n, bool)
    if n:
        after[-1] = False
        after[:-1] = inside[1:]
        ends = base[1:] - 1
        after[ends[ends >= 0]] = False
    end = np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(base, start, "right") - 1
    if not hashes:
        return Tokens(start, end, text, np.zeros(0, np.uint64))
    if not len(start):
        return Tokens(start, end, text, np.zeros(0, np.uint64))
    at = np.arange(n, dtype=np.int64)
    at -= np.maximum.accumulate(np.where(first, at, 0))
    longest = int((end - start).max())
    np.minimum(at, longest, out=at)
    value = BYTES[data] * powers(longest + 1)[at]
    value[~inside] = 0
    h = np.add.reduceat(value, start)
    return Tokens(start, end, text, mix(h + (end - start).astype(np.uint64)))


def windows(h: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` tokens within one text, and where each begins."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(text[:n] == text[k - 1 :])
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out + h[i : i + n]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return mix(out[at]), at


def same_as_another(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and which are equal to one that stands before them."""
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = s[1:] == s[:-1]
    again, earlier = np.zeros(len(key), bool), np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    earlier[order[1:][same]] = True
    return again, earlier


def within(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Keys that agree only for equal hashes of the same text."""
    return mix(h + text.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def counts(text: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    out = np.bincount(text, weights, minlength=n)
    return out.astype(np.int64)


def sums(data: np.ndarray, base: np.ndarray) -> np.ndarray:
    """For each text, the sum of ``data`` over its bytes."""
    c = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data, out=c[1:])
    return c[base[1:]] - c[base[:-1]]
