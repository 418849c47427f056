"""Pairs of 256-bit digests that differ in few bits, in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa

#: Most bits of difference for which bands are wide enough to tell digests apart; beyond it all pairs are compared.
BANDED = 30
#: Longest run of equal keys that is compared lag by lag; longer ones are compared in squares.
SHORT = 32
_SIDE, _WIDTH = 64, 1024


def digests(values: pa.Array) -> np.ndarray:
    """Digests of 32 bytes as rows of four words, whose order is the order of the bytes."""
    data = np.frombuffer(b"".join(values.to_pylist()), ">u8").astype(np.uint64)
    return data.reshape(-1, 4)


def hexadecimal(rows: np.ndarray) -> pa.Array:
    digits = np.frombuffer(bytes(rows.astype(">u8").tobytes().hex(), "ascii"), np.uint8)
    return pa.StringArray.from_buffers(len(rows), pa.py_buffer(np.arange(0, 64 * len(rows) + 1, 64, dtype=np.int32)), pa.py_buffer(digits))


def choices(differ: int) -> list[tuple[int, ...]]:
    """Digests that differ in ``differ`` bits agree in two of ``differ + 2`` bands: the pairs of bands to be keyed by."""
    return list(combinations(range(differ + 2), 2)) if differ <= BANDED else [()]


def banded(rows: np.ndarray, differ: int) -> np.ndarray:
    """The bands of each digest as numbers. Bits are dealt to bands by how evenly they are set, so that bands tell digests apart alike."""
    bits = lambda at: (rows[:, at >> 6] >> np.uint64(63 - (at & 63))) & np.uint64(1)
    share = np.array([bits(at).mean() for at in range(256)]) if len(rows) else np.zeros(256)
    order, count = np.argsort(np.abs(share - 0.5), kind="stable"), differ + 2
    bands = np.zeros((count, len(rows)), np.uint64)
    for k in range(count):
        for at in order[k::count]:
            bands[k] = (bands[k] << np.uint64(1)) | bits(int(at))
    return bands


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(1, dtype=np.int64)


def _squares(rows: np.ndarray, begin: int, end: int, differ: int, part: int, parts: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Near pairs of the rows from ``begin`` to ``end``, some rows against some at a time."""
    for at in range(begin, end, _SIDE):
        if at // _SIDE % parts != part:
            continue
        stop = min(at + _SIDE, end)
        for left in range(at, end, _WIDTH):
            right = min(left + _WIDTH, end)
            d = np.zeros((stop - at, right - left), np.uint16)
            for w in range(4):
                d += np.bitwise_count(rows[at:stop, w, None] ^ rows[None, left:right, w])
            i, j = np.nonzero(d <= differ)
            later = j + left > i + at
            i, j = i[later], j[later]
            yield i + at, j + left, d[i, j].astype(np.int64)


def near(rows: np.ndarray, bands: np.ndarray | None, chosen: tuple[int, ...], differ: int, part: int = 0, parts: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places and distances of the pairs that agree in the chosen bands and in no two that come before them.

    So each pair comes of one choice alone. Of each run of equal keys one of
    ``parts`` compares its share.
    """
    n = len(rows)
    if not chosen:
        yield from _squares(rows, 0, n, differ, part, parts)
        return
    key = (bands[chosen[0]] * np.uint64(0x9E3779B97F4A7C15)) ^ bands[chosen[1]]
    key *= np.uint64(0xBF58476D1CE4E5B9)
    at = np.argsort(key)
    key = key[at]
    bounds = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), n) if n else np.zeros(1, np.int64)
    size = np.diff(bounds)
    # alone in their run, most digests have nothing to be compared with
    some = np.repeat(size > 1, size)
    at, size = at[some], size[size > 1]
    ends = np.cumsum(size)
    sorted_ = rows[at]

    def found(i: np.ndarray, j: np.ndarray, d: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        i, j = at[i], at[j]
        for band in range(chosen[1] + 1):
            same = bands[band][i] == bands[band][j]
            good = same if band in chosen else ~same
            i, j, d = i[good], j[good], d[good]
        if len(i):
            yield i, j, d

    short = size <= SHORT
    end = np.repeat(np.where(short, ends, 0), size)
    i = np.flatnonzero(np.arange(len(at)) + 1 < end)
    i = i[i % parts == part]
    lag = 1
    while len(i):
        for k in range(0, len(i), 100_000):
            some = i[k : k + 100_000]
            d = _distances(sorted_[some], sorted_[some + lag])
            ok = d <= differ
            yield from found(some[ok], some[ok] + lag, d[ok])
        lag += 1
        i = i[i + lag < end[i]]
    for begin, stop in zip((ends - size)[~short], ends[~short], strict=True):
        for pairs in _squares(sorted_, int(begin), int(stop), differ, part, parts):
            if len(pairs[0]):
                yield from found(*pairs)
