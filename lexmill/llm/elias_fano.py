"""Elias-Fano sequences in numpy: built once, memory-mapped, queried by whole arrays."""

from __future__ import annotations

import numpy as np

#: Ones and zeros between two sampled positions.
SAMPLE = 32
U1, U6, U63 = np.uint64(1), np.uint64(6), np.uint64(63)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` low bits of each value, end to end, as 64-bit words."""
    if not width:
        return np.zeros(1, np.uint64)
    shifts = np.arange(width, dtype=np.uint64)
    parts = [np.packbits(((values[i : i + 65536, None] >> shifts) & U1).astype(np.uint8).ravel(), bitorder="little") for i in range(0, len(values), 65536)]
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint8)
    out = np.zeros(len(flat) // 8 + 2, np.uint64)
    out.view(np.uint8)[: len(flat)] = flat
    return out


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the set bit with the given rank in each word."""
    at = np.zeros(len(word), np.uint64)
    rank = rank.copy()
    for step in (32, 16, 8, 4, 2, 1):
        low = np.bitwise_count(word & np.uint64((1 << step) - 1)).astype(np.uint64)
        go = rank >= low
        rank -= np.where(go, low, 0).astype(np.uint64)
        move = np.where(go, np.uint64(step), np.uint64(0))
        word = word >> move
        at += move
    return at


class EliasFano:
    """A non-decreasing sequence of unsigned numbers in about ``2 + log2(universe / n)`` bits each.

    The low bits lie packed in ``low``. The high bits are unary in ``high``: bit
    ``i + (value >> width)`` is set for element i. Positions of every
    ``SAMPLE``-th one and zero speed up selection.
    """

    FIELDS = ("low", "high", "ones", "zeros")

    def __init__(self, n: int, width: int, arrays: dict[str, np.ndarray]) -> None:
        self.n, self.width = n, width
        self.low, self.high, self.ones, self.zeros = (arrays[f] for f in self.FIELDS)

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        length = n + (top >> width) + 2
        bits = np.zeros((length // 64 + 2) * 64, np.uint8)
        bits[(values >> np.uint64(width)).astype(np.int64) + np.arange(n)] = 1
        ones, zeros = np.flatnonzero(bits)[::SAMPLE], np.flatnonzero(bits == 0)[::SAMPLE]
        arrays = {"low": _pack(values, width), "high": np.packbits(bits, bitorder="little").view(np.uint64), "ones": ones.astype(np.uint64), "zeros": zeros.astype(np.uint64)}
        return cls(n, width, arrays)

    def arrays(self) -> dict[str, np.ndarray]:
        return {f: getattr(self, f) for f in self.FIELDS}

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.width)
        word, off = (at >> U6).astype(np.int64), at & U63
        value = self.low[word] >> off
        spill = off > np.uint64(64 - self.width)
        value |= np.where(spill, self.low[word + 1] << (np.uint64(64) - np.maximum(off, U1)), np.uint64(0))
        return value & np.uint64((1 << self.width) - 1)

    def _select(self, k: np.ndarray, samples: np.ndarray, flip: np.uint64) -> np.ndarray:
        """Positions of the k-th ones (flip 0) or zeros (flip all ones)."""
        k = k.astype(np.int64)
        at = samples[k // SAMPLE]
        rank = (k % SAMPLE).astype(np.uint64)
        word = (at >> U6).astype(np.int64)
        bits = (self.high[word] ^ flip) & (~np.uint64(0) << (at & U63))
        open_ = np.arange(len(k))
        count = np.bitwise_count(bits).astype(np.uint64)
        while len(open_ := open_[rank[open_] >= count[open_]]):
            rank[open_] -= count[open_]
            word[open_] += 1
            bits[open_] = self.high[word[open_]] ^ flip
            count[open_] = np.bitwise_count(bits[open_])
        return word.astype(np.uint64) * np.uint64(64) + _select_in_word(bits, rank)

    def _run(self, bit: np.ndarray) -> np.ndarray:
        """How many ones follow from each position on."""
        out, open_ = np.zeros(len(bit), np.int64), np.arange(len(bit))
        while len(open_):
            off = (bit[open_] & 63).astype(np.uint64)
            rest = ~(self.high[bit[open_] >> 6] >> off)
            # the lowest zero bit; what was shifted in counts as zeros
            low = np.bitwise_count((rest & (~rest + U1)) - U1).astype(np.int64)
            out[open_] += low
            full = low == 64 - off.astype(np.int64)
            bit = bit.copy()
            bit[open_] += low
            open_ = open_[full]
        return out

    def get(self, i: np.ndarray) -> np.ndarray:
        """Elements at the given places."""
        if not len(i):
            return np.empty(0, np.uint64)
        high = self._select(i, self.ones, np.uint64(0)) - i.astype(np.uint64)
        return high << np.uint64(self.width) | self._lows(i)

    def find(self, value: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Place of each value in the sequence, or in its part ``first <= place < last``; -1 where it is missing.

        This is a successor search: zeros bound the elements with the value's
        high bits, and halving by low bits finds the first not below it.
        """
        out = np.full(len(value), -1, np.int64)
        if not self.n or not len(value):
            return out
        ok = np.flatnonzero(value <= self.get(np.array([self.n - 1]))[0])
        value = value[ok]
        high = (value >> np.uint64(self.width)).astype(np.int64)
        # the ones between two zeros are the elements with the same high bits
        before = np.maximum(high - 1, 0)
        bit = np.where(high > 0, self._select(before, self.zeros, ~np.uint64(0)).astype(np.int64) + 1, 0)
        start = bit - high
        end = start + self._run(bit)
        if first is not None:
            start, end = np.maximum(start, first[ok]), np.minimum(end, last[ok])
        want = value & np.uint64((1 << self.width) - 1)
        a, b = start.copy(), np.maximum(end, start)
        open_ = np.flatnonzero(a < b)
        while len(open_):
            mid = (a[open_] + b[open_]) // 2
            less = self._lows(mid) < want[open_]
            a[open_] = np.where(less, mid + 1, a[open_])
            b[open_] = np.where(less, b[open_], mid)
            open_ = open_[a[open_] < b[open_]]
        hit = np.flatnonzero(a < end)
        hit = hit[self._lows(a[hit]) == want[hit]]
        out[ok[hit]] = a[hit]
        return out
