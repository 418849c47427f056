"""Hashes that Spark lacks: 32-bit MurmurHash3 with seed 0 and the nilsimsa digest."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType


def murmur3(data: bytes, seed: int = 0) -> int:
    """MurmurHash3 x86 32 bits, signed."""
    h, n = seed, len(data) & ~3
    for i in range(0, n, 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
        h ^= k
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    if tail := data[n:]:
        k = int.from_bytes(tail, "little") * 0xCC9E2D51 & 0xFFFFFFFF
        h ^= (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * factor & 0xFFFFFFFF
    return h - (1 << 32) if h >> 31 else h


def term_hash(term: str) -> int:
    """Hash of a term; 0 is reserved for corpus totals and becomes 1."""
    return murmur3(term.encode()) or 1


def term_hashes(terms: pa.Array) -> np.ndarray:
    """``term_hash`` of many terms at once; that of a null is of no use."""
    terms = terms.cast(pa.large_string())
    bounds = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1] if len(terms) else np.zeros(1, np.int64)
    data = np.frombuffer(terms.buffers()[2] or b"", np.uint8)
    begin, size = bounds[:-1], np.diff(bounds)
    h = np.zeros(len(size), np.uint32)

    def mixed(k: np.ndarray) -> np.ndarray:
        k = k * np.uint32(0xCC9E2D51)
        return (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)

    left, at = np.flatnonzero(size >= 4), 0
    while len(left):
        word = sum(data[begin[left] + at + b].astype(np.uint32) << np.uint32(8 * b) for b in range(4))
        x = h[left] ^ mixed(word)
        h[left] = (x << np.uint32(13) | x >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)
        at += 4
        left = left[size[left] >= at + 4]
    tail, rest = np.zeros(len(size), np.uint32), size & 3
    for b in range(3):
        some = np.flatnonzero(rest > b)
        tail[some] |= data[begin[some] + size[some] - rest[some] + b].astype(np.uint32) << np.uint32(8 * b)
    h ^= mixed(tail) ^ size.astype(np.uint32)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> np.uint32(shift)) * np.uint32(factor)
    return np.where(h == 0, 1, h.view(np.int32)).astype(np.int32)


@F.pandas_udf(IntegerType())
def _term_hash(terms: pd.Series) -> pd.Series:
    return pd.Series(pd.arrays.IntegerArray(term_hashes(pa.array(terms, pa.string())), terms.isna().to_numpy()), index=terms.index)


#: Not deterministic to the planner, lest a test of hashes is made before equal terms are grouped.
term_hash_udf = _term_hash.asNondeterministic()


def _substitution() -> np.ndarray:
    """The permutation of 256 bytes by which nilsimsa mixes: a doubling walk with probing."""
    table, j = np.zeros(256, np.int64), 0
    for i in range(256):
        j = (j * 53 + 1) & 255
        j += j
        if j > 255:
            j -= 255
        k = 0
        while k < i:
            if j == table[k]:
                j, k = (j + 1) & 255, 0
            else:
                k += 1
        table[i] = j
    return table


_TABLE = _substitution()


def _mix(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    return ((_TABLE[(a + n) & 255] ^ (_TABLE[b] * (n + n + 1))) + _TABLE[c ^ _TABLE[n]]) & 255


def nilsimsa(data: bytes, block: int = 1 << 18) -> bytes:
    """256-bit locality-sensitive digest: trigrams in a window of 5 bytes fill 256 counters; a bit tells those above the mean.

    A long text is counted in blocks, each with the 4 bytes before it, so it
    needs no more memory than one block.
    """
    counts, total = np.zeros(256, np.int64), 0
    for at in range(0, len(data), block):
        lead = min(at, 4)
        x = np.frombuffer(data, np.uint8)[at - lead : at + block].astype(np.int64)
        n = len(x)
        # Trigrams of the newest byte with two of the four before it.
        for first, second, salt in ((1, 2, 0), (1, 3, 1), (2, 3, 2), (1, 4, 3), (2, 4, 4), (3, 4, 5)):
            begin = max(second, lead)
            if n > begin:
                counts += np.bincount(_mix(x[begin:], x[begin - first : n - first], x[begin - second : n - second], salt), minlength=256)
                total += n - begin
        if n > 4:
            now, old, one = x[4:], x[: n - 4], x[3 : n - 1]
            counts += np.bincount(_mix(old, one, now, 6), minlength=256) + np.bincount(_mix(old, now, one, 7), minlength=256)
            total += 2 * (n - 4)
    bits = counts > total / 256
    return np.packbits(bits[::-1]).tobytes()


def similarity(a: bytes, b: bytes) -> int:
    """128 for equal digests, about 0 for unrelated ones."""
    return 128 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


@F.pandas_udf(StringType())
def nilsimsa_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: nilsimsa(t.encode()).hex(), na_action="ignore")


def digest_similarity(a: Column, b: Column) -> Column:
    """Similarity of two hexadecimal digests by population counts, without Python."""
    out = F.lit(128)
    for k in range(4):
        word = lambda c, k=k: F.conv(F.substring(c, 16 * k + 1, 16), 16, -10).cast("long")
        out = out - F.bit_count(word(a).bitwiseXOR(word(b)))
    return out
