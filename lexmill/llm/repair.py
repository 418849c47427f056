"""Token files compressed by Re-Pair grammars, with random access to documents."""

from __future__ import annotations

import functools
import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Workspace, running_sum, small_arrow_batches
from lexmill.llm.tokens import encoder, gathered

MAGIC = b"RPTOK2\0\0"
#: Ids of one file; a task holds one file's ids and pairs at a time.
FILE_IDS = 2_000_000
#: Symbols up to this many are handled as 16-bit numbers, which is faster; files have as many bits a symbol as they need.
SYMBOLS_16 = 1 << 16
SLOTS = 20


def _slots(key: np.ndarray, half: int) -> np.ndarray:
    if half == 16:
        return (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOTS)
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)).astype(np.uint32)


def _keys(symbols: np.ndarray, barred: int) -> tuple[np.ndarray, np.ndarray]:
    """A number for each pair of neighbours, and a slot of it (0 where ``barred`` is one of them)."""
    half = symbols.dtype.itemsize * 8
    wide = np.uint32 if half == 16 else np.uint64
    key = symbols[:-1].astype(wide) << wide(half) | symbols[1:]
    slot = _slots(key, half)
    bar = symbols == barred
    slot[bar[:-1] | bar[1:]] = 0
    return key, slot


def compress(ids: np.ndarray, barred: int, least: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules of a Re-Pair grammar for ``ids``.

    Rule k stands for symbol ``base + k``, where ``base`` is one more than the
    largest id, and has two earlier symbols. Each round replaces the most
    frequent neighbouring pairs from left to right: those at least a quarter as
    frequent as the first, until no pair occurs ``least`` times or a round saves
    less than a thousandth of the symbols. A rule takes the room of almost three
    symbols (two, and its length), so from 4 on it pays.
    ``barred``, which ends documents, never enters a rule, so no rule crosses a
    document. Pairs are counted by slots first, and only those of the fullest
    slots by themselves; slot 0 is never counted, which costs a few pairs.
    """
    base = int(ids.max(initial=0)) + 1
    symbols = ids.astype(np.uint16 if base < SYMBOLS_16 else np.uint32)
    rules: list[np.ndarray] = []
    made, limit = 0, None
    while len(symbols) > 1:
        half = symbols.dtype.itemsize * 8
        key, slot = _keys(symbols, barred)
        counts = np.bincount(slot, minlength=1 << SLOTS)
        counts[0] = 0
        most = int(counts.max())
        if most < least:
            break
        limit = max(least, min(most, limit or most) // 4)
        found, n = np.unique(key[(counts >= limit)[slot]], return_counts=True)
        found = found[n >= limit][np.argsort(-n[n >= limit], kind="stable")]
        if not len(found):
            # only slots that several pairs share were as full
            if limit == least:
                break
            continue
        if half == 16 and base + made + len(found) > SYMBOLS_16:
            symbols, limit = symbols.astype(np.uint32), 4 * limit
            continue
        order = np.argsort(found)
        known = found[order]
        chosen = np.zeros(1 << SLOTS, bool)
        chosen[_slots(found, half)] = True
        chosen[0] = False
        where = np.flatnonzero(chosen[slot])
        at = np.minimum(np.searchsorted(known, key[where]), len(known) - 1)
        hit = known[at] == key[where]
        where, at = where[hit], at[hit]
        # Of touching hits every other one is replaced, from the left.
        first = np.ones(len(where), bool)
        first[1:] = where[1:] != where[:-1] + 1
        even = (where - where[first][np.cumsum(first) - 1]) % 2 == 0
        where, at = where[even], at[even]
        symbols[where] = (base + made + order[at]).astype(symbols.dtype)
        keep = np.ones(len(symbols), bool)
        keep[where + 1] = False
        before, symbols = len(symbols), symbols[keep]
        mask = (1 << half) - 1
        rules.append(np.stack([found.astype(np.uint64) >> np.uint64(half), found.astype(np.uint64) & np.uint64(mask)], 1).astype(np.uint32))
        made += len(found)
        if limit == least and before - len(symbols) < before / 1000:
            break
    return symbols, np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` low bits of each value, end to end, as 64-bit words with one more behind."""
    at = np.arange(len(values), dtype=np.uint64) * np.uint64(width)
    word, off, v = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63), values.astype(np.uint64)
    out = np.zeros(len(values) * width // 64 + 2, np.uint64)
    # bits of different values never meet, so sums are unions
    np.add.at(out, word, v << off)
    spill = np.flatnonzero(off > np.uint64(64 - width))
    np.add.at(out, word[spill] + 1, v[spill] >> (np.uint64(64) - off[spill]))
    return out


def unpack_bits(words: np.ndarray, width: int, start: int, stop: int) -> np.ndarray:
    """Values ``start`` to ``stop`` of ``pack_bits``."""
    at = np.arange(start, stop, dtype=np.uint64) * np.uint64(width)
    word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    high = np.where(off > 0, words[word + 1] << (np.uint64(64) - np.maximum(off, np.uint64(1))), np.uint64(0))
    return ((words[word] >> off | high) & np.uint64((1 << width) - 1)).astype(np.uint32)


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule stands for. Rules only use earlier symbols."""
    length = [1] * (base + len(rules))
    for k, (a, b) in enumerate(rules.tolist(), base):
        length[k] = length[a] + length[b]
    return np.array(length[base:], np.uint32)


class Expansions:
    """The ids behind every rule, end to end: ``flat[start[k] : start[k] + length[k]]`` for rule k."""

    def __init__(self, rules: np.ndarray, base: int, lengths: np.ndarray) -> None:
        self.base, self.length = base, lengths.astype(np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]) if len(rules) else np.empty(0, np.int64)
        self.flat = np.empty(int(self.length.sum()), np.uint32)
        depth = np.zeros(len(rules), np.int64)
        below = [0] * base
        for a, b in rules.tolist():
            below.append(1 + max(below[a], below[b]))
        depth[:] = below[base:]
        order = np.argsort(depth, kind="stable")
        # rules of one depth use rules of lesser depths, which are there already
        for own in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
            if len(own):
                ids, sizes = self.of(rules[own].ravel())
                self.flat[np.repeat(self.start[own] - np.cumsum(self.length[own]) + self.length[own], self.length[own]) + np.arange(len(ids))] = ids

    def of(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids behind ``symbols``, and how many each has."""
        deep = symbols >= self.base
        if not deep.any():
            return symbols.astype(np.uint32), np.ones(len(symbols), np.int64)
        rule = symbols[deep].astype(np.int64) - self.base
        size, start = np.ones(len(symbols), np.int64), np.arange(len(symbols))
        size[deep], start[deep] = self.length[rule], len(symbols) + self.start[rule]
        both = np.concatenate([symbols.astype(np.uint32), self.flat])
        return both[np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))], size


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids behind ``symbols``."""
    return Expansions(rules, base, expansion_lengths(rules, base)).of(symbols)[0]


def write_file(doc_ids: list[int | None], ids: list[bytes], end_id: int) -> bytes:
    """One file: header, documents (id, first symbol, ids), rules and symbols in as few bits as their number needs, expansion lengths likewise, null marks."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    counts = np.array([len(x) // 4 for x in ids], np.uint64)
    symbols, rules = compress(flat, end_id)
    base = int(flat.max(initial=0)) + 1
    lengths = expansion_lengths(rules, base)
    weight = np.ones(len(symbols), np.uint64)
    weight[symbols >= base] = lengths[symbols[symbols >= base] - base]
    reached = np.concatenate([[0], np.cumsum(weight)])
    first = np.searchsorted(reached, np.concatenate([[0], np.cumsum(counts)])).astype("<u8")
    width = max(1, (base + len(rules) - 1).bit_length())
    out = io.BytesIO()
    out.write(MAGIC)
    long = max(1, int(lengths.max(initial=0)).bit_length())
    out.write(np.array([len(doc_ids), base, len(rules), len(symbols), width, long], "<u8").tobytes())
    for part in (np.array([x or 0 for x in doc_ids], "<i8"), first, counts.astype("<u8"), pack_bits(rules.ravel(), width), pack_bits(symbols, width), pack_bits(lengths, long), np.array([x is None for x in doc_ids], "u1")):
        out.write(part.tobytes())
    return out.getvalue()


class TokenFile:
    """A file in memory or mapped: ``ids(k)`` decodes document k alone, ``ids(k, a, b)`` a range of it."""

    def __init__(self, data: bytes | memoryview) -> None:
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token file")
        n, self.base, n_rules, n_symbols, self.width, long = (int(x) for x in np.frombuffer(data, "<u8", 6, 8))
        at = 56

        def take(dtype: str, count: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(data, dtype, count, at)
            at += part.nbytes
            return part

        ids = take("<i8", n)
        self.first, self.n_tokens = take("<u8", n + 1), take("<u8", n)
        self.rules = unpack_bits(take("<u8", 2 * n_rules * self.width // 64 + 2), self.width, 0, 2 * n_rules).reshape(-1, 2)
        self.packed = take("<u8", n_symbols * self.width // 64 + 2)
        self.lengths = unpack_bits(take("<u8", n_rules * long // 64 + 2), long, 0, n_rules)
        null = take("u1", n)
        self.doc_ids = [None if z else int(x) for x, z in zip(ids, null, strict=True)]

    @functools.cached_property
    def expansions(self) -> Expansions:
        return Expansions(self.rules, self.base, self.lengths)

    def symbols(self, k: int, stop: int) -> np.ndarray:
        """The symbols of documents ``k`` to ``stop``."""
        return unpack_bits(self.packed, self.width, int(self.first[k]), int(self.first[stop]))

    def ids(self, k: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        symbols = self.symbols(k, k + 1)
        if start == 0 and stop is None:
            return self.expansions.of(symbols)[0]
        stop = int(self.n_tokens[k]) if stop is None else stop
        weight = np.ones(len(symbols), np.int64)
        deep = symbols >= self.base
        weight[deep] = self.lengths[symbols[deep].astype(np.int64) - self.base]
        reached = np.concatenate([[0], np.cumsum(weight)])
        a = max(0, int(np.searchsorted(reached, start, "right")) - 1)
        b = int(np.searchsorted(reached, stop))
        return self.expansions.of(symbols[a:b])[0][start - int(reached[a]) : stop - int(reached[a])]


def write(docs: DataFrame, tokenizer: str, end_id: int = 0, ws: Workspace | None = None) -> DataFrame:
    """Write the ids of all texts in ascending ``doc_id`` order; the written list ``file, before, n_docs, n_tokens``.

    Texts (null: empty) are range-partitioned by ``doc_id``, a null one first,
    and each task writes its rows to files of about ``FILE_IDS`` ids: under a
    name of the task's own, then renamed, so a repeated task leaves whole
    files only. Rows that repeat a ``doc_id`` are ordered by text. ``before``
    counts the ids of all earlier files. An empty table gives no file.
    """
    spark = docs.sparkSession
    ws = ws or Workspace(spark, "token-files")
    small_arrow_batches(spark)
    parts = max(1, min(10_000, docs.count() // 4000 + 1))
    root, end = f"{ws.root}/files", np.array([end_id], "<u4").tobytes()
    out = pa.schema([("file", pa.string()), ("part", pa.int64()), ("number", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        encode, task = encoder(tokenizer).encode, TaskContext.get()
        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        keys: list[int | None] = []
        held: list[bytes] = []
        size = number = 0

        def flush() -> pa.RecordBatch:
            nonlocal size, number
            name = f"{task.partitionId():06d}-{number:06d}.rp"
            temporary = f"{folder}/_{task.taskAttemptId()}-{name}"
            with store.open_output_stream(temporary) as f:
                f.write(write_file(keys, held, end_id))
            store.move(temporary, f"{folder}/{name}")
            row = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([f"{root}/{name}", task.partitionId(), number, len(keys), size // 4], out.types, strict=True)], schema=out)
            keys.clear()
            held.clear()
            size, number = 0, number + 1
            return row

        for batch in gathered(batches):
            for key, ids in zip(batch[0].to_pylist(), encode(batch[1]), strict=True):
                keys.append(key)
                held.append(ids + end)
                size += len(ids) + 4
                if size >= 4 * FILE_IDS:
                    yield flush()
        if held:
            yield flush()

    placed = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    files = ws.table(placed.mapInArrow(save, "file string, part long, number long, n_docs long, n_tokens long"), "list")
    return running_sum(ws, files.withColumnRenamed("n_tokens", "ids"), [], ["part", "number"], "ids", "ordered").select("file", "before", "n_docs", F.col("ids").alias("n_tokens"))


def read(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document of the listed files: ``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``."""
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for name, before in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                store, path = fs.FileSystem.from_uri(name)
                with store.open_input_file(path) as f:
                    file = TokenFile(f.read())
                starts = before + np.concatenate([[0], np.cumsum(file.n_tokens.astype(np.int64))[:-1]])
                for a in range(0, len(file.doc_ids), 512):
                    b = min(a + 512, len(file.doc_ids))
                    flat = file.expansions.of(file.symbols(a, b))[0].astype("<u4", copy=False)
                    ids = np.split(flat, np.cumsum(file.n_tokens[a : b - 1].astype(np.int64)))
                    columns = [file.doc_ids[a:b], starts[a:b], file.n_tokens[a:b].astype(np.int64), [zlib.crc32(x.tobytes()) for x in ids]] + [[x.astype("<i4") for x in ids]] * with_ids
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, out.types, strict=True)], schema=out)

    spread = files.select("file", "before").repartition(max(1, min(10_000, files.count())), F.xxhash64("file"))
    return spread.mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
