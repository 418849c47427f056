"""Language-model scoring with an n-gram trie of Elias-Fano levels, in files that workers map."""

from __future__ import annotations

import json
import mmap
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Workspace, small_arrow_batches
from lexmill.llm.elias_fano import EliasFano

#: Keys that a task holds before it sends sorted runs, and tokens that are scored at once.
HELD, CHUNK = 2_000_000, 1_000_000
#: Training tokens behind one file of the second level, and of each level above, whose n-grams repeat less.
SHARD_TOKENS, UPPER_TOKENS = 4_000_000, 2_000_000
_M1, _M2, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(32)


def hashes_of(words: pa.Array) -> np.ndarray:
    """64-bit hashes of the UTF-8 bytes of strings, all at once: eight bytes a step, mixed by multiplication."""
    words = words.cast(pa.large_string())
    bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[: bounds[-1]] if len(words) else np.empty(0, np.uint8)
    # every eight bytes from any place on, as a number
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    size, start = np.diff(bounds), bounds[:-1]
    out = size.astype(np.uint64) * _M1
    open_, at = np.arange(len(size)), 0
    while len(open_ := open_[size[open_] > at]):
        place = start[open_] + at
        left = np.minimum(size[open_] - at, 8)
        value = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))[place]
        value = value & (~np.uint64(0) >> (np.uint64(8) * (8 - left).astype(np.uint64)))
        x = (out[open_] ^ value) * _M2
        x = (x ^ x >> _SHIFT) * _M1
        out[open_] = x ^ x >> np.uint64(29)
        at += 8
    return out


#: The end of a document as a token; no word is empty, so no word has this hash.
END = hashes_of(pa.array([""]))[0]


def held_out(doc_id: Column) -> Column:
    """Whether a document is left out of training: crc32 of the ``doc_id`` as text divides by 10; null counts as empty text."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 10 == 0


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, each text's end token included, and where each text starts."""
    if texts.offset:
        # Arrow lowers the wrong bytes of a slice
        texts = pa.array(texts.to_pylist(), texts.type)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    flat, off = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    coded = pc.dictionary_encode(flat)
    code, hashes = coded.indices.to_numpy(zero_copy_only=False), hashes_of(coded.dictionary)
    real = (hashes != END)[code] if len(code) else np.empty(0, bool)
    before = np.concatenate([[0], np.cumsum(real)])
    n_words = before[off[1:]] - before[off[:-1]]
    starts = np.concatenate([[0], np.cumsum(n_words + 1)])
    out = np.full(starts[-1], END)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    out[np.arange(len(doc)) + doc] = hashes[code[real]]
    return out, starts


def _chunks(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Batches with their tokens and starts, joined to about ``size`` tokens."""
    held: list[pa.RecordBatch] = []
    hashes: list[np.ndarray] = []
    starts, at = [np.zeros(1, np.int64)], 0
    for batch in batches:
        if batch.num_rows:
            h, s = tokens(batch[column])
            held.append(batch)
            hashes.append(h)
            starts.append(s[1:] + at)
            at += len(h)
        if at >= size:
            yield held, np.concatenate(hashes), np.concatenate(starts)
            held, hashes, starts, at = [], [], [np.zeros(1, np.int64)], 0
    if held:
        yield held, np.concatenate(hashes), np.concatenate(starts)


_RUN = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _runs(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
    """One sorted run per shard: gaps of the keys and counts, laid out by byte so that they compress."""
    order = np.argsort(shard, kind="stable")
    keys, counts, shard = keys[order], counts[order].astype("<u4"), shard[order]
    cuts = np.flatnonzero(np.diff(shard)) + 1
    rows = [(int(s[0]), np.diff(k, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes(), c.view(np.uint8).reshape(-1, 4).T.tobytes()) for k, c, s in zip(np.split(keys, cuts), np.split(counts, cuts), np.split(shard, cuts), strict=True) if len(k)]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_RUN.types)], schema=_RUN)


def _merged(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The runs of one shard as sorted distinct keys with summed counts."""
    keys = [np.cumsum(np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64) for x in group["keys"].to_pylist()]
    counts = [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(4, -1).T).view("<u4").ravel() for x in group["counts"].to_pylist()]
    key, count = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(count, first)


def _count(docs: DataFrame, keys_of: Callable[[np.ndarray, np.ndarray], np.ndarray], shard_of: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Runs of the keys that ``keys_of(hashes, starts)`` makes of the texts, counted per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            key, n = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            held.clear()
            return _runs(key[first], np.add.reduceat(n, first), shard_of(key[first]))

        for _, hashes, starts in _chunks(batches, 0, CHUNK):
            if len(keys := keys_of(hashes, starts)):
                held.append(np.unique(keys, return_counts=True))
            if sum(len(k) for k, _ in held) >= HELD:
                yield flush()
        if held:
            yield flush()

    return docs.select("text").mapInArrow(count, "shard int, keys binary, counts binary")


def _save(url: str, arrays: dict[str, np.ndarray], meta: dict) -> None:
    """One file: a JSON head with places, then the arrays; written aside, then renamed."""
    from pyarrow import fs

    heads, at = {}, 0
    for name, a in arrays.items():
        heads[name] = (a.dtype.str, len(a), at)
        at += (a.nbytes + 63) // 64 * 64
    head = json.dumps({"meta": meta, "arrays": heads}).encode()
    head = head.ljust(-(-(len(head) + 8) // 64) * 64 - 8)
    store, path = fs.FileSystem.from_uri(url)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    aside = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(aside) as f:
        f.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            f.write(a.tobytes())
            f.write(b"\0" * (-a.nbytes % 64))
    store.move(aside, path)


def _load(url: str) -> tuple[dict[str, np.ndarray], dict]:
    """A saved file: mapped where workers have it on a path, else read into memory. A missing file raises an error."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(url)
    if isinstance(store, fs.LocalFileSystem):
        with open(path, "rb") as f:
            data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    else:
        with store.open_input_file(path) as f:
            data = f.read()
    size = int.from_bytes(data[:8], "little")
    head = json.loads(data[8 : 8 + size])
    return {n: np.frombuffer(data, d, k, 8 + size + at) for n, (d, k, at) in head["arrays"].items()}, head["meta"]


def _ef(prefix: str, e: EliasFano) -> tuple[dict[str, np.ndarray], dict]:
    return {f"{prefix}_{k}": v for k, v in e.arrays().items()}, {f"{prefix}_n": e.n, f"{prefix}_width": e.width}


def _un_ef(prefix: str, arrays: dict[str, np.ndarray], meta: dict) -> EliasFano:
    return EliasFano(meta[f"{prefix}_n"], meta[f"{prefix}_width"], {f: arrays[f"{prefix}_{f}"] for f in EliasFano.FIELDS})


@dataclass(frozen=True)
class Trie:
    """Where the levels are, and the sums over the training tokens.

    Level 1, ``words-k``: the hashes of the words whose top bits are k, as an
    Elias-Fano sequence, and their counts. A word's id is its place.
    Level n, ``grams-n-k``: successors of all contexts of n - 1 words, for the
    successors whose ids hash to k, so no context's row is in one file alone. A
    context of one word is its id, a longer one the id of its n-gram on the
    level below: the place there after the n-grams of the files before.
    Elias-Fano pointers give a context's row; ids in it are added to the last
    value of the row before, which makes one monotone sequence; counts are kept
    in as few bytes as the largest of a file needs.
    """

    folder: str
    bits: int
    offsets: tuple[int, ...]
    tokens: int
    types: int
    concentration: float
    #: For each level from the second on, the id of the first n-gram of each file.
    grams: tuple[tuple[int, ...], ...] = ()

    @property
    def order(self) -> int:
        return 1 + len(self.grams)

    @property
    def word_bits(self) -> int:
        """Low bits of an n-gram's key, for the last word; the context has the rest."""
        return max(1, self.types.bit_length())


class Words:
    """Level 1 in use."""

    def __init__(self, trie: Trie) -> None:
        self.trie, self.files = trie, {}

    def _file(self, k: int) -> tuple[EliasFano, np.ndarray] | None:
        """File k; none if no training word belongs there."""
        if k not in self.files:
            bounds = [*self.trie.offsets, self.trie.types]
            self.files[k] = None
            if bounds[k + 1] > bounds[k]:
                arrays, meta = _load(f"{self.trie.folder}/words-{k}")
                self.files[k] = _un_ef("hash", arrays, meta), arrays["counts"]
        return self.files[k]

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (-1 if unknown) and count (0) of each hash."""
        unique, back = np.unique(hashes, return_inverse=True)
        ids, counts = np.full(len(unique), -1, np.int64), np.zeros(len(unique), np.int64)
        shard = (unique >> np.uint64(64 - self.trie.bits)).astype(np.int64) if self.trie.bits else np.zeros(len(unique), np.int64)
        cuts = np.searchsorted(shard, np.arange((1 << self.trie.bits) + 1))
        for k in np.unique(shard).tolist():
            if file := self._file(k):
                part = slice(cuts[k], cuts[k + 1])
                place = file[0].find(unique[part])
                known = place >= 0
                ids[part] = np.where(known, place + self.trie.offsets[k], -1)
                counts[part] = np.where(known, file[1][np.maximum(place, 0)], 0)
        return ids[back], counts[back]

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the additive unigram probability."""
        return np.log10((counts + 0.1) / (self.trie.tokens + 0.1 * (self.trie.types + 1)))


def _gram_shard(word: np.ndarray, files: int) -> np.ndarray:
    mixed = word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(files)).astype(np.int32)


def _shifted(values: np.ndarray, starts: np.ndarray, first: int) -> np.ndarray:
    """The value before each token; a text's first token has ``first``."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[starts[:-1]] = first
    return out


def train(docs: DataFrame, concentration: float = 50.0, order: int = 2) -> Trie:
    """Count the training documents and write ``order`` levels under the shared folder.

    All counts run over the whole training texts and keep every n-gram. Tasks
    send sorted, compact runs of keys; each file of a level is merged and
    written by one task from its runs, and the number of files follows the
    number of documents and tokens, so a file's size is bounded. A key of 64
    bits holds a context's id and a word's id. A probability is smoothed with
    that of the context without its first word by a Dirichlet prior of
    ``concentration`` words, a pair's with the unigram probability.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    ws = Workspace(spark, "lm")
    folder = f"{ws.root}/trie"
    learned = docs.where(~held_out(F.col("doc_id"))).select("text")
    bits = max(4, min(20, (docs.count() // 16_000).bit_length()))

    def write_words(key: tuple, group: pa.Table) -> pa.Table:
        hashes, counts = _merged(group)
        arrays, meta = _ef("hash", EliasFano.build(hashes))
        small = counts.astype(np.uint32) if counts.max() < 1 << 32 else counts.astype(np.uint64)
        _save(f"{folder}/words-{key[0].as_py()}", arrays | {"counts": small}, meta)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "types": [len(hashes)], "tokens": [int(counts.sum())]})

    runs = _count(learned, lambda h, _: h, lambda k: (k >> np.uint64(64 - bits)).astype(np.int32))
    words = ws.table(runs.groupBy("shard").applyInArrow(write_words, "shard int, types long, tokens long"), "words").collect()
    sizes = {r["shard"]: r["types"] for r in words}
    offsets, at = [], 0
    for k in range(1 << bits):
        offsets.append(at)
        at += sizes.get(k, 0)
    n = sum(r["tokens"] for r in words)
    trie = Trie(folder, bits, tuple(offsets), n, at, concentration)
    for level in range(2, order + 1):
        trie = _add_level(ws, learned, trie, level)
    return trie


def _add_level(ws: Workspace, learned: DataFrame, trie: Trie, n: int) -> Trie:
    """The trie with level ``n``, counted with the ids of the levels below."""
    contexts = trie.grams[-1][-1] if trie.grams else trie.types
    if contexts.bit_length() + trie.word_bits > 64:
        raise ValueError(f"{contexts} contexts and {trie.types} words don't fit a key of level {n}")
    files = max(1, -(-trie.tokens // (SHARD_TOKENS if n == 2 else UPPER_TOKENS)))
    shift = np.uint64(trie.word_bits)

    def keys(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        levels = _levels(trie)
        ids, counts = levels.words.ids(hashes)
        *_, (context, _, _) = levels.walk(ids, counts, starts, n)
        known = np.flatnonzero(context >= 0)
        return context[known].astype(np.uint64) << shift | ids[known].astype(np.uint64)

    def write(key: tuple, group: pa.Table) -> pa.Table:
        gram, counts = _merged(group)
        _save(f"{trie.folder}/grams-{n}-{key[0].as_py()}", *_gram_level(gram >> shift, gram & (np.uint64(1) << shift) - np.uint64(1), counts))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "grams": [len(gram)]})

    runs = _count(learned, keys, lambda k: _gram_shard(k & (np.uint64(1) << shift) - np.uint64(1), files))
    rows = ws.table(runs.groupBy("shard").applyInArrow(write, "shard int, grams long"), f"grams-{n}").collect()
    sizes = {r["shard"]: r["grams"] for r in rows}
    return replace(trie, grams=(*trie.grams, tuple(np.cumsum([0, *(sizes.get(k, 0) for k in range(files))]).tolist())))


def _gram_level(context: np.ndarray, word: np.ndarray, counts: np.ndarray) -> tuple[dict[str, np.ndarray], dict]:
    word = word.astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    last = np.concatenate([first[1:], [len(word)]]) - 1
    bases = np.concatenate([[0], np.cumsum(word[last] + 1)[:-1]])
    monotone = word + np.repeat(bases, last - first + 1)
    arrays, meta = {"counts": counts.astype(np.min_scalar_type(int(counts.max())))}, {}
    for name, values in (("context", context[first]), ("pointer", np.append(first, len(word))), ("base", bases), ("next", monotone)):
        a, m = _ef(name, EliasFano.build(values.astype(np.uint64)))
        arrays |= a
        meta |= m
    return arrays, meta


class Grams:
    """One file of an upper level in use."""

    def __init__(self, path: str) -> None:
        arrays, meta = _load(path)
        self.counts = arrays["counts"]
        self.context, self.pointer, self.base, self.next = (_un_ef(n, arrays, meta) for n in ("context", "pointer", "base", "next"))

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Place of each n-gram, -1 where it was not seen: a successor search relative to the context's row. Contexts are sorted."""
        out = np.full(len(word), -1, np.int64)
        new = np.concatenate([[True], context[1:] != context[:-1]])
        back = np.cumsum(new) - 1
        row = self.context.find(context[new])
        known = np.maximum(row, 0)
        first, stop, base = self.pointer.get(known).astype(np.int64), self.pointer.get(known + 1).astype(np.int64), self.base.get(known)
        ok = np.flatnonzero(row[back] >= 0)
        at = back[ok]
        out[ok] = self.next.find(base[at] + word[ok], first[at], stop[at])
        return out


class Levels:
    """All levels in use."""

    def __init__(self, trie: Trie) -> None:
        self.trie, self.words, self.files = trie, Words(trie), {}
        end, count = self.words.ids(np.array([END]))
        self.end, self.end_count = int(end[0]), int(count[0])

    def _file(self, n: int, k: int) -> Grams | None:
        if (n, k) not in self.files:
            bounds = self.trie.grams[n - 2]
            self.files[n, k] = Grams(f"{self.trie.folder}/grams-{n}-{k}") if bounds[k + 1] > bounds[k] else None
        return self.files[n, k]

    def find(self, n: int, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (-1 if unseen) and count (0) of each n-gram; each is looked up once."""
        shift, offsets = np.uint64(self.trie.word_bits), self.trie.grams[n - 2]
        key, back = np.unique(context.astype(np.uint64) << shift | word.astype(np.uint64), return_inverse=True)
        context, word = key >> shift, key & (np.uint64(1) << shift) - np.uint64(1)
        ids, counts = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
        shard = _gram_shard(word, len(offsets) - 1)
        order = np.argsort(shard, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            if len(own) and (file := self._file(n, k := int(shard[own[0]]))):
                place = file.find(context[own], word[own])
                ids[own] = np.where(place >= 0, place + offsets[k], -1)
                counts[own] = np.where(place >= 0, file.counts[np.maximum(place, 0)], 0)
        return ids[back], counts[back]

    def walk(self, ids: np.ndarray, counts: np.ndarray, starts: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each n from 2 to ``order``: id (-1 if none) and count of each token's context of n - 1 words, and count of its n-gram.

        A text follows an end, and no context reaches further back. The n-grams
        of a level that is not written yet count 0.
        """
        first, first_count = self.end, self.end_count
        for n in range(2, order + 1):
            context, seen = _shifted(ids if n == 2 else gram, starts, first), _shifted(counts, starts, first_count)
            # an n-gram was seen only if its context and its last n - 1 words were
            ok = np.flatnonzero((context >= 0) & ((ids if n == 2 else gram) >= 0))
            gram, counts = np.full(len(ids), -1, np.int64), np.zeros(len(ids), np.int64)
            if n <= self.trie.order and len(ok):
                gram[ok], counts[ok] = self.find(n, context[ok], ids[ok])
            yield context, seen, counts
            first, first_count = -1, 0


_open: dict[tuple[str, int], Levels] = {}


def _levels(trie: Trie) -> Levels:
    """The worker's mapping of a trie."""
    key = trie.folder, trie.order
    if key not in _open:
        _open.clear()
        _open[key] = Levels(trie)
    return _open[key]


def score(docs: DataFrame, trie: Trie) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``base_score`` is the additive unigram score, ``score`` the model's log10
    probability of the text and its end. A null text is an empty one: just an
    end. Repeated rows are scored one by one; other columns are ignored.
    """
    small_arrow_batches(docs.sparkSession)
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, mu = _levels(trie), trie.concentration
        for held, hashes, starts in _chunks(batches, 2, CHUNK):
            ids, counts = levels.words.ids(hashes)
            base = levels.words.unigram(counts)
            p = 10**base
            for _, seen, number in levels.walk(ids, counts, starts, trie.order):
                p = (number + mu * p) / (seen + mu)
            logs = np.log10(p)
            sums = [np.add.reduceat(x, starts[:-1]) for x in ((counts > 0).astype(np.int64), base, logs)]
            table = pa.Table.from_batches(held)
            n = len(starts) - 1
            columns = [table[0].combine_chunks(), table[1].combine_chunks(), np.diff(starts), sums[0], np.full(n, trie.tokens), sums[1], sums[2]]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, out.types, strict=True)], schema=out)

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
