"""Ids of whole texts by a public tokenizer file, with a bounded cache of words."""

from __future__ import annotations

import array
import json
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LETTER, _MARK = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]", "[.,;:!?|]"
#: A word of Latin letters and the marks behind it, and perhaps the same on a next line: pre-tokens for every vocabulary handled here.
_PLAIN = rf"\A(?P<w>{_LETTER}+)(?P<m>{_MARK}*)(?:\n(?P<w2>{_LETTER}+)(?P<m2>{_MARK}*))?\z"
_encoders: dict[tuple[str, int], Encoder] = {}


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes.

    Both kinds of BPE that are cached here split at white space before merging,
    so a text's ids are those of its pieces between single spaces: for a
    byte-level vocabulary a piece has the space before it, for a vocabulary
    with word ends it has none. Arrow splits texts, finds the different pieces
    and their words and joins the ids again; only words not seen lately go
    through the merges. Other pieces go to the tokenizers library; texts with
    other spacing or with the spelling of an added token, and other kinds of
    tokenizer, are encoded whole.
    """

    def __init__(self, path: str, entries: int = 350_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spec = json.loads(Path(path).read_text())
        pre = spec.get("pre_tokenizer") or {}
        kinds = [x["type"] for x in pre.get("pretokenizers", [pre]) if x]
        lowered = "Lowercase" in json.dumps(spec.get("normalizer"))
        byte_level = kinds == ["ByteLevel"] and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
        self.kind = "byte" if byte_level else "word" if kinds[:1] == ["Split"] and lowered and pre["pretokenizers"][0].get("invert") else "whole"
        self.added = [t["content"] for t in spec.get("added_tokens") or ()]
        self.entries = entries
        self.words: dict[str, dict[str, bytes]] = {"": {}, " ": {}}
        self.odd: dict[str, dict[str, bytes | None]] = {"": {}, " ": {}}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        self.byte_chars = {b: chr(256 + k) for k, b in enumerate(rest)}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merge(self, part: str) -> bytes:
        """Ids of one pre-token, straight from the merges."""
        plain = part.isascii() and part != "\n"
        mapped = part.replace(" ", self.byte_chars[32]) if plain else part.encode().decode("latin-1").translate(self.byte_chars)
        return array.array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _words(self, words: pa.Array, lead: str) -> pa.Array:
        """Ids of words of letters, or of marks, each with ``lead`` before it; none for the empty word."""
        coded = words.dictionary_encode()
        cache, low = self.words[lead], self.kind == "word"
        if len(cache) > self.entries:
            cache.clear()
        names = coded.dictionary.to_pylist()
        ids = list(map(cache.get, names))
        for k, w in enumerate(names):
            if ids[k] is None:
                ids[k] = cache[w] = self._merge(lead + (w.lower() if low else w)) if w else b""
        return pa.array(ids, pa.large_binary()).take(coded.indices)

    def _pieces(self, pieces: pa.Array, lead: str) -> pa.Array:
        """Ids of different pieces, each with ``lead`` before it; null where a piece is no unit."""
        parts = pc.extract_regex(pieces, _PLAIN)
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        w, m, w2, m2 = (pc.fill_null(x, "") for x in parts.flatten())
        # A line feed between words is a token of its own, and the next word has no space before it.
        feed = pa.scalar(self._merge("\n") if self.kind == "byte" else b"", pa.large_binary())
        second = pc.if_else(pc.equal(w2, ""), pa.scalar(b"", pa.large_binary()), feed)
        ids = pc.binary_join_element_wise(self._words(w, lead), self._words(m, ""), second, self._words(w2, ""), self._words(m2, ""), pa.scalar(b"", pa.large_binary()))
        if plain.all():
            return ids
        at = np.flatnonzero(~plain)
        names, cache = pieces.take(pa.array(at)).to_pylist(), self.odd[lead]
        if len(cache) > self.entries // 10:
            cache.clear()
        missing = [p for p in names if p not in cache]
        if self.kind == "byte":
            # A piece that has white space at an end, or an empty one, means spacing for which pieces are no unit.
            cache.update((p, None) for p in missing if p != p.strip() or (lead and not p))
            missing = [p for p in missing if p not in cache]
        cache.update(zip(missing, self._whole([lead + p for p in missing]), strict=True))
        places = np.arange(len(pieces))
        places[at] = len(pieces) + np.arange(len(at))
        return pa.chunked_array([ids, pa.array([cache[p] for p in names], pa.large_binary())]).combine_chunks().take(pa.array(places))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        if self.kind == "whole":
            return self._whole([x or "" for x in (texts if isinstance(texts, list) else texts.to_pylist())])
        texts = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        lists = pc.split_pattern(texts, " ")
        off = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        off = off - off[0]
        ids, place = self._pieces(coded.dictionary, " " if self.kind == "byte" else ""), coded.indices
        if self.kind == "byte":
            # First pieces have no space before them.
            heads = pc.take(coded.dictionary, coded.indices.take(pa.array(off[:-1]))).dictionary_encode()
            place = np.array(place, np.int64)
            place[off[:-1]] = len(ids) + heads.indices.to_numpy(zero_copy_only=False)
            ids, place = pa.chunked_array([ids, self._pieces(heads.dictionary, "")]).combine_chunks(), pa.array(place)
        all_ = ids.take(place)
        bounds, data = np.frombuffer(all_.buffers()[1], np.int64)[all_.offset : all_.offset + len(all_) + 1][off], all_.buffers()[2]
        data = memoryview(data) if data is not None else memoryview(b"")
        out = [bytes(data[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        whole = np.zeros(len(texts), bool)
        if all_.null_count:
            whole |= np.add.reduceat(all_.is_null().to_numpy(zero_copy_only=False), off[:-1]) > 0
        for name in self.added:
            # the normaliser of the word vocabulary lowers cases before it looks for added tokens
            whole |= pc.match_substring(texts, name, ignore_case=True).to_numpy(zero_copy_only=False)
        if whole.any():
            at = np.flatnonzero(whole)
            for k, x in zip(at.tolist(), self._whole(texts.take(pa.array(at)).to_pylist()), strict=True):
                out[k] = x
        return out


def encoder(path: str, entries: int = 350_000) -> Encoder:
    """The worker's encoder of a file; its cache outlives a task."""
    if (path, entries) not in _encoders:
        _encoders[path, entries] = Encoder(path, entries)
    return _encoders[path, entries]


def gathered(batches: Iterator[pa.RecordBatch], size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The batches joined to about ``size`` bytes: texts encoded together share their words."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)
