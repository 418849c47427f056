"""Hyperlink labels, tokens, and the alignment of labels to tokens."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import batched, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType
from pyspark.sql.window import Window

from lexmill.functions import text as T

ANCHOR = r"""(?is)^.*?<a\s+.*?href\s*=\s*(["']?)([^"']*)\1.*?>(.*)$"""


def hyperlinks(items: DataFrame, offset_type: str = "CHARS", require_abs_url: bool = True, domain_substrings: Iterable[str] = (), annotator: str = "author") -> DataFrame:
    """Labels of the texts of ``<a href>`` elements of ``clean_html``: ``stream_id, target_id, first, length, value``.

    The page is split at closing tags and each piece carries the length of the
    pieces before it, so offsets come from one running sum in the page; Arrow
    does both, and hands on only pieces that a tag closes and that name a link.
    """
    size, measure = (F.octet_length, pc.binary_length) if offset_type == "BYTES" else (F.length, pc.utf8_length)
    kind = dict(items.dtypes)["stream_id"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, owner, before, closed = _pieces(batch[1], measure)
            at = np.flatnonzero(closed)
            yield pa.RecordBatch.from_arrays([batch[0].take(pa.array(owner[at])), parts.take(pa.array(at)).cast(pa.string()), pa.array(before[at])], names=["stream_id", "part", "before"])

    rows = items.select("stream_id", "clean_html").mapInArrow(split, f"stream_id {kind}, part string, before long").where(F.col("part").rlike(ANCHOR))
    # the text is what is left of the piece behind the opening tag
    rows = rows.select("stream_id", "part", "before", F.regexp_extract("part", ANCHOR, 2).alias("target_id"), F.regexp_extract("part", ANCHOR, 3).alias("value"))
    found = rows.select("stream_id", "target_id", (F.col("before") + size("part") - size("value")).cast("long").alias("first"), size("value").cast("int").alias("length"), "value")
    if require_abs_url:
        found = found.where(F.lower("target_id").rlike("^https?://"))
    names = list(domain_substrings)
    if names:
        domain = F.get(F.split("target_id", "/"), F.lit(2))
        test: Column = F.lit(False)
        for n in names:
            test = test | F.coalesce(domain.contains(n), F.lit(False))
        found = found.where(test)
    return found.withColumns({"annotator_id": F.lit(annotator), "offset_type": F.lit(offset_type), "content_form": F.lit("clean_html"), "positive": F.lit(True)})


def _pieces(pages: pa.Array, measure: Callable[[pa.Array], pa.Array]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Pages split at closing tags: the pieces, the page of each, its place there, and whether a tag closes it and it may name a link."""
    lists = pc.split_pattern_regex(pages.cast(pa.large_string()), "(?i)</a>")
    parts, off = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    reached = np.concatenate([[0], np.cumsum(measure(parts).to_numpy(zero_copy_only=False).astype(np.int64) + 4)])
    owner = np.repeat(np.arange(len(pages)), np.diff(off))
    closed = np.ones(len(parts), bool)
    closed[off[1:][np.diff(off) > 0] - 1] = False
    closed &= pc.match_substring(parts, "href", ignore_case=True).to_numpy(zero_copy_only=False)
    return parts, owner, reached[:-1] - reached[off[:-1]][owner], closed


def linked_tokens(items: DataFrame, text: str = "clean_visible", require_abs_url: bool = True, linked_only: bool = False) -> DataFrame:
    """``stream_id, token_num, char_first, target_id``: white-space tokens of a text, each with the link whose text it starts in, or null.

    The rows of ``align_labels`` and ``attach_labels`` for ``hyperlinks`` and
    ``whitespace_tokens`` of one table, where ``text`` has the offsets of
    ``clean_html``: a link's text ends its piece of the page, so a token can
    only lie in the link of its own piece, and no row moves.
    """
    kind = dict(items.dtypes)["stream_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bounded parts, for a few very long pages
            for at in range(0, batch.num_rows, 64):
                ids, pages, texts = batch.slice(at, 64).columns
                parts, owner, before, closed = _pieces(pages, pc.utf8_length)
                _, page, number, first = token_places(texts)
                # place of the piece that each token starts in
                wide = max(int(before.max(initial=0)), int(first.max(initial=0))) + 1
                piece = np.searchsorted(owner * wide + before, page * wide + first, "right") - 1
                inside = (piece >= 0) & (owner[piece] == page) & closed[piece] if len(owner) else np.zeros(len(piece), bool)
                for some, linked in ((np.flatnonzero(inside), True), (np.flatnonzero(~inside), False)):
                    if not len(some) or (linked_only and not linked):
                        continue
                    group = piece[some] if linked else page[some]
                    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
                    offsets = pa.array(np.append(starts, len(some)), pa.int32())
                    lists = [pa.ListArray.from_arrays(offsets, pa.array(x[some])) for x in (number, first)]
                    row, of = pa.array(page[some][starts]), pa.array(group[starts])
                    part = parts.take(of).cast(pa.string()) if linked else pa.nulls(len(starts), pa.string())
                    begin = pa.array(before[group[starts]]) if linked else pa.nulls(len(starts), pa.int64())
                    yield pa.RecordBatch.from_arrays([ids.take(row), part, begin, *lists], names=["stream_id", "part", "before", "number", "first"])

    rows = items.select("stream_id", "clean_html", F.col(text).alias("text")).mapInArrow(run, f"stream_id {kind}, part string, before long, number array<int>, first array<long>")
    target = F.when(F.col("part").rlike(ANCHOR), F.regexp_extract("part", ANCHOR, 2))
    value = F.regexp_extract("part", ANCHOR, 3)
    stop = F.col("before") + F.length("part")
    found = rows.select("stream_id", target.alias("target"), (stop - F.length(value)).alias("begin"), stop.alias("stop"), F.explode(F.arrays_zip("number", "first")).alias("token"))
    covered = F.col("target").isNotNull() & (F.col("token.first") >= F.col("begin")) & (F.col("token.first") < F.col("stop"))
    if require_abs_url:
        covered = covered & F.lower("target").rlike("^https?://")
    made = found.select("stream_id", F.col("token.number").alias("token_num"), F.col("token.first").alias("char_first"), F.when(covered, F.col("target")).alias("target_id"))
    return made.where("target_id is not null") if linked_only else made


def hyperlinks_by_line(items: DataFrame, annotator: str = "author") -> DataFrame:
    """As above with LINES offsets: the line of the anchor's start, and the lines its text spans."""
    found = hyperlinks(items, "CHARS", annotator=annotator).withColumnRenamed("first", "__at")
    rows = found.join(items.select("stream_id", "clean_html"), "stream_id")
    line = F.length("__head") - F.length(F.replace("__head", F.lit("\n")))
    rows = rows.withColumn("__head", F.substring("clean_html", F.lit(1), F.col("__at").cast("int"))).withColumn("first", line.cast("long"))
    return rows.withColumn("length", (F.length("value") - F.length(F.replace("value", F.lit("\n"))) + 1).cast("int")).withColumn("offset_type", F.lit("LINES")).drop("__head", "__at", "clean_html")


def replace_labels(old: DataFrame, new: DataFrame, annotator: str = "author") -> DataFrame:
    """``old`` with the annotator's labels replaced for the items that have new ones."""
    stale = new.select("stream_id").distinct()
    return old.where(F.col("annotator_id") != annotator).unionByName(old.where(F.col("annotator_id") == annotator).join(stale, "stream_id", "left_anti")).unionByName(new, allowMissingColumns=True)


def covered_text(labels: DataFrame, items: DataFrame) -> DataFrame:
    """``stream_id, target_id, text``: what each CHARS label covers."""
    text = F.when(F.col("content_form") == "clean_html", F.col("clean_html")).otherwise(F.col("clean_visible"))
    return labels.where("offset_type = 'CHARS'").join(items.select("stream_id", "clean_html", "clean_visible"), "stream_id").select("stream_id", "target_id", F.substring(text, (F.col("first") + 1).cast("int"), F.col("length")).alias("text"))


def whitespace_tokens(items: DataFrame, text: str = "clean_visible") -> DataFrame:
    """``stream_id, token_num, token, char_first``: runs of other than ASCII white space, with offsets.

    Offsets and numbers lie inside one text, so no row moves: Arrow splits the
    texts of a batch, and one pass over its bytes gives the offsets.
    """
    kind = dict(items.dtypes)["stream_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bounded parts, for a few very long texts
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                tokens, owner, number, first = token_places(part[1])
                yield pa.RecordBatch.from_arrays([part[0].take(pa.array(owner)), pa.array(number), tokens, pa.array(first)], names=["stream_id", "token_num", "token", "char_first"])

    return items.select("stream_id", F.col(text).alias("text")).mapInArrow(run, f"stream_id {kind}, token_num int, token string, char_first long")


def token_lists(items: DataFrame, text: str = "clean_visible") -> DataFrame:
    """``stream_id, token_num, token, char_first`` as ``whitespace_tokens``, but one row of arrays for each text that has tokens."""
    kind = dict(items.dtypes)["stream_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                tokens, owner, number, first = token_places(part[1])
                starts = np.flatnonzero(number == 0)
                offsets = pa.array(np.append(starts, len(number)), pa.int32())
                yield pa.RecordBatch.from_arrays([part[0].take(pa.array(owner[starts])), *(pa.ListArray.from_arrays(offsets, x) for x in (pa.array(number), tokens, pa.array(first)))], names=["stream_id", "token_num", "token", "char_first"])

    return items.select("stream_id", F.col(text).alias("text")).mapInArrow(run, f"stream_id {kind}, token_num array<int>, token array<string>, char_first array<long>")


def token_places(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of the texts, the place of each one's text, its number there and its first character."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] > bounds[0] else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    starts = bounds[:-1][np.diff(bounds) > 0]
    begins[starts] = word[starts]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    ends[starts[starts > 0] - 1] = word[starts[starts > 0] - 1]
    first, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    # tokens in a row, without what parts them
    offsets = np.concatenate([[0], np.cumsum(stop - first)]).astype(np.int64)
    tokens = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data[word])).cast(pa.string())
    owner = np.searchsorted(bounds, first, "right") - 1
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    number = np.arange(len(first)) - np.searchsorted(first, bounds[:-1])[owner]
    return tokens, owner, number.astype(np.int32), chars[first] - chars[bounds[:-1]][owner]


_SENTENCE = re.compile(r"[.!?]+[\"')\]]*(?=\s+[\"'(\[]?[A-Z0-9\xc0-\xde]|\s*$)")
_ABBREVIATION = re.compile(r"(?:\b[A-Za-z]|\b(?:Mr|Mrs|Ms|Dr|Prof|Inc|Ltd|Co|Corp|St|vs|etc|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec))\.$")


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Sentences by end marks before a capital, a digit or the end, common abbreviations aside."""
    spans, begin = [], 0
    for m in _SENTENCE.finditer(text):
        if _ABBREVIATION.search(text, max(begin, m.end() - 8), m.end()):
            continue
        spans.append((begin, m.end()))
        begin = m.end()
    if text[begin:].strip():
        spans.append((begin, len(text)))
    out = []
    for a, b in spans:
        piece = text[a:b]
        a += len(piece) - len(piece.lstrip())
        if a < b:
            out.append((a, b))
    return out


TOKEN_COLUMNS = "stream_id string, sentence_id int, sentence_pos int, token_num int, token string, char_first long, char_length int"
_WORD = re.compile(r"\S+")


def tokenize(items: DataFrame, labels: DataFrame | None = None, annotator: str | None = None) -> DataFrame:
    """Sentences and white-space tokens of ``clean_visible`` with character offsets.

    A sentence never ends inside a label of the annotator: it is extended by
    the sentences after it. Tokens get that label by ``attach_labels``.
    """
    rows = items.select("stream_id", F.col("clean_visible").alias("text"))
    if labels is not None and annotator:
        own = labels.where((F.col("annotator_id") == annotator) & (F.col("offset_type") == "CHARS")).groupBy("stream_id").agg(F.sort_array(F.collect_list(F.struct("first", "length"))).alias("marks"))
        rows = rows.join(own, "stream_id", "left")
    else:
        rows = rows.withColumn("marks", F.lit(None).cast("array<struct<first: bigint, length: int>>"))

    return rows.mapInArrow(token_batches, TOKEN_COLUMNS)


def _extended(text: str, ends: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Sentences, each extended to the first end that lies inside no label."""
    begin = None
    for a, b in sentence_spans(text):
        begin = a if begin is None else begin
        if not any(x < b < y for x, y in ends):
            yield begin, b
            begin = None
    if begin is not None:
        yield begin, len(text)


def _words(text: str, begin: int, end: int, most: int) -> Iterator[tuple[list[str], list[int]]]:
    """White-space words of a part of a text and their places, at most ``most`` at a time."""
    if end - begin > most:
        for some in batched(_WORD.finditer(text, begin, end), most):
            yield [m[0] for m in some], [m.start() for m in some]
        return
    words, starts, at = text[begin:end].split(), [], begin
    for w in words:
        at = text.index(w, at)
        starts.append(at)
        at += len(w)
    yield words, starts


def token_batches(batches: Iterable[pa.RecordBatch], most: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Tokens of the rows ``stream_id, text, marks`` in batches of about ``most`` tokens, whatever a text's length."""
    schema = pa.schema([("stream_id", pa.string()), ("sentence_id", pa.int32()), ("sentence_pos", pa.int32()), ("token_num", pa.int32()), ("token", pa.string()), ("char_first", pa.int64()), ("char_length", pa.int32())])
    made: list[list] = [[] for _ in schema]
    sids, sentences, places, numbers, words, firsts, lengths = made

    def taken() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, schema, strict=True)], schema=schema)
        for c in made:
            c.clear()
        return batch

    for batch in batches:
        for sid, value, marked in zip(*(batch.column(c) for c in ("stream_id", "text", "marks")), strict=True):
            text, marks, number = value.as_py() or "", marked.as_py() or (), 0
            ends = [(m["first"], m["first"] + m["length"]) for m in marks]
            for sentence, (begin, end) in enumerate(_extended(text, ends)):
                pos = 0
                for some, starts in _words(text, begin, end, most):
                    n = len(some)
                    sids.extend(repeat(sid.as_py(), n))
                    sentences.extend(repeat(sentence, n))
                    places.extend(range(pos, pos + n))
                    numbers.extend(range(number, number + n))
                    words.extend(some)
                    firsts.extend(starts)
                    lengths.extend(map(len, some))
                    pos, number = pos + n, number + n
                    if len(sids) >= most:
                        yield taken()
    if sids:
        yield taken()


def attach_labels(tokens: DataFrame, labels: DataFrame, annotator: str) -> DataFrame:
    """As-of join: each token gets the latest label that starts at or before it, if that covers the token's start.

    Labels and tokens of an item are merged by offset in one window pass.
    ``mention_id`` numbers the labels of an item by first use.
    """
    own = labels.where((F.col("annotator_id") == annotator) & (F.col("offset_type") == "CHARS"))
    marks = own.groupBy("stream_id", F.col("first").alias("at")).agg(F.max(F.struct((F.col("first") + F.col("length")).alias("stop"), "target_id")).alias("label"))
    both = tokens.select("stream_id", F.col("char_first").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(marks.schema["label"].dataType).alias("label"), F.struct(*tokens.columns).alias("token")).unionByName(
        marks.select("stream_id", "at", F.lit(0).alias("kind"), "label", F.lit(None).cast(tokens.schema).alias("token"))
    )
    order = Window.partitionBy("stream_id").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("latest", F.last("label", ignorenulls=True).over(order)).withColumn("start", F.max(F.when(F.col("kind") == 0, F.col("at"))).over(order)).where("kind = 1")
    covered = F.col("latest.stop") > F.col("at")
    rows = found.select("token.*", F.when(covered, F.col("latest.target_id")).alias("target_id"), F.when(covered, F.col("start")).alias("__start"))
    number = F.dense_rank().over(Window.partitionBy("stream_id").orderBy(F.col("__start").asc_nulls_last())) - 1
    return rows.withColumn("mention_id", F.when(F.col("__start").isNotNull(), number).otherwise(F.lit(-1))).drop("__start")


def align_labels(tokens: DataFrame, labels: DataFrame, offset_type: str = "CHARS") -> DataFrame:
    """Range join: the tokens that start inside a label, ``first <= start < first + length``."""
    start = {"CHARS": "char_first", "BYTES": "byte_first", "LINES": "line_first"}[offset_type]
    t, l = tokens.alias("t"), labels.where(F.col("offset_type") == offset_type).alias("l")
    near = (F.col("t.stream_id") == F.col("l.stream_id")) & (F.col(f"t.{start}") >= F.col("l.first")) & (F.col(f"t.{start}") < F.col("l.first") + F.col("l.length"))
    return t.join(l, near).select("t.stream_id", "t.token_num", "l.annotator_id", "l.target_id")


def names_in_chains(tokens: DataFrame, ratings: DataFrame, selector: str = "ALL") -> DataFrame:
    """Label all tokens of the coreference chains that a rating's mentions fit.

    ALL: each mention is part of some token of the chain. ANY: one is.
    ANY_MULTI_TOKEN: each word of one mention is. Tokens are cleansed, mentions
    are not; a token without a chain (-1) is a chain of its own.
    """
    keyed = tokens.withColumn("__chain", F.when(F.col("equiv_id") == -1, F.concat(F.lit("t"), F.col("token_num").cast("string"))).otherwise(F.col("equiv_id").cast("string")))
    chains = keyed.groupBy("stream_id", "tagger_id", "__chain").agg(F.collect_set(T.cleanse(F.col("token"))).alias("__names"))
    inside = lambda mention: F.exists("__names", lambda n: n.contains(mention))
    fits = {
        "ALL": F.forall("mentions", inside),
        "ANY": F.exists("mentions", inside),
        "ANY_MULTI_TOKEN": F.exists("mentions", lambda m: F.forall(F.split(m, r"\s+"), inside)),
    }[selector]
    hits = chains.join(ratings.select("stream_id", "annotator_id", "target_id", "mentions"), "stream_id").where(fits)
    return keyed.join(hits.select("stream_id", "tagger_id", "__chain", "annotator_id", "target_id"), ["stream_id", "tagger_id", "__chain"]).select("stream_id", "tagger_id", "token_num", "annotator_id", "target_id")


def mention_patterns(mention: str) -> list[str]:
    """A mention is words, or patterns written ``ur"..."``, each for one token."""
    return [m[1] if m[1] is not None else re.escape(m[2]) for m in re.finditer(r'u?r"([^"]*)"|(\S+)', mention)]


@F.pandas_udf(ArrayType(StringType()))
def _patterns(mentions: pd.Series) -> pd.Series:
    return mentions.map(mention_patterns, na_action="ignore")


def multi_token_match(tokens: DataFrame, ratings: DataFrame) -> DataFrame:
    """Label runs of tokens that match the words of a mention, case aside; tokens that cleanse to nothing are passed over.

    A token that cleanses to several words counts as each of them in turn.
    Mentions are exploded into numbered steps: plain words are joined to the
    numbered words of the same item by the word itself, and only steps written
    as patterns are compared with every word of their item.
    """
    keyed = tokens.select("stream_id", "tagger_id", "token_num", F.posexplode(F.split(T.cleanse(F.col("token")), " ")).alias("__part", "__w")).where("__w <> ''")
    order = Window.partitionBy("stream_id", "tagger_id").orderBy("token_num", "__part")
    pattern = F.col("__m").contains('r"')
    mentions = ratings.select("stream_id", "annotator_id", "target_id", F.explode("mentions").alias("__m"))
    plain = mentions.where(~pattern).select("*", F.split(T.cleanse(F.col("__m")), " ").alias("__p")).where(F.get("__p", F.lit(0)) != "")
    formed = mentions.where(pattern).select("*", _patterns("__m").alias("__p"))
    step = ["stream_id", "annotator_id", "target_id", "__m", F.size("__p").alias("__size"), F.posexplode("__p").alias("__k", "__step")]
    # only items that have a mention are numbered
    asked = mentions.select("stream_id").distinct()
    words = keyed.join(asked, "stream_id", "left_semi").withColumn("__n", F.row_number().over(order))
    hit = words.join(plain.select(*step).withColumnRenamed("__step", "__w"), ["stream_id", "__w"])
    by_pattern = words.join(formed.select(*step), "stream_id").where(F.expr("regexp_like(__w, '(?i)^(?:' || __step || ')$')")).drop("__step")
    hit = hit.unionByName(by_pattern)
    runs = hit.groupBy("stream_id", "tagger_id", "annotator_id", "target_id", "__m", (F.col("__n") - F.col("__k")).alias("__begin"), "__size").agg(F.count_distinct("__k").alias("__got"), F.collect_set("token_num").alias("__tokens")).where("__got = __size")
    return runs.select("stream_id", "tagger_id", F.explode("__tokens").alias("token_num"), "annotator_id", "target_id").distinct()


def global_mentions(tokens: DataFrame) -> DataFrame:
    """Mention ids that count per sentence become ids of the document, numbered by first token."""
    real = F.col("mention_id") >= 0
    first = F.min(F.when(real, F.col("token_num"))).over(Window.partitionBy("stream_id", "tagger_id", "sentence_id", "mention_id"))
    rows = tokens.withColumn("__first", F.when(real, first))
    number = F.dense_rank().over(Window.partitionBy("stream_id", "tagger_id").orderBy(F.col("__first").asc_nulls_last())) - 1
    return rows.withColumn("mention_id", F.when(real, number).otherwise(F.lit(-1))).drop("__first")
