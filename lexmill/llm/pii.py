"""Personal data by patterns, and terms that give it away by information-theoretic sanitisation."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import BROADCAST_BYTES, WS, WS_CHARS, Workspace, bit_filter, bit_split, small_arrow_batches

KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(rf"[^{re.escape(WS_CHARS)}]+")
_EDGE = ".,;:!?\"'()[]{}<>|"


@dataclass(frozen=True)
class Disclosure:
    """When a term counts as giving an entity away.

    A term is judged by its share of the entity's information,
    ``log(N p / n_e) / log(N / n_e)``, over lines and over documents, and the
    larger counts: 1 for a term that only occurs beside the entity, 0 for an
    unrelated one. ``p`` is the lower end of Wilson's interval for ``n_te / n_t``,
    so a rare pair is judged too, by less than its plain share.
    """

    #: Share from which a term is generalised to the kind of what it reveals.
    generalise: float = 0.8
    #: Share from which it is removed.
    remove: float = 0.95
    #: Half the interval's width in standard deviations. Copies of a line or text are no further evidence.
    deviations: float = 1.96


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from each ``@`` in linear time."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        end = None
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
        if end:
            found.append((start, end))
            last = end
        at = text.find("@", max(at + 1, last))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of all pattern matches, sorted."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _DOTTED.finditer(text):
            if "." in m[0]:
                parts, at = m[0].split("."), m.start()
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k : k + 4]
                    begin = at + sum(len(p) + 1 for p in parts[:k])
                    if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in four):
                        found.append((begin, 1, begin + len(".".join(four))))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def entity(text: str, span: tuple[int, int, int]) -> str:
    """What a span stands for, alike for all its spellings."""
    a, k, b = span
    value = text[a:b].lower() if k == 0 else re.sub(r"[^0-9.]" if k == 1 else r"[^0-9]", "", text[a:b])
    return f"{KINDS[k]}:{value}"


def terms(line: str) -> list[tuple[int, int, str]]:
    """``(start, end, term)`` of the words of a line, edge marks and case aside, that hold a letter or digit."""
    out = []
    for m in _WORD.finditer(line):
        bare = m[0].strip(_EDGE)
        if any(map(str.isalnum, bare)):
            at = m.start() + m[0].find(bare)
            out.append((at, at + len(bare), bare.lower()))
    return out


def term_key(term: str) -> int:
    """The hash of a term or text, as ``xxhash64`` of Spark makes it."""
    h = xxhash.xxh64_intdigest(term.encode(), 42)
    return h - (h >> 63 << 64)


def outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, str]]:
    """The terms of a text that touch none of the sorted spans, in one walk over both."""
    at, reach = 0, 0
    for a, b, t in terms(text):
        # spans of different kinds may overlap, so the furthest end of those begun counts
        while at < len(spans) and spans[at][0] < b:
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= a:
            yield a, b, t


def _beside(text: str, spans: list[tuple[int, int, int]]) -> dict:
    """What a line or text tells: its key, its entities, and its terms outside of them, all as hashes."""
    return {"unit": term_key(text), "entities": sorted({term_key(entity(text, s)) for s in spans}), "terms": sorted({term_key(t) for _, _, t in outside(text, spans)})}


def _lines(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, str, list[tuple[int, int, int]]]]:
    """Start, text and spans of each line in which a span starts."""
    at = 0
    while at < len(spans):
        begin = text.rfind("\n", 0, spans[at][0]) + 1
        end = text.find("\n", spans[at][0])
        end = len(text) if end < 0 else end
        stop = at
        while stop < len(spans) and spans[stop][0] < end:
            stop += 1
        yield begin, text[begin:end], spans[at:stop]
        at = stop


_BESIDE = "array<struct<unit: long, entities: array<long>, terms: array<long>>>"


def _scan(docs: DataFrame) -> DataFrame:
    """``lines, by_line, by_text`` of the texts: the number of lines, and the entities and terms of units with an entity."""
    beside = pa.list_(pa.struct([("unit", pa.int64()), ("entities", pa.list_(pa.int64())), ("terms", pa.list_(pa.int64()))]))
    out = pa.schema([("lines", pa.int64()), ("by_line", beside), ("by_text", beside)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in out.names]
            for text in batch[0].to_pylist():
                text = text or ""
                spans = base_spans(text)
                near = [_beside(line, [(a - begin, k, b - begin) for a, k, b in own]) for begin, line, own in _lines(text, spans)]
                for column, value in zip(columns, (text.count("\n") + 1, near, [_beside(text, spans)] if spans else []), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, out.types, strict=True)], schema=out)

    return docs.select("text").mapInArrow(scan, f"lines long, by_line {_BESIDE}, by_text {_BESIDE}")


def _unit_counts(docs: DataFrame, wanted: DataFrame, by: str) -> DataFrame:
    """``t, n_t``: lines or texts of the corpus that hold each wanted term (and perhaps some others)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    unit = F.explode(F.split(text, "\n")) if by == "by_line" else text
    word = F.explode(F.array_distinct(F.transform(F.split("unit", WS), lambda w: F.lower(F.btrim(w, F.lit(_EDGE))))))
    counted = bit_filter(docs.select(unit.alias("unit")).select(word.alias("w")).select(F.xxhash64("w").alias("t")), wanted, ["t"])
    return counted.groupBy("t").agg(F.count(F.lit(1)).alias("n_t"))


@dataclass
class Told:
    """Classes of entities (``e, c``) and of terms (``t, k``), and the pairs of classes that tell: ``c, k, share``."""

    entities: DataFrame
    terms: DataFrame
    pairs: DataFrame


def _class(*more: str) -> Column:
    """A key of the set of units that a group's rows name, and of further numbers."""
    return F.xxhash64(*more, F.bit_xor(F.xxhash64("unit")), F.bit_xor(F.xxhash64(F.lit(1), "unit")), F.count(F.lit(1)))


def _shares(ws: Workspace, found: DataFrame, docs: DataFrame, rule: Disclosure, by: str) -> Told:
    """What gives entities away by lines, or by texts.

    Entities that occur in the same units are alike in all counts, and so are
    terms; each kind is put into classes by its set of units, and classes are
    paired where they share a unit. A line with many addresses and many words
    of its own is one pair, not their product.

    With an entity of ``n_e`` units, ``d_e`` of them different, no term reaches
    the least share unless ``d_e / (d_e + z ** 2)`` times ``n_e / n_t`` does:
    an entity for which even ``n_t = n_e`` fails, and terms in more units than
    that, are left out before anything is paired.
    """
    held = found.select(F.explode(by).alias("b")).select("b.*")
    total = float(found.agg(F.coalesce(F.sum("lines") if by == "by_line" else F.count(F.lit(1)), F.lit(0))).first()[0])
    copies = ws.table(held.groupBy("unit").agg(F.count(F.lit(1)).alias("w")), f"copies-{by}")
    in_units = held.select("unit", F.explode("entities").alias("e")).distinct().join(copies, "unit")
    seen = F.col("d_e") / (F.col("d_e") + rule.deviations**2)
    needed = F.pow(F.greatest(F.lit(2.0), F.lit(total) / F.col("n_e")), F.lit(rule.generalise - 1))
    ents = in_units.groupBy("e").agg(F.sum("w").alias("n_e"), F.count(F.lit(1)).alias("d_e"), _class().alias("c"))
    ents = ws.table(ents.where(seen >= needed * 0.999999).withColumn("most", F.col("n_e") * seen / needed * 1.000001), f"entities-{by}")
    bound = ents.agg(F.max("most")).first()[0] or 0.0
    all_terms = held.select("unit", F.explode("terms").alias("t"))
    rare = ws.table(_unit_counts(docs, all_terms, by).where(F.col("n_t") <= bound), f"rare-{by}")
    rows = ws.table(bit_filter(all_terms, rare, ["t"]).join(rare, "t").distinct().join(copies, "unit"), f"rows-{by}")
    named = rows.groupBy("t", "n_t").agg(F.sum("w").alias("n_in"), _class("n_t").alias("k"))
    named = ws.table(named.select("t", "k", F.greatest("n_t", "n_in").alias("n_t")), f"terms-{by}")
    # one member stands for a class, so that a class has a row for each unit
    c = ents.groupBy("c").agg(F.min("e").alias("e"), F.first("n_e").alias("n_e"), F.first("most").alias("most")).join(in_units.select("e", "unit"), "e").drop("e")
    k = named.groupBy("k").agg(F.min("t").alias("t"), F.first("n_t").alias("n_t")).join(rows.select("t", "unit", "w"), "t").drop("t")
    met = c.join(k, "unit").where("n_t <= most")
    joint = met.groupBy("c", "k").agg(F.first("n_e").alias("n_e"), F.first("n_t").alias("n_t"), F.sum("w").alias("n_te"), F.count(F.lit(1)).alias("different"))
    pairs = joint.select("c", "k", share(F.col("n_te"), F.col("different"), F.col("n_t"), F.col("n_e"), total, rule).alias("share")).where(F.col("share") >= rule.generalise)
    return Told(ents.select("e", "c"), named.select("t", "k"), ws.table(pairs, f"pairs-{by}"))


def share(n_te: Column, different: Column, n_t: Column, n_e: Column, total: float, rule: Disclosure) -> Column:
    """The share of an entity's information that a term gives; see ``Disclosure``."""
    p, z = n_te / n_t, rule.deviations
    m = different / p
    low = (p + z * z / (2 * m) - z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
    return 1 + F.log(F.greatest(low, F.lit(1e-300))) / F.log(F.greatest(F.lit(2.0), F.lit(total) / n_e))


def disclosing(ws: Workspace, found: DataFrame, docs: DataFrame, rule: Disclosure) -> DataFrame:
    """``unit, told``: for each text with an entity, the hashes of the terms that give one of its entities away, with their shares."""
    held = found.select(F.explode("by_text").alias("b")).select("b.*")
    parts = []
    for by in ("by_line", "by_text"):
        told = _shares(ws, found, docs, rule, by)
        has = held.select("unit", F.explode("entities").alias("e")).join(told.entities, "e").select("unit", "c").distinct()
        best = has.join(told.pairs, "c").groupBy("unit", "k").agg(F.max("share").alias("share"))
        named = bit_filter(held.select("unit", F.explode("terms").alias("t")), told.terms, ["t"]).join(told.terms, "t").distinct()
        parts.append(named.join(best, ["unit", "k"]).select("unit", "t", "share"))
    each = parts[0].unionByName(parts[1]).groupBy("unit", "t").agg(F.max("share").alias("share"))
    return ws.table(each.groupBy("unit").agg(F.collect_list(F.struct(F.col("t").alias("key"), F.col("share").alias("value"))).alias("told")), "told")


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure(), with_text: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, counts per kind, ``base_sha256, spans, n_term`` and the clean ``sanitised`` text.

    Patterns give the protected entities. The corpus tells, by how often a term
    shares a line or text with an entity, how strongly it reveals it; such a term is a
    ``term`` span wherever it occurs in a document that holds the entity, and
    is generalised or removed there like the entity itself. Each occurrence
    of a pattern match becomes its kind in brackets.

    Null text counts as empty: no span, and the digest of the empty list.
    Repeated rows are handled one by one; other columns are ignored. Terms,
    entities and texts are known by 64-bit hashes.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    ws = Workspace(spark, "pii")
    found = ws.table(_scan(docs), "found")
    told = disclosing(ws, found, docs, rule)
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("unit"))
    size = told.agg(F.coalesce(F.sum(F.lit(48) + 24 * F.size("told")), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(told), "unit", "left")
    else:
        # only texts that may hold an entity move
        near, far = bit_split(rows, told, ["unit"])
        rows = near.join(told, "unit", "left").unionByName(far.withColumn("told", F.lit(None).cast(told.schema["told"].dataType)))
    return _finish(rows.select("doc_id", "text", "told"), rule, with_text)


def _finish(rows: DataFrame, rule: Disclosure, with_text: bool) -> DataFrame:
    names = ["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base_sha256", "spans", "n_term"] + ["sanitised"] * with_text
    text_type = {"base_sha256", "spans", "sanitised"}
    out = pa.schema([(n, pa.string() if n in text_type else pa.int64()) for n in names])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for doc_id, text, told in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                base = base_spans(text)
                by_key = {t["key"]: t["value"] for t in told or ()}
                shares = {}
                if by_key:
                    shares = {(a, b): by_key[k] for a, b, t in outside(text, base) if (k := term_key(t)) in by_key}
                spans = sorted(base + [(a, 4, b) for a, b in shares])
                values = [doc_id, *(sum(k == kind for _, k, _ in base) for kind in range(4)), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(shares)]
                if with_text:
                    values.append(replaced(text, spans, shares, rule))
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, out.types, strict=True)], schema=out)

    return rows.mapInArrow(finish, ", ".join(f"{f.name} {'string' if f.name in text_type else 'long'}" for f in out))


def replaced(text: str, spans: list[tuple[int, int, int]], shares: dict[tuple[int, int], float], rule: Disclosure) -> str:
    """The text with entities as their kinds, and terms generalised or removed. Overlapping spans go as one, named by the first."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out.append(text[at:a])
            if k < 4 or shares[a, b] < rule.remove:
                out.append(f"[{KINDS[k]}]")
        at = max(at, b)
    return "".join([*out, text[at:]])
