"""Key-ordered reads and index tables over written items."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators.filters import among

_STREAM_ID = re.compile(r"^(-?[0-9]+)-([0-9a-fA-F]+)$")


def _key(text: str) -> tuple[str, int | None]:
    """A document id (or the start of one) and, if given, a time."""
    text = text.strip()
    if m := _STREAM_ID.match(text):
        return m[2].lower(), int(m[1])
    if re.fullmatch("[0-9a-fA-F]{40}", text):
        ticks = int(text[32:], 16)
        return text[:32].lower(), ticks - (1 << 32) if ticks >> 31 else ticks
    if re.fullmatch("[0-9a-fA-F]*", text):
        return text.lower(), None
    raise KeyError(f"malformed key: {text!r}")


def key_predicate(text: str) -> Column:
    """A predicate for a list of keys, ``a<b`` ranges (b excluded) among them, parted by ``,`` or ``;``; empty text means all.

    Ranges and points compare plain columns, so they reach the scan and prune
    row groups of sorted files.
    """
    parts = [p for p in re.split("[,;]", text) if p.strip()]
    if not parts:
        return F.lit(True)
    doc, ticks = F.col("doc_id"), F.floor("epoch_ticks")
    test: Column | None = None
    for p in parts:
        if "<" in p:
            (d1, t1), (d2, t2) = map(_key, p.split("<", 1))
            low = (doc >= d1) if t1 is None else (doc > d1) | ((doc == d1) & (ticks >= t1))
            high = (doc < d2) if t2 is None else (doc < d2) | ((doc == d2) & (ticks < t2))
            one = low & high if d2 else low
        else:
            d, t = _key(p)
            one = doc.startswith(d) if t is None else (doc == d) & (ticks == t)
        test = one if test is None else test | one
    return test


def get_item(items: DataFrame, stream_id: str) -> DataFrame:
    """The item of a stream id; a malformed or missing one raises ``KeyError``."""
    m = _STREAM_ID.match(stream_id)
    if not m:
        raise KeyError(stream_id)
    found = items.where(key_predicate(stream_id))
    if found.limit(1).count() == 0:
        raise KeyError(stream_id)
    return found


def get_by_doc_id(items: DataFrame, doc_id: str) -> DataFrame:
    return items.where(F.col("doc_id") == doc_id)


def delete(items: DataFrame, stream_ids: DataFrame | list[str]) -> DataFrame:
    """The table without the ids (a list, or a table ``stream_id``); write it anew to make it so."""
    if isinstance(stream_ids, list):
        return among(items, "stream_id", stream_ids, False)
    return items.join(stream_ids.select("stream_id"), "stream_id", "left_anti")


def index_tables(items: DataFrame) -> dict[str, DataFrame]:
    """``si`` (by key), ``sisi`` (source by key) and ``siti`` (by time)."""
    key = T.store_key(F.col("doc_id"), F.floor("epoch_ticks"))
    rows = items.withColumn("key", key)
    return {
        "si": rows,
        "sisi": rows.where("source is not null and source <> ''").select("key", "source"),
        "siti": rows.select(F.floor("epoch_ticks").cast("long").alias("epoch_ticks"), "doc_id"),
    }
