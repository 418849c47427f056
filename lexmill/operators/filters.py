"""Row filters. Short lists are literals in the predicate, so that they reach the scan; long lists are semi-joins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as T

#: Longest list that becomes a literal of the predicate.
LITERALS = 1000
#: Bytes of a list that is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 16_000_000


def listed(items: DataFrame, column: str, values: list[str]) -> DataFrame:
    """The values as a table of one column, to be broadcast if its strings are known to be few bytes."""
    table = items.sparkSession.createDataFrame([(v,) for v in dict.fromkeys(values)], f"`{column}` string")
    return F.broadcast(table) if sum(len(v.encode()) + 32 for v in values if v is not None) <= BROADCAST_BYTES else table


def among(items: DataFrame, column: str, values: list[str], keep: bool) -> DataFrame:
    """Rows whose ``column`` is one of the values, or is none of them; a null is none."""
    if len(values) <= LITERALS:
        test = F.col(column).isin(values)
        return items.where(test if keep else ~F.coalesce(test, F.lit(False)))
    return items.join(listed(items, column, values), column, "left_semi" if keep else "left_anti")


def accept_ids(items: DataFrame, accept: Iterable[str] = ()) -> DataFrame:
    """Items with one of the stream ids; without ids, none."""
    return among(items, "stream_id", list(accept), True)


def filter_ids(items: DataFrame, excluded: Iterable[str] = (), included: Iterable[str] = (), excluded_docs: Iterable[str] = (), included_docs: Iterable[str] = ()) -> DataFrame:
    """Drop excluded stream and document ids; then, if any inclusion list has ids, keep those alone."""
    for column, values in (("stream_id", list(excluded)), ("doc_id", list(excluded_docs))):
        if values:
            items = among(items, column, values, False)
    streams, docs = list(included), list(included_docs)
    if not streams and not docs:
        return items
    if len(streams) + len(docs) <= LITERALS:
        return items.where(F.col("stream_id").isin(streams) | F.col("doc_id").isin(docs))
    by_stream = among(items, "stream_id", streams, True)
    return by_stream.unionByName(among(among(items, "stream_id", streams, False), "doc_id", docs, True))


def filter_languages(items: DataFrame, codes: Iterable[str], allow_null: bool = False) -> DataFrame:
    return items.where(F.when(F.col("lang_code").isNull(), F.lit(allow_null)).otherwise(F.col("lang_code").isin(list(codes))))


def filter_taggers(items: DataFrame, tokens: DataFrame, tagger_ids: Iterable[str]) -> DataFrame:
    """Items for which some listed tagger has a sentence."""
    return items.join(tokens.where(F.col("tagger_id").isin(list(tagger_ids))).select("stream_id").distinct(), "stream_id", "left_semi")


def filter_domains(items: DataFrame, domains: Iterable[str]) -> DataFrame:
    """Items whose URL host, or else ``schost``, is one of the domains or below one."""
    names = [d.lower().strip("/") for d in domains]
    if len(names) <= LITERALS:
        literal = F.array(*[F.lit(n) for n in names]).cast("array<string>")
        hit = lambda c: F.coalesce(F.arrays_overlap(T.left_cuts(T.host(F.col(c))), literal), F.lit(False))
        return items.where(hit("abs_url") | hit("schost"))
    found = items.select("*", F.array_union(T.left_cuts(T.host(F.coalesce("abs_url", F.lit("")))), T.left_cuts(T.host(F.coalesce("schost", F.lit(""))))).alias("__cuts"))
    hits = found.select("stream_id", F.explode("__cuts").alias("__domain")).join(listed(items, "__domain", names), "__domain", "left_semi").select("stream_id").distinct()
    return items.join(hits, "stream_id", "left_semi")


def filter_domain_substrings(items: DataFrame, substrings: Iterable[str]) -> DataFrame:
    """Items with any of the strings in the URL as it stands, or else in ``schost``."""
    test: Column = F.lit(False)
    for s in substrings:
        test = test | F.coalesce(F.col("abs_url").contains(s), F.lit(False)) | F.coalesce(F.col("schost").contains(s), F.lit(False))
    return items.where(test)


def filter_exact_match(items: DataFrame, phrases: Iterable[str]) -> DataFrame:
    """Items whose cleansed visible text holds any cleansed phrase."""
    clean = T.cleanse(F.col("clean_visible"))
    test: Column = F.lit(False)
    for p in phrases:
        test = test | clean.contains(T.cleanse(F.lit(p)))
    return items.where(test)


def find_ids(items: DataFrame, doc_ids: Iterable[str], camouflage: float = 0.0, seed: int = 0) -> DataFrame:
    """Items with the document ids and, from inputs that have one, a random share of the others.

    Chance comes from a hash of the stream id, so reruns agree.
    """
    wanted = list(doc_ids)
    hits = among(items, "doc_id", wanted, True)
    if camouflage <= 0:
        return hits
    inputs = hits.select("i_str").distinct()
    chance = F.pmod(F.xxhash64(F.lit(seed), "stream_id"), F.lit(1_000_000)) < int(camouflage * 1_000_000)
    return hits.unionByName(among(items, "doc_id", wanted, False).where(chance).join(inputs, "i_str", "left_semi"))


def keep_annotated(items: DataFrame, ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items that have a rating, and the ratings of kept items."""
    kept = items.join(ratings.select("stream_id").distinct(), "stream_id", "left_semi")
    return kept, ratings.join(kept.select("stream_id"), "stream_id", "left_semi")


def validate(items: DataFrame) -> DataFrame:
    """Raise where a row lacks its stream id or time, at the cost of no pass of its own."""
    bad = F.col("stream_id").isNull() | F.col("stream_time").isNull()
    return items.withColumn("stream_id", F.when(bad, F.raise_error(F.lit("an item lacks stream_id or stream_time"))).otherwise(F.col("stream_id")))
