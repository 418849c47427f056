"""The keyword index: postings, document frequencies and dictionary, and the queries over them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions.hashes import term_hash_udf, term_hashes
from lexmill.operators.filters import LITERALS, among

STOP_WORDS = tuple("a an and are as at be but by for from has have he her his i in is it its not of on or she that the their they this to was we were will with you".split())


def _wanted_terms(rows: DataFrame, size_limit: int, stop_words: Iterable[str], drop_empty: bool) -> DataFrame:
    """The rows whose ``term`` is no longer than ``size_limit`` bytes and no stop word; a long list of those is an anti-join."""
    rows = rows.where(F.octet_length("term") <= size_limit)
    listed = list(stop_words)
    if drop_empty:
        rows = rows.where("term <> ''")
    return among(rows, "term", listed, False) if listed else rows


def terms(tokens: DataFrame, token: str = "token", key: str = "stream_id", size_limit: int = 128, stop_words: Iterable[str] = (), drop_empty: bool = False) -> DataFrame:
    """``key, term, tf``: cleansed tokens counted per document; long terms and stop words are left out."""
    rows = tokens.select(key, T.cleanse(F.col(token)).alias("term"))
    return _wanted_terms(rows, size_limit, stop_words, drop_empty).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def text_terms(items: DataFrame, text: str = "clean_visible", key: str = "stream_id", size_limit: int = 128, stop_words: Iterable[str] = (), drop_empty: bool = False, total: str | None = None) -> DataFrame:
    """As ``terms`` over the white-space tokens of a text column, which is cleansed as a whole.

    With ``total``, each document with a token has one more row of that term:
    its frequency counts the documents in the same pass.
    """
    found = T.cleansed_tokens(F.col(text))
    if total is not None:
        found = F.transform(F.array(found), lambda t: F.when(F.size(t) > 0, F.array_append(t, F.lit(total))).otherwise(t))[0]
    rows = items.select(key, F.explode(found).alias("term"))
    return _wanted_terms(rows, size_limit, stop_words, drop_empty).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def hashed_text_terms(items: DataFrame, text: str = "clean_visible", key: str = "stream_id", size_limit: int = 128) -> DataFrame:
    """``key, term, tf, hash``, as ``text_terms``: terms are counted and hashed within their row, so no token moves.

    Only where a key has several rows are its counts added up by a shuffle.
    """
    kind = dict(items.dtypes)[key]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bounded parts, for a few very long texts
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                coded = part[1].flatten().dictionary_encode()
                known, width = coded.dictionary, max(1, len(coded.dictionary))
                owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(part[1]).to_numpy())
                pairs, tf = np.unique(owner * width + coded.indices.to_numpy(), return_counts=True)
                few = (pc.binary_length(known).to_numpy(zero_copy_only=False) <= size_limit)[pairs % width] if len(pairs) else slice(0)
                row, term = pa.array(pairs[few] // width), pa.array(pairs[few] % width)
                yield pa.RecordBatch.from_arrays([part[0].take(row), known.take(term), pa.array(tf[few]), pa.array(term_hashes(known)).take(term)], names=[key, "term", "tf", "hash"])

    made = items.select(key, T.cleansed_tokens(F.col(text)).alias("terms")).mapInArrow(count, f"`{key}` {kind}, term string, tf long, hash int")
    if items.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        made = made.groupBy(key, "term", "hash").agg(F.sum("tf").alias("tf")).select(*made.columns)
    return made


@dataclass(frozen=True)
class KeywordIndex:
    """``postings`` (hash, key, tf), ``frequencies`` (hash, n; hash 0 counts documents), ``dictionary`` (hash, term, n); ``counted`` (key, term, tf) while it is not written."""

    postings: DataFrame
    frequencies: DataFrame
    dictionary: DataFrame
    counted: DataFrame | None = None


def build(counted: DataFrame, key: str = "stream_id", parts: int | None = None) -> KeywordIndex:
    """The index of counted terms. Hashes are made once per distinct term, unless ``hash`` comes with the counts; terms of equal hash are added up.

    With ``hash``, ``parts`` may give the number of ranges of the postings.
    """
    if "hash" in counted.columns:
        dictionary = counted.groupBy("hash", "term").agg(F.count(F.lit(1)).alias("n"))
        # the range serves the sum and the order of the written table: one shuffle for both
        postings = (counted.repartitionByRange(parts, "hash") if parts else counted.repartitionByRange("hash")).groupBy("hash", key).agg(F.sum("tf").alias("tf"))
    else:
        distinct = counted.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        dictionary = distinct.select(term_hash_udf("term").alias("hash"), "term", "n")
        postings = _hashed(counted, dictionary, key)
    return KeywordIndex(postings, frequencies(postings, counted, key), dictionary, counted)


def frequencies(postings: DataFrame, counted: DataFrame, key: str = "stream_id") -> DataFrame:
    """Documents by hash, and all of them at hash 0."""
    total = counted.select(key).distinct().agg(F.lit(0).alias("hash"), F.count(F.lit(1)).alias("n"))
    return postings.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).unionByName(total)


def _hashed(counted: DataFrame, dictionary: DataFrame, key: str) -> DataFrame:
    return counted.join(dictionary.select("term", "hash"), "term").groupBy("hash", key).agg(F.sum("tf").alias("tf"))


def _postings(index: KeywordIndex, hashes: Iterable[int], key: str) -> DataFrame:
    """The postings of the hashes, 0 aside.

    A written index is filtered by its sort column. Before that, the hashes are
    first resolved to their terms, a few for each, and the terms are sought.
    """
    asked = [h for h in hashes if h]
    if index.counted is None:
        return index.postings.where(F.col("hash").isin(asked))
    found = index.dictionary.where(F.col("hash").isin(asked)).select("term", "hash")
    few = found.limit(LITERALS + 1).collect()
    if len(few) > LITERALS:
        return _hashed(index.counted, found, key)
    named = index.counted.where(F.col("term").isin([r["term"] for r in few]))
    hash_ = F.lit(None).cast("int")
    for r in few:
        hash_ = F.when(F.col("term") == r["term"], r["hash"]).otherwise(hash_)
    return named.groupBy(hash_.alias("hash"), key).agg(F.sum("tf").alias("tf"))


def lookup(index: KeywordIndex, hashes: Iterable[int], key: str = "stream_id") -> DataFrame:
    """Documents with any of the terms; hash 0 finds none."""
    return _postings(index, hashes, key).select(key).distinct()


def lookup_tf(index: KeywordIndex, h: int, key: str = "stream_id") -> DataFrame:
    return _postings(index, [h], key).select(key, "tf")


def document_frequencies(index: KeywordIndex, hashes: Iterable[int], key: str = "stream_id") -> DataFrame:
    """``hash, n`` for every hash asked for; 0 where it is missing."""
    listed = list(hashes)
    asked = index.dictionary.sparkSession.createDataFrame([(h,) for h in listed], "hash int")
    if index.counted is None:
        known = index.frequencies.where(F.col("hash").isin(listed))
    else:
        known = _postings(index, listed, key).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
        known = known.unionByName(index.frequencies.where("hash = 0")) if 0 in listed else known
    return asked.join(known, "hash", "left").select("hash", F.coalesce("n", F.lit(0)).alias("n"))


def invert(index: KeywordIndex, h: int) -> DataFrame:
    return index.dictionary.where(F.col("hash") == h).select("term")


def search(counted: DataFrame, words: Iterable[str], key: str = "stream_id") -> DataFrame:
    """Documents with any of the words, best first by tf-idf."""
    wanted = [w.lower() for w in words]
    n = counted.select(key).distinct().count()
    hits = counted.where(F.col("term").isin(wanted))
    # one row for each word asked for, so the broadcast is bounded by the question
    idf = hits.groupBy("term").agg(F.log(F.lit(float(max(n, 1))) / F.count(F.lit(1))).alias("idf"))
    ranked = hits.join(F.broadcast(idf.limit(len(wanted))), "term").groupBy(key).agg(F.sum(F.col("tf") * F.col("idf")).alias("rank"), F.count(F.lit(1)).alias("n_words"))
    return ranked.orderBy(F.desc("rank"), key)
