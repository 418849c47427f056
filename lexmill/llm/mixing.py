"""Mixing sources to target weights by Efraimidis-Spirakis keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Workspace, running_sum, words

#: Hexadecimal digits of the digest that make the uniform number of a key.
DIGITS = 13


def _uniform(doc_id: Column, seed: str) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)


def targets(ws: Workspace, sources: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """``source, source_size, target`` of the table ``source, source_size``.

    Sources in code point order, null last, take the weights in turn and share
    the total size by them. A source's target stops at ``repeats`` times its
    size; the excess goes to the others by weight until none is above. That is
    one level for all: target = least(level * weight, repeats * size).
    """
    ranked = running_sum(ws, sources.withColumn("one", F.lit(1)).withColumn("last", F.col("source").isNull()), [], ["last", "source"], "one", "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("before") % len(weights) + 1).cast("int"))
    shares = ws.table(ranked.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * repeats).alias("limit")), "shares")
    level, stopped = 0.0, None
    while True:
        over = F.col("limit") < F.lit(level) * F.col("weight") if stopped is not None else F.lit(False)
        found = shares.agg(F.sum("source_size"), F.sum(F.when(over, F.col("limit")).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))), F.count_if(over)).first()
        total, full, open_weight, now = (x or 0 for x in found)
        if now == stopped or not open_weight:
            break
        level, stopped = (total - full) / open_weight, now
    return shares.select("source", "source_size", F.least(F.lit(level) * F.col("weight"), F.col("limit").cast("double")).alias("target"))


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[int, ...] = (1, 2, 3), repeats: int = 3, seed: str = "mix") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, source, text_hash``.

    ``size`` counts words. Each source is read ``target // source_size`` times
    in full; what is left of its target is selected: documents are sorted by
    Efraimidis-Spirakis keys (an exponential number divided by the document's
    weight) and taken while the sum of words stays within the rest. The
    document at the edge gives just the words that are missing, so a source's
    words equal its rounded target.

    ``quality`` has ``doc_id`` and ``weight`` (above 0); documents without one
    weigh 0.5, and of repeated rows the largest weight counts. Null text has
    size 0 and is never taken; a null source is a source of its own. Keys
    depend on ``doc_id`` and seed alone: reruns agree, and rows that repeat a
    ``doc_id`` are ordered by text. An empty table gives an empty result.
    """
    ws = Workspace(docs.sparkSession, "mixing")
    sized = docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), F.xxhash64("text").alias("text_hash"))
    sized = ws.table(sized, "sized")
    sources = ws.table(targets(ws, sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats), "targets")
    keyed = sized
    if quality is None:
        keyed = keyed.withColumn("weight", F.lit(0.5))
    else:
        best = quality.groupBy("doc_id").agg(F.max("weight").alias("weight"))
        keyed = keyed.join(best, "doc_id", "left").withColumn("weight", F.coalesce("weight", F.lit(0.5)))
    keyed = keyed.withColumn("key", -F.log(_uniform(F.col("doc_id"), seed)) / F.col("weight")).drop("weight")
    placed = running_sum(ws, keyed, ["source"], ["key", "doc_id", "size", "text_hash"], "size", "placed")
    named = sources.select(F.col("source").alias("__source"), "source_size", "target")
    placed = placed.join(named, placed["source"].eqNullSafe(named["__source"]))
    whole = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.greatest("source_size", F.lit(1)))).otherwise(0)
    rest = whole - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", "text_hash")


def label_weights(labels: DataFrame) -> DataFrame:
    """``doc_id, weight`` from quality labels: 1 for good, 0.25 for bad documents."""
    return labels.where("quality is not null").select("doc_id", F.when(F.col("quality") == 1, 1.0).otherwise(0.25).alias("weight"))


def mixed(docs: DataFrame, quality: DataFrame | None = None, **options: object) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each once per epoch, the last one cut after the words that are missing.

    All columns stay; ``n_chars``, if there, follows a cut text. Rows that are
    equal in ``doc_id`` and text are taken as one row with the sum of their words.
    """
    ws = Workspace(docs.sparkSession, "mixed")
    chosen = mix(docs, quality, **options).where("taken > 0").groupBy("doc_id", "text_hash").agg(F.sum("taken").alias("__taken"), F.max("size").alias("__size"), F.count(F.lit(1)).alias("__rows"))
    chosen = ws.table(chosen.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "__taken", "__size", "__rows"), "chosen")
    hashed = docs.withColumn("__h", F.xxhash64("text"))
    if chosen.where("__rows > 1").limit(1).count():
        hashed = hashed.groupBy("doc_id", "__h").agg(F.first(F.struct(*hashed.columns)).alias("__row")).select("__row.*")
    index = F.broadcast(chosen) if chosen.count() <= 500_000 else chosen
    joined = hashed.join(index, hashed["doc_id"].eqNullSafe(index["__id"]) & (hashed["__h"] == index["__hash"]))
    joined = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("__taken") / F.col("__size")))))
    cut = F.col("__copy") * F.col("__size") > F.col("__taken")
    # words with the white space before them, so that a cut text keeps its lines
    spaced = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    text = F.when(cut, F.array_join(F.slice(spaced, F.lit(1), (F.col("__taken") % F.col("__size")).cast("int")), "")).otherwise(F.col("text"))
    joined = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return joined.select(*docs.columns)
