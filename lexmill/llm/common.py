"""What the training-data operators share: written tables, whitespace words, skew-safe lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.sinks.workspace import Workspace, shared_dir  # noqa: F401

#: Java and RE2 form of one run of ASCII white space.
WS = r"[\x20\x09-\x0D]+"
#: Bytes of a table that is broadcast at most.
BROADCAST_BYTES = 16_000_000
WS_CHARS = " \t\n\x0b\x0c\r"

def small_arrow_batches(spark: SparkSession, rows: int = 512) -> None:
    """Keep Arrow batches of whole texts small: a few very long texts must fit a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts give an empty array."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS_CHARS))
    return F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, WS))


def skew_lookup(rows: DataFrame, index: DataFrame, keys: list[str], weight: str, total: int, parts: int = 1000) -> DataFrame:
    """Left join of ``rows`` to an index that has one row per key, safe for hot keys.

    ``weight`` counts the rows of a key in ``rows`` and ``total`` all rows.
    Keys with more than ``total / parts`` rows are fewer than ``parts``, so
    their index rows have a proven bound and are broadcast. No other key can
    fill more than a thousandth of the shuffled join.
    """
    hot_from = max(1, total // parts)
    hot = index.where(F.col(weight) > hot_from)
    extra = [c for c in index.columns if c not in keys]
    mark = hot.select(*keys, F.struct(*extra).alias("__hot"))
    marked = rows.join(F.broadcast(mark), keys, "left")
    near = marked.where(F.col("__hot").isNotNull()).select(*rows.columns, *[F.col(f"__hot.{c}").alias(c) for c in extra])
    far = marked.where(F.col("__hot").isNull()).drop("__hot").join(index.where(F.col(weight) <= hot_from), keys, "left")
    return near.unionByName(far.select(*rows.columns, *extra))


def without_ids(docs: DataFrame, dropped: DataFrame, key: str, broadcast_rows: int = 1_000_000) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in ``dropped`` (a written table of that one column).

    The list is broadcast while it has at most ``broadcast_rows`` rows (16 MB);
    a longer list is joined by shuffle. Rows with a null key stay.
    """
    gone = dropped.select(F.col(key).alias("__gone"))
    gone = F.broadcast(gone) if gone.count() <= broadcast_rows else gone
    return docs.join(gone, docs[key] == gone["__gone"], "left_anti")


def without_rows(docs: DataFrame, gone: DataFrame, broadcast_rows: int = 500_000) -> DataFrame:
    """Rows of ``docs`` that a written table ``__id, __hash`` of ids and text hashes does not list; null ids are compared as values.

    Its rows have two longs, so up to ``broadcast_rows`` of them (16 MB) are
    broadcast; a longer list is joined by shuffle.
    """
    gone = F.broadcast(gone) if gone.count() <= broadcast_rows else gone
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__hash"]), "left_anti")


def running_sum(ws: Workspace, rows: DataFrame, group: list[str], order: list[str], value: str, name: str, per_part: int = 100_000) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over the rows of the group that come earlier in ``order``.

    Rows are sorted once over all partitions by group and order, so a hot group
    spreads over many partitions. Only one sum per partition and group passes
    through the window over partitions.
    """
    parts = max(1, min(10_000, rows.count() // per_part + 1))
    keys = [F.col(c) for c in [*group, *order]]
    placed = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    placed = ws.table(placed, name).withColumn("__part", F.shiftright("__at", 33))
    sums = placed.groupBy("__part", *group).agg(F.sum(value).alias("__sum"))
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__base", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    sums = sums.select(F.col("__part").alias("__p"), *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)], "__base")
    same = placed["__part"] == sums["__p"]
    for i, c in enumerate(group):
        same = same & placed[c].eqNullSafe(sums[f"__g{i}"])
    inside = Window.partitionBy("__part", *group).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.join(sums, same).withColumn("__own", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return within.withColumn("before", (F.col("__base") + F.col("__own")).cast("long")).select(*rows.columns, "before")


def bit_filter(rows: DataFrame, wanted: DataFrame, keys: list[str], bits: int = 1 << 24) -> DataFrame:
    """``rows`` whose ``keys`` may be in ``wanted``; no wanted row is lost.

    The filter has one bit per hash of the keys and is broadcast as words of 64
    bits: 16 bytes a word, 4 MB at most, whatever the number of keys. It keeps
    rows that cannot match out of a shuffle.
    """
    marked, hit = _marked(rows, wanted, keys, bits, "inner")
    return marked.where(hit).select(*rows.columns)


def bit_split(rows: DataFrame, wanted: DataFrame, keys: list[str], bits: int = 1 << 24) -> tuple[DataFrame, DataFrame]:
    """``rows`` that ``bit_filter`` passes, and the others."""
    marked, hit = _marked(rows, wanted, keys, bits, "left")
    hit = F.coalesce(hit, F.lit(False))
    return marked.where(hit).select(*rows.columns), marked.where(~hit).select(*rows.columns)


def _marked(rows: DataFrame, wanted: DataFrame, keys: list[str], bits: int, how: str) -> tuple[DataFrame, Column]:
    slot = F.pmod(F.xxhash64(*keys), F.lit(bits))
    words_ = wanted.select(slot.alias("__slot")).groupBy(F.shiftright("__slot", 6).alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(__slot & 63 as int))")).alias("__bits"))
    marked = rows.withColumn("__slot", slot).withColumn("__word", F.shiftright("__slot", 6))
    return marked.join(F.broadcast(words_), "__word", how), F.expr("(shiftright(__bits, cast(__slot & 63 as int)) & 1) = 1")
