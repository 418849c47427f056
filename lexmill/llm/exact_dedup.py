"""Exact duplicates by a log-structured merge index of digests. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import WS, Workspace, bit_filter, skew_lookup, without_ids


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WS, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


#: Runs of the middle level, and slots of the filter over each.
RUNS, SLOTS = 16, 1 << 24


def dedup(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, digest``.

    The index is a log-structured merge tree of three levels:

    * memtables and flush: each task digests its rows and writes them as one
      run sorted by digest; no text is moved;
    * first compaction: runs are merged by digest into ``RUNS`` larger ones, an
      entry with the smallest identifier and the number of rows for each digest
      (combined before the shuffle, so a group of any size costs a row per
      task), and each is written sorted with a filter of one bit per slot;
    * second compaction: the filters are probed against each other. A digest
      whose slot no other run has set passes as it is; only the rest, copies
      across runs and a few chance hits, is merged once more;
    * hits, digests that occur twice or more, receive byte verification: a bit
      filter of fixed size passes their rows in a second scan, and the smallest
      and largest text of each digest must be the same bytes. A digest that
      fails is split by the texts themselves, so a weak digest costs time but
      never a wrong answer.

    Null text counts as empty. Of equal rows with the smallest ``doc_id``
    repeated, exactly one is kept; a null ``doc_id`` sorts last and such a
    group keeps one of its rows. An empty table gives an empty result, other
    columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "exact-dedup")
    rows = docs.select(F.col("doc_id"), normalised(F.col("text")).alias("norm"))
    made = rows.select("doc_id", digest(F.col("norm")).alias("digest"), F.monotonically_increasing_id().alias("rid"))
    runs = ws.table(made.sortWithinPartitions("digest"), "level0")
    level = _compacted(ws, runs)
    total = runs.count()
    differing = _verify(ws, rows, level.where("n > 1").select("digest"), digest)
    found = skew_lookup(runs, level, ["digest"], "n", total)
    if differing.limit(1).count() == 0:
        return found.select("doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("rid") == F.col("keep_rid")).alias("kept"), "digest")
    return _by_text(found, rows, differing, digest)


def _merged(entries: DataFrame, keys: list[str]) -> DataFrame:
    return entries.groupBy(*keys).agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def _compacted(ws: Workspace, runs: DataFrame) -> DataFrame:
    """``digest, keep_id, keep_rid, n`` of all runs."""
    first = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("rid"))
    # the task that flushed a row is in the upper bits of its number
    entries = runs.select(F.pmod(F.shiftright("rid", 33), F.lit(RUNS)).cast("int").alias("run"), "digest", first.alias("first"), F.lit(1).cast("long").alias("n"))
    middle = ws.table(_merged(entries, ["run", "digest"]).sortWithinPartitions("run", "digest"), "level1")
    hit, miss = probed(ws, middle)
    last = ws.table(_merged(hit, ["digest"]).select("digest", "first", "n").unionByName(miss.select("digest", "first", "n")), "level2")
    return last.select("digest", F.col("first.id").alias("keep_id"), F.col("first.rid").alias("keep_rid"), "n")


def probed(ws: Workspace, middle: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries whose digest another run's filter may hold, and those that none does.

    A run's filter is written as words of 64 slots. Of all filters, the probe
    needs just the slots that two runs or more have set: 4 MB at most.
    """
    slot = F.pmod(F.xxhash64("digest"), F.lit(SLOTS))
    word = middle.select("run", slot.alias("s")).groupBy("run", F.shiftright("s", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("bits"))
    filters = ws.table(word, "filters")
    none = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("twice"))
    add = lambda acc, w: F.struct(acc["seen"].bitwiseOR(w).alias("seen"), acc["twice"].bitwiseOR(acc["seen"].bitwiseAND(w)).alias("twice"))
    shared = filters.groupBy("word").agg(F.collect_list("bits").alias("w")).select("word", F.aggregate("w", none, add)["twice"].alias("twice")).where("twice <> 0")
    marked = middle.withColumn("s", slot).withColumn("word", F.shiftright("s", 6)).join(F.broadcast(shared), "word", "left")
    hit = F.coalesce(F.expr("(shiftright(twice, cast(s & 63 as int)) & 1) = 1"), F.lit(False))
    return marked.where(hit).select(*middle.columns), marked.where(~hit).select(*middle.columns)


def _verify(ws: Workspace, rows: DataFrame, hits: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests of ``hits`` under which there is more than one text, as a written table."""
    passed = bit_filter(rows.select(digest(F.col("norm")).alias("digest"), "norm"), hits, ["digest"])
    spread = passed.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high")).where("low <> high").select("digest")
    return ws.table(spread, "differing")


def _by_text(found: DataFrame, rows: DataFrame, differing: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Replace the groups of colliding digests by groups of equal texts."""
    sound = found.join(differing, "digest", "left_anti").select("doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("rid") == F.col("keep_rid")).alias("kept"), "digest")
    mixed = rows.select("doc_id", digest(F.col("norm")).alias("digest"), "norm", F.monotonically_increasing_id().alias("rid")).join(differing, "digest", "left_semi")
    first = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("rid"))
    groups = mixed.groupBy("digest", "norm").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size"))
    split = mixed.join(groups, ["digest", "norm"]).select("doc_id", F.col("first.id").alias("keep_id"), "group_size", (F.col("rid") == F.col("first.rid")).alias("kept"), "digest")
    return sound.unionByName(split)


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that repeat the text of a row with a smaller ``doc_id``; all its columns.

    Rows whose ``doc_id`` is null or repeated are told apart by their digest,
    and one row of each such pair stays.
    """
    ws = Workspace(docs.sparkSession, "exact-keep")
    decided = ws.table(dedup(docs).select("doc_id", "kept", "digest"), "decided")
    per_id = ws.table(decided.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("n_kept")), "per_id")
    left = without_ids(docs, ws.table(per_id.where("n_kept = 0").select("doc_id"), "gone"), "doc_id")
    mixed = per_id.where("n > n_kept and (n_kept > 0 or doc_id is null)").select(F.col("doc_id").alias("__mixed"))
    many = mixed.count()
    if many == 0:
        return left
    mixed = F.broadcast(mixed) if many <= 1_000_000 else mixed
    same = left["doc_id"].eqNullSafe(mixed["__mixed"])
    kept = decided.where("kept").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__kept"))
    one_each = left.join(mixed, same, "left_semi").groupBy("doc_id", sha256(normalised(F.col("text"))).alias("__digest")).agg(F.first(F.struct(*docs.columns)).alias("__row"))
    chosen = one_each.join(kept, one_each["doc_id"].eqNullSafe(kept["__id"]) & (one_each["__digest"] == kept["__kept"]), "left_semi")
    return left.join(mixed, same, "left_anti").unionByName(chosen.select("__row.*"))
