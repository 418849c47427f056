"""N-gram Jaccard self-join by vertical partitioning, and the groups it links. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Workspace, bit_filter, lower_ascii, skew_lookup, without_rows, words

#: Bits of the filter of frequent grams; one literal of 128 KB in the tasks, whatever the corpus.
FILTER_BITS = 20
#: One of so many distinct texts is counted to find the frequent grams. They decide the order of grams, never a result.
ORDER_SAMPLE = 16
#: Grams before a frequent one that its entry carries, to know pairs that met already.
BEFORE = 4
#: Nodes of a block's side, and grams of a segment on average.
BLOCK, SEGMENT = 64, 512
#: Entries of one frequent gram that meet in one cell.
CELL = 4096
#: Added to the count of rare grams that a pair shares for each frequent gram at which it meets.
HOT = 1 << 40
#: First grams of a set in the order of hashes: runs of three, unlike grams seldom shared by chance, find a node's center;
#: and nodes that must hold a run.
SKETCH, GROUP = 10, 32
#: Times that nodes not linked to their center look for another; those left over meet as nodes without a group.
TRIES = 2
#: Nodes of a group that are compared with as many at once, and grams of their differences at most, on average.
SIDE, DIFFERENCES = 512, 500_000
#: Grams of centers' sets that are broadcast at most, 8 MB.
CENTER_GRAMS = 1_000_000
#: Places of nodes in blocks that are broadcast at most: five numbers each, 16 MB.
PLACES = 250_000
#: Stands for a null ``doc_id`` where documents are looked up.
NULL_KEY = -(1 << 63)


@dataclass(frozen=True)
class Jaccard:
    """``num / den`` is the least Jaccard similarity of a link."""

    num: int = 70
    den: int = 100
    n: int = 3


def shingles(text: Column, n: int = 3) -> Column:
    """Sorted distinct 64-bit hashes of the n-word windows of the text, A-Z lower-cased.

    Fewer words count as one window of the whole sequence; no word gives an empty array.
    """
    word = words(lower_ascii(F.coalesce(text, F.lit(""))))

    def windows(w: Column) -> Column:
        return (
            F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
            .when(F.size(w) < n, F.array(F.xxhash64(F.lit("short"), F.concat_ws(" ", w))))
            .otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[w[i + k] for k in range(n)])))
        )

    return F.sort_array(F.array_distinct(F.transform(F.array(word), windows)[0]))


def _frequent(ws: Workspace, docs: DataFrame, rule: Jaccard) -> Callable[[Column], Column]:
    """A test whether a gram is among the frequent ones, which come last in the order of grams.

    Any total order gives the same links; with this one, passages that many
    documents share seldom generate candidates. Grams are counted exactly over
    every ``ORDER_SAMPLE``-th distinct text (by hash). Frequent are those from
    the least count on, 2 at least, with which they set at most an eighth of
    the filter's bits.
    """
    digest = F.xxhash64("text")
    chosen = docs.select("text").where(F.pmod(digest, F.lit(ORDER_SAMPLE)) == 0).groupBy(digest.alias("t")).agg(F.first("text").alias("text"))
    counts = chosen.select(F.explode(shingles(F.col("text"), rule.n)).alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = ws.table(counts, "frequent")
    # steps of a quarter of a power of two: a few hundred rows, whatever the counts
    step = F.floor(4 * F.log2("n")).cast("int")
    sizes = {r["s"]: r["k"] for r in counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k")).collect()}
    room, least = 1 << (FILTER_BITS - 3), None
    for s in sorted(sizes, reverse=True):
        room -= sizes[s]
        if room < 0:
            break
        least = s
    if least is None:
        return lambda g: F.lit(False)
    slot = F.col("g").bitwiseAND((1 << FILTER_BITS) - 1).cast("int")
    marked = counts.where(step >= least).select(slot.alias("b"))
    bits = marked.groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, b & 63)")).alias("bits")).collect()
    table = {r["w"]: r["bits"] for r in bits}
    literal = F.split(F.lit(",".join(str(table.get(i, 0)) for i in range(1 << (FILTER_BITS - 6)))), ",").cast("array<bigint>")
    at = lambda g: g.bitwiseAND((1 << FILTER_BITS) - 1).cast("int")
    return lambda g: F.call_function("shiftright", F.get(literal, F.shiftright(at(g), 6)), at(g).bitwiseAND(63)).bitwiseAND(1) == 1


def _least(n: Column, rule: Jaccard) -> Column:
    """The smallest overlap that a set of n needs with any partner."""
    return F.floor((n.cast("long") * rule.num + (rule.den - 1)) / F.lit(rule.den)).cast("long")


def _prefix(grams: Column, rule: Jaccard, frequent: Callable[[Column], Column]) -> Column:
    """The first ``n - least + 1`` grams of the order: ``rare`` ones by hash, then ``hot`` ones by hash."""
    length = (F.size(grams) - _least(F.size(grams), rule) + 1).cast("int")

    def both(rare: Column, hot: Column) -> Column:
        return F.struct(F.slice(rare, F.lit(1), length).alias("rare"), F.slice(hot, F.lit(1), F.greatest(length - F.size(rare), F.lit(0))).alias("hot"))

    def whole(rare: Column) -> Column:
        return both(rare, F.filter(grams, frequent))

    def start(rare: Column) -> Column:
        # The start of the hash order nearly always has rare grams enough. Filters are bound by a transform, so that they run once.
        none = F.array().cast("array<bigint>")
        rest = F.transform(F.array(F.filter(grams, lambda g: ~frequent(g))), whole)[0]
        return F.when(F.size(rare) >= length, both(rare, none)).otherwise(rest)

    head = F.slice(grams, F.lit(1), F.least(F.size(grams), length + F.floor(length / 2).cast("int") + 8))
    return F.transform(F.array(F.filter(head, lambda g: ~frequent(g))), start)[0]


@dataclass
class Links:
    """``members`` (doc_id, text_hash, n_shingles, node, first, n_docs), ``nodes`` (node, first, n_docs, h1, h2), ``links`` (a, b, overlap).

    ``groups`` (node, center) are nodes that are linked to a center. Links inside a group are in ``inner`` (node, degree),
    the documents of the linked nodes of the same group, and not in ``links``.
    """

    members: DataFrame
    nodes: DataFrame
    links: DataFrame
    groups: DataFrame
    inner: DataFrame
    total: int
    ws: Workspace


def similar(docs: DataFrame, rule: Jaccard = Jaccard()) -> Links:
    """All links between documents whose shingle sets have at least the given Jaccard similarity.

    Documents with equal sets form a node, so copies are never compared with
    each other. The global order of grams puts frequent ones last.

    1. Every text is shingled once; the first ``n - least + 1`` grams of its
       set are written. Linked nodes share one of them.
    2. A node that shares a run of its first grams with many others is compared
       with one of those, their center (see ``_runs``). Nodes linked to the same center form a
       group; a set is the center's but for few grams, so two sets of a group
       are compared by these differences, exactly, and no pair is written.
    3. Nodes of different groups meet in the grams of the prefixes, and a pair stays a candidate
       if the grams that it may share could reach the overlap it needs. At a
       frequent gram a pair is passed on only when it did not meet at one of
       the grams just before; a very frequent gram is spread over cells.
    4. The global order is cut into fragments by its leading bits, for long
       sets into more, so that a segment (a set's grams in a fragment) is
       bounded. Each fragment counts the partial overlap of the candidates by
       itself, and the partial overlaps are summed per pair: that sum decides.

    Null and blank texts have an empty set and no links. Repeated rows are
    members of one node. Other columns of ``docs`` are ignored.
    """
    ws = Workspace(docs.sparkSession, "ngram-join")
    frequent = _frequent(ws, docs, rule)
    sets = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), shingles(F.col("text"), rule.n).alias("grams"))
    made = sets.select("doc_id", "text_hash", F.xxhash64("grams").alias("h1"), F.xxhash64(F.lit(1), "grams").alias("h2"), F.size("grams").alias("n"), _runs(F.slice("grams", 1, SKETCH)).alias("sketch"), F.transform(F.array("grams"), lambda g: _prefix(g, rule, frequent))[0].alias("p"), F.monotonically_increasing_id().alias("rid"))
    rows = ws.table(made.select("doc_id", "text_hash", "h1", "h2", "n", "sketch", "p.rare", "p.hot", "rid"), "prefixes")
    first = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    nodes = rows.where("n > 0").groupBy("h1", "h2", "n").agg(F.min(first).alias("first"), F.min("rid").alias("node"), F.count(F.lit(1)).alias("n_docs"))
    nodes = ws.table(nodes, "nodes")
    total = rows.count()
    index = nodes.select("h1", "h2", "node", "first", "n_docs")
    members = skew_lookup(rows.select("doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"), "h1", "h2", "rid"), index, ["h1", "h2"], "n_docs", total).drop("h1", "h2")
    members = ws.table(members, "members")
    copies = ws.table(members.where("rid <> node").select("rid"), "copies")
    repeated = members.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("k")).where("k > 1").limit(1).count() > 0
    groups, inner = _groups(ws, rows, copies, docs, nodes, repeated, rule)
    candidates = _candidates(ws, rows, copies, groups, rule)
    ws.drop("prefixes")
    links = ws.table(_overlaps(ws, candidates, docs, nodes, repeated, rule), "links")
    return Links(members.drop("rid"), nodes, links, groups, inner, total, ws)


def _runs(grams: Column) -> Column:
    """Hashes of the runs of three neighbours of an array."""
    at = F.sequence(F.lit(0), F.size(grams) - 3)
    return F.when(F.size(grams) < 3, F.array().cast("array<bigint>")).otherwise(F.transform(at, lambda i: F.xxhash64(grams[i], grams[i + 1], grams[i + 2])))


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, repeated: bool, rule: Jaccard) -> DataFrame:
    """The rows of ``wanted`` (a written table, one row per ``node``) with ``grams``, the node's set; the texts are read once more."""
    whose = nodes.select("node", F.coalesce(F.col("first.id").cast("long"), F.lit(NULL_KEY)).alias("key"), F.col("first.hash").alias("text_hash"))
    wanted = wanted.join(whose, "node")
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("key"), F.xxhash64("text").alias("text_hash"), "text")
    near = bit_filter(keyed, wanted, ["key", "text_hash"])
    if repeated:
        near = near.groupBy("key", "text_hash").agg(F.first("text").alias("text"))
    near = near.join(wanted, ["key", "text_hash"])
    return near.withColumn("grams", shingles(F.col("text"), rule.n)).drop("key", "text_hash", "text")


def _groups(ws: Workspace, rows: DataFrame, copies: DataFrame, docs: DataFrame, nodes: DataFrame, repeated: bool, rule: Jaccard) -> tuple[DataFrame, DataFrame]:
    """``node, center`` of nodes that are linked to a center, and ``node, degree``: documents of the nodes of the same group linked to each.

    Which node is a center decides where a pair is compared, never a result.
    With ``c`` the overlap of a set and its center, and ``d`` the grams that
    only one of the two holds, two sets of a group share
    ``c_x + c_y - n_center + |d_x & d_y|`` grams.
    """
    own = rows.where("n > 0").join(copies, "rid", "left_anti")
    keys = ws.table(own.select(F.col("rid").alias("node"), F.explode("sketch").alias("run")), "keys0")
    total = rule.num + rule.den
    tries = []
    for k in range(1, TRIES + 1):
        often = keys.groupBy("run").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= GROUP)
        keys = ws.table(keys.join(often, "run").select("node", "run", "f"), f"keys{k}")
        if tries and keys.isEmpty():
            break
        # the node whose runs most others hold is likely the one that the others were made from
        weight = keys.groupBy("node").agg(F.sum("f").alias("q"))
        best = keys.join(weight, "node").groupBy("run").agg(F.max(F.struct("q", (-F.col("node")).alias("c"))).alias("best"))
        chosen = keys.join(best, "run").groupBy("node").agg((-F.max("best")["c"]).alias("center"))
        chosen = ws.table(chosen.join(nodes.select("node", "n_docs"), "node"), f"chosen{k}")
        wanted = ws.table(chosen.select(F.col("center").alias("node")).distinct(), f"wanted{k}")
        centers = ws.table(_sets(docs, nodes, wanted, repeated, rule).select(F.col("node").alias("center"), F.col("grams").alias("of_center")), f"centers{k}")
        size = centers.agg(F.coalesce(F.sum(F.size("of_center")), F.lit(0))).first()[0]
        near = _sets(docs, nodes, chosen, repeated, rule).join(F.broadcast(centers) if size <= CENTER_GRAMS else centers, "center")
        near = near.select("node", "center", "n_docs", F.size("grams").alias("n"), F.size("of_center").alias("nc"), F.array_except("of_center", "grams").alias("gone"), F.array_except("grams", "of_center").alias("new"))
        near = near.select("node", "center", "n_docs", "n", "nc", (F.col("nc") - F.size("gone")).alias("c"), F.concat("gone", "new").alias("d"))
        tries.append(ws.table(near.where(F.col("c").cast("long") * total >= (F.col("n") + F.col("nc")).cast("long") * rule.num), f"grouped{k}"))
        keys = keys.drop("f").join(tries[-1].select("node"), "node", "left_anti").join(wanted, "node", "left_anti")
    grouped = reduce(DataFrame.unionByName, tries)

    # sides of a square: each meets each, so that a large group is many tasks and a row of long sets is bounded
    spread = grouped.groupBy("center").agg(F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(SIDE), F.sum(F.size("d")) / F.lit(DIFFERENCES))).cast("int").alias("k"))
    lists = grouped.join(spread, "center").groupBy("center", "nc", "k", F.pmod(F.hash("node"), F.col("k")).alias("i")).agg(F.collect_list(F.struct("node", "n_docs", "n", "c", "d")).alias("s"))
    lists = ws.table(lists, "sides")
    left = lists.select("center", "nc", F.col("s").alias("left"), F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i"))
    both = left.join(lists.select("center", "i", F.col("s").alias("right")), ["center", "i"])
    pairs = both.select("nc", "right", F.explode("left").alias("x")).select("nc", "x", F.explode("right").alias("y"))
    least = (F.col("x.n") + F.col("y.n")).cast("long") * rule.num
    low = (F.col("x.c") + F.col("y.c") - F.col("nc")).cast("long")
    most = low + F.least(F.size("x.d"), F.size("y.d"))
    linked = F.when(low * total >= least, True).when(most * total < least, False).otherwise((low + F.size(F.array_intersect("x.d", "y.d"))) * total >= least)
    inner = pairs.where((F.col("x.node") != F.col("y.node")) & linked).groupBy(F.col("x.node").alias("node")).agg(F.sum("y.n_docs").alias("degree"))
    return grouped.select("node", "center"), ws.table(inner, "inner")


def _candidates(ws: Workspace, rows: DataFrame, copies: DataFrame, groups: DataFrame, rule: Jaccard) -> DataFrame:
    """``a, b, na, nb`` of the pairs of nodes, not of one group, that meet in their prefixes and may be links, as a written table.

    All grams before the last rare one that a pair shares are known, so its
    overlap is at most the rare grams shared and what follows in either set.
    Where frequent grams meet, all rare grams of both sets are in the prefixes;
    where none does, what follows is also less than the larger set's ``least``.
    """
    # one long a row: up to a million of them are broadcast
    copies = F.broadcast(copies) if copies.count() <= 1_000_000 else copies
    own = rows.where("n > 0").join(copies, "rid", "left_anti").select(F.col("rid").alias("node"), "n", "rare", "hot")
    # and two longs a row: up to half a million of them
    own = own.join(F.broadcast(groups) if groups.count() <= 500_000 else groups, "node", "left")
    size, place = lambda c: F.shiftright(c, 16), lambda c: F.col(c).bitwiseAND((1 << 16) - 1)
    small, large = F.least(size("ma"), size("mb")), F.greatest(size("ma"), size("mb"))
    near = (F.col("a") < F.col("b")) & F.coalesce(F.col("center_a") != F.col("center_b"), F.lit(True)) & (small * rule.den >= large * rule.num)
    # a set's size, and how many of its grams come up to here; a lower number than the true one is a weaker bound
    packed = lambda at: F.shiftleft(F.col("n").cast("long"), 16).bitwiseOR(F.least(at, F.lit((1 << 16) - 1)).cast("long")).alias("m")

    def side(df: DataFrame, name: str, *extra: Column) -> DataFrame:
        return df.select(F.col("node").alias(name), F.col("m").alias(f"m{name}"), F.col("center").alias(f"center_{name}"), "gram", *extra)

    rare = own.select("node", "n", "center", F.posexplode("rare").alias("at", "gram")).select("node", packed(F.col("at") + 1), "center", "gram")
    met = side(rare, "a").join(side(rare, "b"), "gram").where(near).select("a", "b", "ma", "mb", F.lit(1).cast("long").alias("c"))

    hot = own.where(F.size("hot") > 0).select("node", packed(F.size("rare")), "center", "hot", F.posexplode("hot").alias("at", "gram"))
    before = F.slice("hot", F.greatest(F.lit(1), F.col("at") + 1 - BEFORE), F.least(F.col("at"), F.lit(BEFORE)))
    hot = hot.select("node", "m", "center", "gram", before.alias("before"))
    big = ws.table(hot.groupBy("gram").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") > CELL).select("gram", F.ceil(F.col("f") / CELL).cast("int").alias("k")), "cells")
    hot = hot.join(big, "gram", "left").withColumn("k", F.coalesce("k", F.lit(1))).withColumn("own", F.pmod(F.hash("node"), F.col("k")))
    # a pair meets in the cell of its nodes' numbers, the lesser first
    left = hot.select("*", F.explode(F.sequence(F.col("own") * 0, F.col("k") - 1)).alias("other"))
    cell = (F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    a, b = side(left, "a", *cell, F.col("before").alias("before_a"), F.col("own").alias("own_a")), side(left, "b", *cell, F.col("before").alias("before_b"), F.col("own").alias("own_b"))
    there = (F.least("own_a", "own_b") == F.col("i")) & (F.greatest("own_a", "own_b") == F.col("j"))
    again = a.join(b, ["gram", "i", "j"]).where(near & there & ~F.arrays_overlap("before_a", "before_b")).select("a", "b", "ma", "mb", F.lit(HOT).alias("c"))

    need = F.floor(((small + large) * rule.num + (rule.num + rule.den - 1)) / F.lit(rule.num + rule.den))
    summed = met.unionByName(again).groupBy("a", "b").agg(F.max("ma").alias("ma"), F.max("mb").alias("mb"), F.sum("c").alias("c"))
    behind = F.least(size("ma") - place("ma"), size("mb") - place("mb"))
    # without a frequent gram in common, the prefixes share the rare grams counted, and no more
    behind = F.when(F.col("c") >= HOT, behind).otherwise(F.least(behind, _least(large, rule) - 1))
    kept = summed.where(F.col("c") % HOT + behind >= need)
    return ws.table(kept.select("a", "b", size("ma").alias("na"), size("mb").alias("nb")), "candidates")


def _segments(grams: Column, e: Column) -> Column:
    """The ``2 ** e`` parts of a sorted set by the leading bits of the grams."""
    number = lambda g: (F.call_function("shiftright", g, F.lit(64) - e) + F.call_function("shiftleft", F.lit(1).cast("long"), e - 1)).cast("int")
    all_ = F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), e) - 1)
    few = F.transform(all_, lambda f: F.filter(grams, lambda g: number(g) == f))
    # For many parts, their bounds are sorted among the grams, which gives the place of each.
    row = lambda v, mark: F.struct(v.cast("int").alias("v"), F.lit(mark).alias("m"))
    sorted_ = F.array_sort(F.concat(F.transform(all_, lambda f: row(f, 0)), F.transform(grams, lambda g: row(number(g), 1))))
    marks = F.filter(F.transform(sorted_, lambda x, i: F.when(x["m"] == 0, i)), lambda i: i.isNotNull())

    def cut(place: Column) -> Column:
        ends = F.concat(F.slice(place, F.lit(2), F.size(place) - 1), F.array(F.size(grams) + F.size(place)))
        return F.transform(place, lambda p, f: F.slice(grams, p - f + 1, F.get(ends, f) - p - 1))

    return F.when(e <= 4, few).otherwise(F.transform(F.array(marks), cut)[0])


def _overlaps(ws: Workspace, candidates: DataFrame, docs: DataFrame, nodes: DataFrame, repeated: bool, rule: Jaccard) -> DataFrame:
    """``a, b, overlap`` of the candidates that are links, summed from the partial overlaps of the fragments.

    Candidates are laid into blocks of about ``BLOCK`` x ``BLOCK`` nodes around
    the smallest neighbour, so that a large group of near copies sends each
    segment to a few blocks and not to each pair.
    """
    e = F.greatest(F.lit(2), F.ceil(F.log2(F.greatest("na", "nb") / F.lit(float(SEGMENT))))).cast("int")
    star = candidates.groupBy("b").agg(F.min("a").alias("hub"))
    pairs = candidates.withColumn("e", e).join(star.select(F.col("b").alias("a"), "hub"), "a", "left").withColumn("hub", F.coalesce("hub", "a"))
    spread = pairs.groupBy("hub").agg(F.greatest(F.lit(1), F.ceil(F.sqrt(2.0 * F.count(F.lit(1))) / BLOCK)).cast("int").alias("k"))
    cell = lambda x: F.pmod(F.hash(x), F.col("k"))
    pairs = ws.table(pairs.join(spread, "hub").select("hub", "a", "b", "na", "nb", "e", cell("a").alias("i"), cell("b").alias("j")), "blocks")

    ends = pairs.select("hub", "i", "j", "e", F.explode(F.array("a", "b")).alias("node")).distinct()
    whose = nodes.select("node", F.coalesce(F.col("first.id").cast("long"), F.lit(NULL_KEY)).alias("key"), F.col("first.hash").alias("text_hash"))
    wanted = ws.table(ends.join(whose, "node"), "wanted")
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("key"), F.xxhash64("text").alias("text_hash"), "text")
    # Only the texts of candidates are read as sets once more; of repeated rows any one serves. A long list meets them by
    # shuffle, in which a text is smaller than its set.
    one = wanted.groupBy("key", "text_hash").agg(F.collect_set(F.struct("hub", "i", "j", "e", "node")).alias("places"))
    near = bit_filter(keyed, wanted, ["key", "text_hash"])
    if repeated:
        near = near.groupBy("key", "text_hash").agg(F.first("text").alias("text"))
    near = near.join(F.broadcast(one) if wanted.count() <= PLACES else one, ["key", "text_hash"])
    cut = lambda grams: F.transform("places", lambda p: F.struct(p.alias("p"), _segments(grams, p["e"]).alias("s")))
    placed = near.select(F.explode(F.transform(F.array(shingles(F.col("text"), rule.n)), cut)[0]).alias("x")).select("x.p.*", F.posexplode("x.s").alias("f", "segment"))
    blocks = placed.groupBy("hub", "i", "j", "e", "f").agg(F.collect_list(F.struct("node", "segment")).alias("s"))
    blocks = blocks.select("hub", "i", "j", "e", "f", F.col("s.node").alias("nodes"), F.col("s.segment").alias("segments"))
    lists = pairs.groupBy("hub", "i", "j", "e").agg(F.collect_list(F.struct("a", "b", "na", "nb")).alias("pairs"))
    lists = lists.select("*", F.explode(F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), F.col("e")) - 1)).alias("f"))
    met = lists.join(blocks, ["hub", "i", "j", "e", "f"]).select("nodes", "segments", F.explode("pairs").alias("p"))
    of = lambda x: F.get("segments", (F.array_position("nodes", F.col(f"p.{x}")) - 1).cast("int"))
    partial = met.select("p.*", F.size(F.array_intersect(of("a"), of("b"))).cast("long").alias("c")).where("c > 0")
    counted = partial.groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("overlap"))
    return counted.where(F.col("overlap") * rule.den >= rule.num * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b", "overlap")


def components(ws: Workspace, links: DataFrame, rounds: int = 200) -> DataFrame:
    """``node, root`` for every node of a link: connected components by large-star and small-star rounds.

    Each round is written to the shared folder; the number of rounds grows with
    the logarithm of the longest path. Hubs cost one aggregated row per task.
    Components that still change after ``rounds`` raise an error.
    """
    edges = ws.table(links.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges0")
    before = None
    for step in range(1, rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        large = ws.table(large, f"large{step}")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("x"), F.col("m").alias("y")), F.struct(F.col("u").alias("x"), F.col("m").alias("y")))).alias("e"))
        edges = ws.table(small.where("e.x <> e.y").select(F.col("e.y").alias("u"), F.col("e.x").alias("v")).distinct(), f"edges{step}")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        ws.drop(f"large{step}")
        ws.drop(f"edges{step - 1}")
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    star = edges.groupBy("v").agg(F.min("u").alias("root"))
    return star.select(F.col("v").alias("node"), "root").unionByName(star.select(F.col("root").alias("node"), "root").distinct())


def _linked(docs: DataFrame, rule: Jaccard) -> DataFrame:
    """``doc_id, text_hash, n_shingles, node, first, n_docs, degree, component``: ``component`` is the first member that links reach."""
    found = similar(docs, rule)
    ends = found.links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(found.links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    sizes = found.nodes.select(F.col("node").alias("other"), F.col("n_docs").alias("other_docs"))
    degree = ends.join(sizes, "other").groupBy("node").agg(F.sum("other_docs").alias("degree"))
    degree = degree.unionByName(found.inner).groupBy("node").agg(F.sum("degree").alias("degree"))
    reached = found.groups.where("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b"))
    part = found.ws.table(components(found.ws, found.links.select("a", "b").unionByName(reached)), "components")
    lowest = part.join(found.nodes.select("node", "first"), "node").groupBy("root").agg(F.min("first").alias("component"))
    of_node = found.nodes.select("node", "n_docs", "first").join(degree, "node", "left").join(part.join(lowest, "root").select("node", "component"), "node", "left")
    of_node = found.ws.table(of_node.select("node", "n_docs", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("component", "first").alias("component")), "of_node")
    return skew_lookup(found.members.drop("n_docs", "first"), of_node, ["node"], "n_docs", found.total)


def linked_documents(docs: DataFrame, rule: Jaccard = Jaccard()) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, n_similar, component_id``.

    ``n_similar`` counts the other documents linked directly, ``component_id``
    is the smallest ``doc_id`` that links reach, the document itself included.
    """
    return _linked(docs, rule).select(
        "doc_id",
        "n_shingles",
        F.coalesce(F.col("degree") + F.col("n_docs") - 1, F.lit(0)).cast("long").alias("n_similar"),
        F.coalesce("component.id", "doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, rule: Jaccard = Jaccard()) -> DataFrame:
    """``docs`` with one document of each linked group: that of the smallest ``doc_id``, a null one last, then by text; all its columns.

    Rows are told apart by ``doc_id`` and text, so a further text under a
    rejected ``doc_id`` stays. Rows that repeat both stay together.
    """
    ws = Workspace(docs.sparkSession, "ngram-keep")
    other = ~(F.col("doc_id").eqNullSafe(F.col("component.id")) & (F.col("text_hash") == F.col("component.hash")))
    gone = _linked(docs, rule).where(F.col("component").isNotNull() & other).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return without_rows(docs, ws.table(gone, "gone"))
