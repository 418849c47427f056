"""Sharding by histogram sort: exact byte counts below probes, refined until the splitters meet tolerance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Workspace, running_sum

#: Bits by which a round refines an interval: at most ``2 ** BITS`` probes a splitter.
BITS = 10
LOW = -(1 << 63)


@dataclass(frozen=True)
class Splitter:
    """Rows from ``key`` on belong to the next shard. The key has three longs: text hash, ``doc_id``, row."""

    key: tuple[int, int, int]
    below: int


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32`` and the sort key ``k0, k1, k2`` of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("k0"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOW)).alias("k1"),
        F.monotonically_increasing_id().alias("k2"),
    )


def _digit(level: int) -> tuple[Column, int]:
    """The next bits of the 192-bit key, order-preserving, and the bits before the last of them in their long."""
    part, step = divmod(level, 7)
    shift = 64 - BITS * (step + 1) if step < 6 else 0
    column = F.col(f"k{part}")
    if step == 0:
        return F.shiftright(column, shift) + (1 << (BITS - 1)), shift
    width = BITS if step < 6 else 64 - 6 * BITS
    return F.shiftright(column, shift).bitwiseAND((1 << width) - 1), shift


def _below(key: tuple[int, int, int], names: tuple[str, str, str]) -> Column:
    """Whether a row's key, in the named columns, is below ``key``."""
    k = [F.col(n) for n in names]
    return (k[0] < key[0]) | ((k[0] == key[0]) & ((k[1] < key[1]) | ((k[1] == key[1]) & (k[2] < key[2]))))


def splitters(rows: DataFrame, shards: int, tolerance: float = 0.005) -> list[Splitter]:
    """The ``shards - 1`` keys at which shards of near equal bytes begin.

    Each round counts, in one pass with sums combined before the shuffle, the
    exact bytes below evenly spaced probes of every interval that still holds
    an unmet splitter, and keeps the interval that spans it. A splitter is met
    when a probe is within ``tolerance`` of a shard's bytes, or when its interval
    is down to one text; what reaches the driver is at most ``2 ** BITS`` sums for each
    splitter. Keys begin with a hash of the text, so equal texts stay together
    unless a group exceeds ten times the tolerance; then it is cut by ``doc_id``.
    """
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if not total:
        return []
    near, group = tolerance * total / shards, 10 * tolerance * total / shards
    goals = {k: total * k / shards for k in range(1, shards)}
    done: dict[int, Splitter] = {}
    # Open splitters by the interval that spans them: (first key of it, bytes below it).
    spans: dict[tuple[int, int, int], tuple[int, list[int]]] = {(LOW, LOW, 0): (0, list(goals))}
    level = 0
    while spans:
        part, step = divmod(level, 7)
        digit, shift = _digit(level)
        prefix = [F.col(f"k{i}") for i in range(part)] + ([F.shiftleft(F.shiftright(F.col(f"k{part}"), (64 - BITS * step)), 64 - BITS * step)] if step else [])
        chosen = None
        for key in spans:
            test = F.lit(True)
            for column, value in zip(prefix, key, strict=False):
                test = test & (column == value)
            chosen = test if chosen is None else chosen | test
        named = [c.alias(f"p{i}") for i, c in enumerate(prefix)]
        counts = rows.where(chosen).select(*named, digit.alias("d"), "size").groupBy(*[f"p{i}" for i in range(len(named))], "d").agg(F.sum("size").alias("bytes")).collect()
        by_span: dict[tuple, list[tuple[int, int]]] = {}
        for r in counts:
            by_span.setdefault(tuple(r[f"p{i}"] for i in range(len(named))), []).append((r["d"], r["bytes"]))
        following: dict[tuple[int, int, int], tuple[int, list[int]]] = {}
        for key, (below, open_) in spans.items():
            bins = sorted(by_span.get(key[: len(named)], []))
            for k in open_:
                at, place = below, 0
                while place < len(bins) - 1 and at + bins[place][1] <= goals[k]:
                    at += bins[place][1]
                    place += 1
                d, size = bins[place]
                begin, end = _probe(key, part, step, d, shift), _probe(key, part, step, d + 1, shift)
                choice = [(abs(at - goals[k]), begin, at), (abs(at + size - goals[k]), end, at + size)]
                error, probe, bytes_below = min(choice)
                if error <= near or level == 20 or (level >= 6 and size <= group):
                    done[k] = Splitter(probe, bytes_below)
                else:
                    following.setdefault(begin, (at, []))[1].append(k)
        spans, level = following, level + 1
    return [done[k] for k in sorted(done)]


def _probe(key: tuple[int, int, int], part: int, step: int, digit: int, shift: int) -> tuple[int, int, int]:
    base = (digit - (1 << (BITS - 1))) << shift if step == 0 else key[part] + (digit << shift)
    begin = [*key[:part], base, *([LOW, 0][part:] if part < 2 else [])]
    # A probe one past the last value of a long is the next key of the long before it.
    for i in (2, 1):
        if begin[i] >= 1 << 63:
            begin[i - 1 : i + 1] = [begin[i - 1] + 1, LOW if i == 1 else 0]
    begin[0] = min(begin[0], (1 << 63) - 1) if begin[0] < 1 << 63 else (1 << 63) - 1
    return tuple(begin)


def shard_of(found: list[Splitter], names: tuple[str, str, str] = ("k0", "k1", "k2")) -> Column:
    out = F.lit(0)
    for s in found:
        out = out + F.when(_below(s.key, names), 0).otherwise(1)
    return out.cast("int")


def assign(docs: DataFrame, shards: int = 16, tolerance: float = 0.005) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``.

    ``size`` is the text's UTF-8 bytes (null: none) plus 1. Shards have near
    equal bytes; ``slot`` numbers a shard's rows from 0 in key order. The sizes
    and keys are written once, without texts; the rounds read them, and one
    sorted exchange numbers them. Repeated rows differ in the last part of the
    key, so even a group of equal rows is cut where bytes demand it. An empty
    table gives an empty result.
    """
    ws = Workspace(docs.sparkSession, "sharding")
    rows = ws.table(sized(docs), "sized")
    placed = rows.withColumn("shard", shard_of(splitters(rows, shards, tolerance))).withColumn("one", F.lit(1))
    numbered = running_sum(ws, placed, ["shard"], ["k0", "k1", "k2"], "one", "placed")
    return numbered.select("doc_id", "size", "text_crc32", "shard", F.col("before").alias("slot"))


def write(docs: DataFrame, path: str, shards: int = 16, tolerance: float = 0.005) -> None:
    """Write the documents, all columns, as one folder ``shard=k`` each, after a single exchange of the texts.

    Rows are placed by the splitters alone. A group of rows equal in text and
    ``doc_id`` stays in one shard here. Where the documents have a column
    ``shard``, that of the folders gets underscores behind its name.
    """
    ws = Workspace(docs.sparkSession, "sharding")
    found = splitters(ws.table(sized(docs), "sized"), shards, tolerance)
    folder = "shard"
    while folder in docs.columns:
        folder += "_"
    own = ("__lexmill_k0", "__lexmill_k1", "__lexmill_k2")
    keyed = docs.withColumns({own[0]: F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), own[1]: F.coalesce(F.col("doc_id").cast("long"), F.lit(LOW)), own[2]: F.lit(0).cast("long")})
    keyed = keyed.withColumn(folder, shard_of(found, own)).repartitionByRange(4 * shards, folder, *own[:2])
    keyed.sortWithinPartitions(folder, *own[:2]).drop(*own).write.partitionBy(folder).parquet(path)
