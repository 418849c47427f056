"""Packing token pieces into sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import Workspace, small_arrow_batches
from lexmill.llm.tokens import encoder, gathered

#: Pieces that are packed together; the memory of a packing task is in proportion.
SHARD = 200_000


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, in the order given, and the number of bins.

    ``open_bins[g]`` counts open bins with gap g. A piece of length s goes to
    the gap g, or to a new bin, after which the sum of their squares is
    smallest; of equal sums the smallest gap is taken. Filled bins count no
    longer.
    """
    open_bins = np.zeros(capacity + 1, np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, n = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    far = np.int64(1) << 60
    for k, s in enumerate(lengths.tolist()):
        # Moving a bin from gap g to g - s changes the sum by 2 (open[g - s] - open[g] + 1); filling it, by 1 - 2 open[g].
        here = open_bins[s:capacity]
        cost = np.where(here > 0, 2 * (open_bins[: capacity - s] - here + 1), far) if s < capacity else np.empty(0, np.int64)
        if len(cost) and here[0] > 0:
            cost[0] = 1 - 2 * here[0]
        best = int(cost.argmin()) if len(cost) else 0
        fresh = 2 * int(open_bins[capacity - s]) + 1 if s < capacity else 0
        if len(cost) and cost[best] <= fresh:
            gap = s + best
            b = waiting[gap].pop()
            open_bins[gap] -= 1
        else:
            gap, b = capacity, n
            n += 1
        bins[k], offsets[k] = b, capacity - gap
        if gap > s:
            waiting[gap - s].append(b)
            open_bins[gap - s] += 1
    return bins, offsets, n


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sum-of-squares packing of lengths up to ``capacity``, longest first or as they come, whichever needs fewer bins."""
    best = None
    for order in (np.argsort(-lengths, kind="stable"), np.arange(len(lengths))):
        bins, offsets, n = sum_of_squares(lengths[order], capacity)
        if best is None or n < best[2]:
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            best = bins[back], offsets[back], n
    return best


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` of every document's pieces.

    A document is the ids of its whole text (null: empty) and ``end_id``. Only
    longer documents are cut, into pieces of ``capacity``; the last may be shorter.
    """
    small_arrow_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    out = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids)
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in gathered(batches):
            rows: list[list] = [[] for _ in out.names]
            for doc_id, ids in zip(batch[0].to_pylist(), encode(batch[1]), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    values = (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), np.frombuffer(part, "<i4"))
                    for column, value in zip(rows, values):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, out.types, strict=True)], schema=out)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def packed(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """The pieces of ``docs`` with ``sequence_id`` and ``offset``.

    Pieces are tokenised once and written, spread by hash into shards of about
    ``SHARD`` pieces, and each shard is packed on its own, so bins stay open
    within one task and the loss is a few bins a shard. A full piece is a
    sequence by itself. Repeated rows are packed as rows of their own; null
    text is a document of just the end id; an empty table gives an empty
    result; other columns are ignored.
    """
    ws = Workspace(docs.sparkSession, "packing")
    cut = ws.table(pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    shards = max(1, round(cut.count() / SHARD))
    spread = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
    placed = cut.withColumn("__shard", spread).repartition(shards, F.col("__shard")).sortWithinPartitions("__shard").drop("__shard")
    length = placed.columns.index("length")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first
            lengths = np.concatenate([b[length].to_numpy() for b in held])
            bins, offsets, n = pack(lengths, capacity)
            at = 0
            for b in held:
                part = slice(at, at := at + b.num_rows)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bins[part] + first), pa.array(offsets[part])], names=[*b.schema.names, "sequence_id", "offset"])
            first += n
            held.clear()

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= 2 * SHARD:
                yield from flush()
        if held:
            yield from flush()

    kinds = ", ".join(f"{n} {t}" for n, t in placed.dtypes)
    return placed.mapInArrow(fill, f"{kinds}, sequence_id long, offset long")


def sequences(pieces_packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of a packed table with ids: the pieces of each sequence, joined by offset."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces_packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
