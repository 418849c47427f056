"""Continuous ingest: file streams, late data, keyed duplicates and growing counts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lexmill.operators.dedup import DedupRule, is_repeat


def read_stream(spark: SparkSession, path: str, schema: str, max_files: int = 100) -> DataFrame:
    """New Parquet files of a folder or glob as they come; progress is kept in the query's checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def with_event_time(rows: DataFrame, column: str, delay: str = "10 minutes") -> DataFrame:
    """Rows with a watermark; a zone-less time is cast, which watermarks need."""
    return rows.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def windowed_counts(rows: DataFrame, column: str, keys: list[str], width: str = "1 hour", slide: str | None = None) -> DataFrame:
    return rows.groupBy(F.window(column, width, slide), *keys).agg(F.count(F.lit(1)).alias("n"))


def drop_repeats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Exact repeats of the keys within the watermark's delay."""
    return rows.dropDuplicatesWithinWatermark(keys)


STATE = "digest string, n_clean long, n_raw long"


def dedup_stream(rows: DataFrame, rule: DedupRule = DedupRule(), keep_minutes: int = 24 * 60, delay: str = "10 minutes") -> DataFrame:
    """Kept snapshots of measured rows (see ``operators.dedup.measured``) by a state per page.

    The state is the last kept snapshot's measures; it goes when the watermark
    passes ``keep_minutes`` after the page's last snapshot, and a later one
    counts as new.
    """
    rows = with_event_time(rows.withColumn("stream_time", F.timestamp_micros((F.col("epoch_ticks") * 1_000_000).cast("long"))), "stream_time", delay)

    def step(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        latest = 0
        last: Any = (bytes.fromhex(state.get[0]), state.get[1], state.get[2]) if state.exists else None
        for frame in frames:
            frame = frame.sort_values(["epoch_ticks", "stream_id"])
            latest = max(latest, int(frame["epoch_ticks"].max() * 1000))
            kept = []
            for sid, digest, clean, raw in zip(frame["stream_id"], frame["digest"], frame["n_clean"], frame["n_raw"], strict=True):
                new = (bytes.fromhex(digest), int(clean), int(raw))
                if last is None or not is_repeat(last, new, rule):
                    last = new
                    kept.append(sid)
            yield pd.DataFrame({"stream_id": pd.Series(kept, dtype=object)})
        if last is not None:
            state.update((last[0].hex(), last[1], last[2]))
            state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + keep_minutes * 60_000)

    return rows.groupBy("doc_id").applyInPandasWithState(step, "stream_id string", STATE, "append", GroupStateTimeout.EventTimeTimeout)


def write_stream(rows: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Parquet files, each row once, by the checkpoint's log; ``once`` takes what there is and ends."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def write_batches(rows: DataFrame, checkpoint: str, write: Any, once: bool = True) -> StreamingQuery:
    """Hand each micro-batch to ``write(rows, number)``, as to the writers of index tables."""
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
