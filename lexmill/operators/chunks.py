"""Chunks of items: skipping, cutting, naming and checking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions import text as T


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str = "n") -> DataFrame:
    """Number rows from 0 within ``by`` in ``order``."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)


def skip_and_limit(rows: DataFrame, order: list[str], skip: int = 0, limit: int | None = None, by: list[str] | None = None) -> DataFrame:
    """Rows ``skip`` to ``skip + limit`` of each input, or of all rows."""
    if not by:
        ordered = rows.orderBy(*order).offset(skip)
        return ordered.limit(limit) if limit is not None else ordered
    placed = numbered(rows, by, order, "__n").where(F.col("__n") >= skip)
    return (placed.where(F.col("__n") < skip + limit) if limit is not None else placed).drop("__n")


def cut(rows: DataFrame, by: list[str], order: list[str], max_items: int = 500, max_bytes: int | None = None, size: Column | None = None) -> DataFrame:
    """Add ``chunk``: a new one after ``max_items`` rows, or when the bytes so far pass a multiple of ``max_bytes``."""
    window = Window.partitionBy(*by).orderBy(*order)
    number = F.floor((F.row_number().over(window) - 1) / max_items)
    if max_bytes is None:
        return rows.withColumn("chunk", number.cast("long"))
    run = F.coalesce(F.sum(size).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("chunk", F.greatest(number, F.floor(run / max_bytes)).cast("long"))


def truncate(rows: DataFrame, by: list[str], order: list[str], max_items: int) -> DataFrame:
    return skip_and_limit(rows, order, 0, max_items, by)


def name_info(items: DataFrame, by: list[str]) -> DataFrame:
    """Facts of each chunk from which its name is made; of several hours the first counts."""
    hour = T.date_hour(F.col("stream_time"))
    prefixes = F.array_sort(F.collect_set(F.substring("doc_id", 1, 8)))
    return items.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num"),
        F.min_by(F.floor("epoch_ticks").cast("long"), F.struct("pos", "stream_id")).alias("epoch_ticks"),
        F.min(hour).alias("date_hour"),
        F.array_join(F.array_sort(F.collect_set(F.element_at(F.split("abs_url", "/"), -1))), "-").alias("target_names"),
        F.array_join(prefixes, "-").alias("doc_ids_8"),
        F.md5(F.array_join(F.array_sort(F.collect_list("stream_id")), "")).alias("md5"),
    )


def source_violations(items: DataFrame, by: list[str]) -> DataFrame:
    """Chunks that mix sources, with the number of sources; an empty result means that all is well."""
    return items.groupBy(*by).agg(F.count_distinct(F.coalesce("source", F.lit(""))).alias("n_sources")).where("n_sources > 1")


def verify(items: DataFrame, by: list[str]) -> DataFrame:
    """Counts by input: items, tagged ones, those with visible text and its bytes."""
    has = F.length("clean_visible") > 0
    tagged = F.count_if(F.col("tagged")) if "tagged" in items.columns else F.lit(0).cast("long")
    return items.groupBy(*by).agg(F.count(F.lit(1)).alias("n_items"), tagged.alias("n_tagged"), F.count_if(has).alias("n_visible"), F.coalesce(F.sum(F.when(has, F.octet_length("clean_visible"))), F.lit(0)).cast("long").alias("visible_bytes"))


def against(found: DataFrame, expected: DataFrame, by: list[str]) -> DataFrame:
    """Inputs whose number of items differs from the expected ``n_items``, missing ones included."""
    e = expected.select(*by, F.col("n_items").alias("n_expected"))
    return found.select(*by, "n_items").join(e, by, "full").where(~F.col("n_items").eqNullSafe(F.col("n_expected")))
