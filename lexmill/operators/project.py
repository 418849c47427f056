"""Stages that rewrite columns of items, one row at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import html as H
from lexmill.functions import text as T


def with_identity(pages: DataFrame, url: str = "url", epoch: Column | None = None) -> DataFrame:
    """Add ``doc_id``, ``epoch_ticks``, ``stream_time`` and ``stream_id`` to rows that have a URL and a time."""
    ticks = (epoch if epoch is not None else F.unix_timestamp()).cast("double")
    rows = pages.withColumns({"abs_url": F.col(url), "doc_id": T.doc_id(F.col(url)), "epoch_ticks": ticks})
    return rows.withColumns({"stream_id": T.stream_id(F.col("epoch_ticks"), F.col("doc_id")), "stream_time": F.timestamp_micros((F.col("epoch_ticks") * 1_000_000).cast("long"))})


def make_visible(items: DataFrame) -> DataFrame:
    """``clean_visible`` from ``clean_html`` where there is some, else from plain text, else as it was."""
    raw = F.decode("raw", "UTF-8") if dict(items.dtypes).get("raw") == "binary" else F.col("raw")
    made = F.when(F.length("clean_html") > 0, T.visible(F.col("clean_html"))).when(F.col("media_type") == "text/plain", raw).otherwise(F.col("clean_visible"))
    return items.withColumn("clean_visible", made)


def add_title(items: DataFrame) -> DataFrame:
    return items.withColumn("title", T.title(F.col("clean_html"), F.col("clean_visible")))


def set_source(items: DataFrame, source: str | None = None) -> DataFrame:
    return items.withColumn("source", F.lit(source).cast("string"))


def set_language(items: DataFrame, force: tuple[str, str] | None = None) -> DataFrame:
    """Without a detector every item gets an empty code; ``force`` names code and language."""
    code, name = force or ("", "")
    return items.withColumns({"lang_code": F.lit(code), "lang_name": F.lit(name)})


def remove_raw(items: DataFrame, if_visible: bool = False) -> DataFrame:
    """Empty ``raw``; with ``if_visible`` only where there is visible text."""
    empty = F.lit("").cast(dict(items.dtypes)["raw"])
    return items.withColumn("raw", F.when(F.length("clean_visible") > 0, empty).otherwise(F.col("raw")) if if_visible else empty)


def replace_raw(items: DataFrame) -> DataFrame:
    """Put ``clean_html`` in place of ``raw``; items without any are dropped."""
    return items.where(F.length("clean_html") > 0).withColumn("raw", F.col("clean_html").cast(dict(items.dtypes)["raw"]))


def guess_media_type(items: DataFrame, fallback: str | None = None) -> DataFrame:
    raw = F.decode("raw", "ISO-8859-1") if dict(items.dtypes)["raw"] == "binary" else F.col("raw")
    unknown = F.coalesce(F.length("media_type"), F.lit(0)) == 0
    short = unknown & (F.coalesce(F.octet_length("raw"), F.lit(0)) < 40)
    typed = T.guess_media_type(raw, F.col("media_type"), F.lit(fallback).cast("string"))
    return items.withColumn("media_type", typed).withColumn("raw", F.when(short, F.lit(None)).otherwise(F.col("raw")))


def clean_html(items: DataFrame, mime_types: tuple[str, ...] = ("text/html",), language_codes: tuple[str, ...] = ()) -> DataFrame:
    """``clean_html`` from ``raw`` for the media types; items without raw are dropped; other languages are left alone."""
    media = F.lower(F.coalesce("media_type", F.lit("")))
    wanted = F.lit(not mime_types)
    for m in mime_types:
        wanted = wanted | media.startswith(m)
    if language_codes:
        wanted = wanted & F.coalesce(F.col("lang_code").isin(list(language_codes)), F.lit(False))
    rows = items.where(F.length("raw") > 0)
    raw = F.col("raw") if dict(items.dtypes)["raw"] == "binary" else F.encode("raw", "UTF-8")
    return rows.withColumn("clean_html", F.when(wanted, H.clean_html_udf(F.when(wanted, raw), F.col("encoding"), F.col("media_type"))).otherwise(F.col("clean_html")))


def force_clean_html(items: DataFrame) -> DataFrame:
    """Make ``clean_html`` of visible text where there is none; items with neither note an error and stay."""
    empty = F.coalesce(F.length("clean_html"), F.lit(0)) == 0
    text = F.coalesce(F.length("clean_visible"), F.lit(0)) > 0
    wrapped = F.concat(F.lit("<pre>"), F.col("clean_visible"), F.lit("</pre>"))
    made = H.clean_html_udf(F.when(empty & text, F.encode(wrapped, "UTF-8")), F.lit("utf-8"), F.lit("text/html"))
    rows = items.withColumn("__made", made).withColumn("clean_html", F.when(empty & text, F.col("__made")).otherwise(F.col("clean_html")))
    rows = rows.withColumn("clean_visible", F.when(empty & text, T.visible(F.col("__made"))).otherwise(F.col("clean_visible"))).drop("__made")
    return note_error(rows, empty & ~text, "force_clean_html: neither clean_html nor clean_visible")


def note_error(items: DataFrame, bad: Column, message: str) -> DataFrame:
    """Append to ``_errors`` instead of dropping or failing."""
    before = F.coalesce(F.col("_errors"), F.array().cast("array<string>")) if "_errors" in items.columns else F.array().cast("array<string>")
    return items.withColumn("_errors", F.when(F.coalesce(bad, F.lit(False)), F.array_append(before, F.lit(message))).otherwise(before))


def visible_from_raw(items: DataFrame) -> DataFrame:
    """Visible text straight from ``raw``: scripts, styles, comments and tags with quoted ``>`` are blanked."""
    return items.withColumn("clean_visible", H.visible_from_raw_udf(F.col("raw").cast("string")))


def fix_text(items: DataFrame, read_from: str = "clean_visible", write_to: str = "clean_visible") -> DataFrame:
    return items.withColumn(write_to, H.fix_text_udf(F.col(read_from).cast("string")))


def unconvertible_extract(items: DataFrame, other: DataFrame) -> DataFrame:
    """Where ``clean_html`` is empty and there is an ``extract``, move that to ``raw``."""
    extract = other.where("key = 'extract'").select("stream_id", F.coalesce(F.col("raw"), F.encode("clean_visible", "UTF-8")).alias("__raw"), F.col("media_type").alias("__media"))
    rows = items.join(extract, "stream_id", "left")
    use = (F.coalesce(F.length("clean_html"), F.lit(0)) == 0) & (F.length("__raw") > 0)
    moved = {"raw": F.when(use, F.col("__raw")).otherwise(F.col("raw")), "media_type": F.when(use, F.col("__media")).otherwise(F.col("media_type")), "encoding": F.when(use, F.lit("UTF-8")).otherwise(F.col("encoding"))}
    return rows.withColumns(moved).select(*items.columns)


def documents_to_html(items: DataFrame) -> DataFrame:
    """``clean_html`` from Word and PDF files; one that can't be read, or has no reader, stays and notes an error."""
    word = F.col("media_type").isin("application/msword", "application/vnd.openxmlformats-officedocument.wordprocessingml.document")
    pdf = F.col("media_type") == "application/pdf"
    rows = items.withColumn("__text", F.when(word | pdf, H.document_text_udf(F.when(word | pdf, F.col("raw")), F.col("media_type"))))
    noted = note_error(rows, (word | pdf) & F.col("__text").isNull(), "documents_to_html: not readable")
    return noted.withColumn("clean_html", F.coalesce("__text", "clean_html")).drop("__text")


def upgrade_social(items: DataFrame, other: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Old social items: visible text is title, anchor and body; title and anchor are kept as other content."""
    side = other.where("key in ('title', 'anchor')").groupBy("stream_id").agg(F.max(F.when(F.col("key") == "title", F.col("clean_visible"))).alias("__title"), F.max(F.when(F.col("key") == "anchor", F.col("clean_visible"))).alias("__anchor"))
    rows = items.join(side, "stream_id", "left")
    joined = F.concat_ws("\n\n", F.coalesce("__title", F.lit("")), F.coalesce("__anchor", F.lit("")), F.coalesce("clean_visible", F.lit("")))
    return rows.withColumn("clean_visible", F.when(F.col("source") == "social", joined).otherwise(F.col("clean_visible"))).select(*items.columns), other
