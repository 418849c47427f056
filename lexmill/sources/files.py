"""Items from Parquet chunks, plain files, labelled folders, tables of ground truth and JSON lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import project
from lexmill.schema import ITEM


def read_chunks(spark: SparkSession, paths: str | list[str], schema: str = ITEM, pattern: str | None = None) -> DataFrame:
    """Written items. Failed reads are tried again by Spark (``spark.task.maxFailures``)."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(*([paths] if isinstance(paths, str) else paths))


def read_files(spark: SparkSession, paths: str | list[str], abs_url: str | None = None, url_prefix: str = "file://", time: str | int = "mtime", encoding: str | None = None, pattern: str | None = None) -> DataFrame:
    """One item per file. The URL is ``abs_url`` or the prefix and path; the time is the file's, ``now``, or a number."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(paths)
    path = F.regexp_replace("path", "^file:/*", "/")
    ticks = {"mtime": F.unix_micros("modificationTime") / 1e6, "now": F.unix_timestamp().cast("double")}.get(time) if isinstance(time, str) else F.lit(float(time))
    rows = files.select(
        F.lit(abs_url).alias("url") if abs_url else F.concat(F.lit(url_prefix), path).alias("url"),
        F.col("content").alias("raw"), F.lit(encoding).cast("string").alias("encoding"), ticks.alias("ticks"), path.alias("i_str"), F.lit(0).cast("long").alias("pos"),
        F.lit(None).cast("string").alias("media_type"), F.lit(None).cast("string").alias("clean_html"), F.lit(None).cast("string").alias("clean_visible"), F.lit(None).cast("string").alias("source"),
    )
    return project.with_identity(rows, epoch=F.col("ticks")).drop("ticks", "url")


#: 1998-12-31T23:59:59.999999Z, the time of all articles of the labelled-folder corpus.
FOLDER_TIME = 915_148_799.999999


def read_labelled_folders(spark: SparkSession, root: str, mentions: Iterable[str] = ("john", "smith"), annotator: str = "bagga-and-baldwin", source: str = "john-smith") -> tuple[DataFrame, DataFrame]:
    """Items and ratings of text files in folders named by their target: ``root/<target>/<file>``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    label, name = F.regexp_extract("path", "/([^/]+)/[^/]+$", 1), F.regexp_extract("path", "/([^/]+/[^/]+)$", 1)
    rows = files.select(F.concat(F.lit(f"{source}/"), name).alias("url"), label.alias("target"), F.decode("content", "UTF-8").alias("clean_visible"), F.col("content").alias("raw"))
    items = project.with_identity(rows, epoch=F.lit(FOLDER_TIME)).withColumns({"source": F.lit(source), "lang_code": F.lit("en"), "lang_name": F.lit("English"), "media_type": F.lit("text/plain"), "clean_html": F.lit(None).cast("string")})
    ratings = items.select("stream_id", F.lit(annotator).alias("annotator_id"), F.col("target").alias("target_id"), F.lit(True).alias("contains_mention"), F.array(*[F.lit(m) for m in mentions]).alias("mentions"))
    return items.drop("url", "target"), ratings


def with_ground_truth(items: DataFrame, truth: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Items with the row of a table of ground truth that names their file; a missing one raises."""
    name = F.regexp_extract("abs_url", "([^/]+/[^/]+)$", 1)
    joined = items.withColumn("__name", name).join(truth.withColumnRenamed(file_name, "__name").withColumn("__found", F.lit(True)), "__name", "left")
    checked = F.when(F.col("__found"), F.col("__name")).otherwise(F.raise_error(F.concat(F.lit("no ground truth for "), "__name")))
    return joined.withColumn(file_name, checked).drop("__name", "__found")


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("target_id string, mention string, file_name string, entity_type string").csv(path, sep="\t")


SOCIAL = "doc_id string, source string, abs_url string, epoch_ticks double, title string, anchor string, body string, _corrupt_record string"


def read_social_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Items and other content of gzipped JSON lines of social posts; lines that are no JSON or not social are left out."""
    rows = spark.read.schema(SOCIAL).option("mode", "PERMISSIVE").json(path).where("_corrupt_record is null and source = 'social' and abs_url is not null").drop("_corrupt_record")
    paragraph = lambda c: F.when(F.length(c) > 0, F.concat(F.lit("<p>"), F.col(c), F.lit("</p>"))).otherwise(F.lit(""))
    page = F.concat(paragraph("anchor"), paragraph("title"), F.coalesce("body", F.lit("")))
    items = project.with_identity(rows.withColumns({"raw": F.encode(page, "UTF-8"), "media_type": F.lit("text/html"), "encoding": F.lit("UTF-8")}), url="abs_url", epoch=F.col("epoch_ticks"))
    pairs = items.select("stream_id", F.explode(F.map_filter(F.create_map(F.lit("title"), "title", F.lit("anchor"), "anchor"), lambda _, v: F.length(v) > 0)).alias("key", "clean_visible"))
    return items.drop("title", "anchor", "body"), pairs


def read_entity_xml(spark: SparkSession, path: str) -> DataFrame:
    """One item per annotation XML file; its day is the start of the file's name (``YYYYMMDD``), else now."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").load(path)
    text = F.decode("content", "UTF-8")
    name = F.regexp_extract("path", "([^/]+)$", 1)
    day = F.try_to_timestamp(F.regexp_extract(name, "^([0-9]{8}).", 1), F.lit("yyyyMMdd"))
    rows = files.select(
        F.concat(F.lit("xml://"), F.coalesce(F.nullif(F.xpath_string(text, F.lit("//Document/@docid")), F.lit("")), name)).alias("url"),
        F.unix_seconds(F.coalesce(day, F.current_timestamp())).alias("ticks"), F.xpath_string(text, F.lit("//Document/@source_type")).alias("source"),
        F.encode(F.xpath_string(text, F.lit("//OriginalText/Contents")), "UTF-8").alias("raw"), text.alias("tagging"),
    )
    return project.with_identity(rows, epoch=F.col("ticks")).drop("url", "ticks")
