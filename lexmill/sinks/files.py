"""Written chunks, index tables, tarballs and tables of side outputs."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions.hashes import term_hash_udf
from lexmill.operators import index
from lexmill.sinks.workspace import Workspace
from lexmill.sources import kv


def write_chunks(items: DataFrame, path: str, by: list[str] | None = None, mode: str = "errorifexists", compression: str = "zstd", max_items: int = 500_000) -> None:
    """Parquet files, whole or not at all by the commit protocol, in folders by the columns of ``by``."""
    writer = items.write.mode(mode).option("compression", compression).option("maxRecordsPerFile", max_items)
    (writer.partitionBy(*by) if by else writer).parquet(path)


#: Postings of one task, on average; a task sorts and adds them up in memory.
POSTINGS = 1_000_000


def write_index_tables(items: DataFrame, path: str, tokens: DataFrame | None = None, with_source: bool = True, by_time: bool = True, size_limit: int = 128, mode: str = "overwrite", counted: DataFrame | None = None, with_items: bool = True) -> None:
    """The key-ordered tables of items and, for tokens or their counted terms, postings, frequencies and dictionary, each sorted by its key.

    Terms are counted and hashed once and written aside; the three tables of
    terms are made of that.
    """
    tables = kv.index_tables(items)
    if with_items:
        tables["si"].repartitionByRange("key").sortWithinPartitions("key").write.mode(mode).parquet(f"{path}/si")
    if with_source:
        tables["sisi"].repartitionByRange("key").sortWithinPartitions("key").write.mode(mode).parquet(f"{path}/sisi")
    if by_time:
        tables["siti"].repartitionByRange("epoch_ticks").sortWithinPartitions("epoch_ticks", "doc_id").write.mode(mode).parquet(f"{path}/siti")
    if counted is None and tokens is not None:
        counted = index.terms(tokens, size_limit=size_limit)
    if counted is not None:
        ws = Workspace(items.sparkSession, "terms")
        counted = ws.table(counted if "hash" in counted.columns else counted.withColumn("hash", term_hash_udf("term")), "counted")
        built = index.build(counted, parts=counted.count() // POSTINGS + 1)
        built.postings.sortWithinPartitions("hash").write.mode(mode).parquet(f"{path}/sitf")
        # what is written is read back, unless rows of an earlier call lie beside it
        written = items.sparkSession.read.schema(built.postings.schema).parquet(f"{path}/sitf") if mode == "overwrite" else built.postings
        for name, table in (("sihf", index.frequencies(written, counted)), ("sihk", built.dictionary)):
            table.repartitionByRange("hash").sortWithinPartitions("hash").write.mode(mode).parquet(f"{path}/{name}")
        ws.drop()


def tarballs(items: DataFrame, by: list[str], languages: list[str] | None = None, user: str = "nobody", group: str = "nogroup") -> DataFrame:
    """``by..., tar``: one tar.gz per group with the clean HTML, or else visible text, of each item; cut the groups by chunk first."""
    rows = items.where(F.col("lang_code").isin(languages)) if languages else items
    body = F.when(F.length("clean_html") > 0, F.col("clean_html")).otherwise(F.col("clean_visible"))
    rows = rows.withColumn("__body", F.encode(body, "UTF-8")).where(F.length("__body") > 0).select(*by, "stream_id", F.floor("epoch_ticks").cast("long").alias("__time"), "__body")
    schema = ", ".join(f"`{c}` {dict(items.dtypes)[c]}" for c in by) + ", tar binary"

    def make(frame: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w:gz") as tar:
            for r in frame.sort_values("stream_id").itertuples(index=False):
                info = tarfile.TarInfo(r.stream_id)
                info.size, info.mtime, info.mode, info.uname, info.gname = len(r[-1]), int(r[-2]), 0o644, user, group
                tar.addfile(info, io.BytesIO(bytes(r[-1])))
        return pd.DataFrame([[*frame.iloc[0][by], out.getvalue()]], columns=[*by, "tar"])

    return rows.groupBy(*by).applyInPandas(make, schema)


def write_tarballs(tars: DataFrame, path: str, by: list[str]) -> None:
    """Each tarball as a file named by its group, written aside and renamed."""
    from pyarrow import fs

    def save(frames: Iterator[pd.DataFrame]) -> None:
        for row in frames:
            store, folder = fs.FileSystem.from_uri(path)
            store.create_dir(folder, recursive=True)
            name = f"{folder}/{'-'.join(str(row[c]) for c in by)}.tar.gz"
            with store.open_output_stream(f"{name}.part") as f:
                f.write(bytes(row["tar"]))
            store.move(f"{name}.part", name)

    tars.foreachPartition(save)


def write_side_table(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated text, such as stream ids with URLs or statistics of labels."""
    rows.write.mode(mode).option("sep", "\t").csv(path)


def verified_write(items: DataFrame, path: str) -> int:
    """Write, read back, and compare row counts and digests of keys; the number of rows, or an error."""
    items.write.mode("overwrite").parquet(path)
    digest = lambda rows: rows.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("stream_id")).alias("x")).first()
    sent, stored = digest(items), digest(items.sparkSession.read.parquet(path))
    if sent != stored:
        raise OSError(f"{path}: wrote {sent['n']} items, found {stored['n']}")
    return stored["n"]


def named_paths(info: DataFrame, template: str) -> DataFrame:
    """Chunk names from their facts: ``{date_hour}/{num}-{md5}`` and the like."""
    out = F.lit(template)
    for c in info.columns:
        out = F.replace(out, F.lit("{" + c + "}"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    return info.withColumn("name", out)


def dump_ids(items: DataFrame) -> DataFrame:
    return items.select("stream_id", "abs_url", T.date_hour(F.col("stream_time")).alias("date_hour"))
