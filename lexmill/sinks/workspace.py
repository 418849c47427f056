"""A folder that all executors share, and tables and files of one call in it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it in ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder that
    goes when Python ends; a cluster session gets an error, because executors
    could not read each other's files there.
    """
    conf = spark.sparkContext.getConf()
    if base := conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="lexmill-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return "file://" + _own[app]


def bounded_arrow_batches(spark: SparkSession, most: int = 4_000_000) -> None:
    """Keep Arrow batches of whole texts or files to some bytes (a row at least); batches of thin rows stay as long as they are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


class Workspace:
    """Tables and files of one operator call, written under the shared folder.

    A written table cuts the lineage: a lost executor costs the re-read of
    some files, never the steps before them. What a call leaves goes when the
    driver's Python ends, for results may be read until then.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/lexmill/{name}-{uuid.uuid4().hex}"
        atexit.register(self._leave)

    def table(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.options(**options).mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Remove a table, or all of the call's."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def _leave(self) -> None:
        if self.root.startswith("file:"):
            shutil.rmtree("/" + self.root.split(":", 1)[1].lstrip("/"), ignore_errors=True)
        elif self.spark.sparkContext._jsc is not None:
            self.drop()


def write_files(rows: DataFrame, folder: str) -> None:
    """Each row ``name, content`` as a file, written aside and renamed, so that a repeated task leaves whole files."""

    def save(part: Iterator[Row]) -> None:
        from pyarrow import fs

        for row in part:
            store, root = fs.FileSystem.from_uri(folder)
            path = f"{root}/{row['name']}"
            store.create_dir(path.rpartition("/")[0], recursive=True)
            with store.open_output_stream(f"{path}.part") as f:
                f.write(bytes(row["content"]))
            store.move(f"{path}.part", path)

    rows.select("name", "content").foreachPartition(save)
