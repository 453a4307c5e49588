"""Scratch tables in the folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: How tables are packed that hold text of sales.
PACKED = {"compression": "zstd"}
#: How CSV and JSON may be packed, quickly; readers unpack it by the names of the files.
PACKED_TEXT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="saleskeep-")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when it is written, not when the driver happens to
    collect its garbage. Lost ones are made again, as Spark does for any."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Workspace:
    """Writes intermediate results as tables, so a lost executor never costs the lineage.

    Each workspace is a new folder and each table in it is written once, with the given options of
    the Parquet writer.
    """

    def __init__(
        self, spark: SparkSession, folder: str | None = None, options: dict[str, int | str] | None = None
    ) -> None:
        self.spark, self.options = spark, options or {}
        self.folder = f"{folder or shared_folder(spark)}/saleskeep-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"

    def keep(self, df: DataFrame, name: str, options: dict[str, int | str] | None = None) -> DataFrame:
        """Write a frame, with further options of the Parquet writer, and return it as read back from
        the written table."""
        path = self.path(name)
        with shuffles_dropped(self.spark):
            df.write.options(**self.options, **(options or {})).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete this workspace's own folder; frames kept in it can no longer be read."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.delete(folder, True)
