"""Immutable landing folders: a folder is written once, a second writer must bring the same."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleskeep.operators.audit import content_digest
from saleskeep.sources.sales import as_text, read_csv, write_csv
from saleskeep.workspace import shuffles_dropped


# Rejects per written file: a JSON row is several times as long as its CSV row, and a file's digest
# reads it whole.
REJECTS_PER_FILE = 100_000


class ImmutableArtifactError(RuntimeError):
    """A finished folder holds other content than the one offered."""


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds the result of a completed write."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    files = marker.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(marker)


def write_once(
    spark: SparkSession,
    content: DataFrame,
    path: str,
    write: Callable[[DataFrame, str], None],
    read: Callable[[str], DataFrame],
    clocks: Sequence[str] = (),
) -> None:
    """Write a folder unless a completed write is there; then the contents must be equal.

    What an interrupted write left behind is written again. ``read`` returns the columns of
    ``content``. Columns named as ``clocks`` hold the time of writing, which a repeated batch
    may change: they take no part in the comparison.
    """
    if not is_finished(spark, path):
        with shuffles_dropped(spark):
            write(content, path)
        return
    lasting = [name for name in content.columns if name not in clocks]
    offered = content_digest(content.select(*lasting)).first()
    present = content_digest(read(path).select(*lasting)).first()
    if offered != present:
        raise ImmutableArtifactError(f"{path} already holds different content")


def land_raw(
    spark: SparkSession, sales: DataFrame, path: str, packing: dict[str, str] | None = None
) -> None:
    """Land the seven source columns as CSV before anything is done to them."""
    text = as_text(sales).fillna("")
    write_once(
        spark,
        text,
        path,
        lambda rows, to: write_csv(rows, to, mode="overwrite", packing=packing),
        lambda landed: read_csv(spark, landed),
    )


def read_landed(
    spark: SparkSession, base: str, uri: str, positions: bool = False
) -> DataFrame:
    """Read a landed folder back, refusing folders outside the configured base."""
    root = base.rstrip("/") + "/"
    inner = uri.removeprefix(root)
    if not uri.startswith(root) or not inner.strip("/") or ".." in inner.split("/"):
        raise ValueError(f"{uri} does not belong to {base}")
    return read_csv(spark, uri, positions=positions)


def quarantine_json(
    spark: SparkSession, rejected: DataFrame, path: str, packing: dict[str, str] | None = None
) -> None:
    """Export rejects once, in key order, one JSON object a line, every field present; ``packing`` holds
    further options of the writer."""
    stamp = "fecha_rechazo"

    def write(rows: DataFrame, to: str) -> None:
        ordered = rows.orderBy("rechazo_key")
        text = ordered.withColumn(stamp, F.col(stamp).cast("string"))
        options = {"ignoreNullFields": False, "maxRecordsPerFile": REJECTS_PER_FILE, **(packing or {})}
        text.write.mode("overwrite").options(**options).json(to)

    write_once(
        spark, rejected, path, write, lambda at: read_quarantine(spark, at, rejected), (stamp,)
    )


def read_quarantine(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read a quarantine export with the columns of the rejects it was written from."""
    ddl = ", ".join(
        f"{name} {'string' if kind == 'timestamp_ntz' else kind}" for name, kind in like.dtypes
    )
    text = spark.read.schema(ddl).option("mode", "FAILFAST").json(path)
    return text.select(*(F.col(name).cast(kind).alias(name) for name, kind in like.dtypes))


def write_document(document: DataFrame, path: str) -> None:
    """Write a one-row frame as a JSON document folder."""
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def land_manifest(spark: SparkSession, document: DataFrame, path: str) -> None:
    """Land a manifest once."""
    schema = document.schema
    write_once(
        spark,
        document,
        path,
        write_document,
        lambda landed: spark.read.schema(schema).json(landed),
        clocks=("extracted_at_utc",),
    )
