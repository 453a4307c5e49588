"""Shared pieces of the text operators.

Operators read only the columns they name, so further columns of a table, whatever their names,
neither clash nor travel along.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

#: Bytes of text that a task handles at a time.
SLICE_BYTES = 4 << 20


_TYPES = {
    "int": IntegerType(), "long": LongType(), "double": DoubleType(), "boolean": BooleanType(),
    "string": StringType(), "binary": BinaryType(),
}


def columns(described: str) -> StructType:
    """A schema of plain types, "name type, ...", known without a session."""
    pairs = (part.split() for part in described.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_aside(documents: DataFrame) -> DataFrame:
    """doc_id, text and rest, which holds all other columns out of the way."""
    others = [c for c in documents.columns if c not in ("doc_id", "text")]
    rest = F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.lit(0)
    return documents.select("doc_id", "text", rest.alias("rest"))


def put_back(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns `names` of what was set aside."""
    return rows.select(*(c if c in ("doc_id", "text") else F.col(f"rest.`{c}`").alias(c) for c in names))


def remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string")) % divisor


def held_out(doc_id: str, divisor: int, rest: int) -> Column:
    """True for rows that nothing may be learned from; a row without an id is one of them."""
    return F.coalesce(remainder(doc_id, divisor) == rest, F.lit(True))


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about `limit` bytes of text, whole rows each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


@contextmanager
def small_batches(spark: SparkSession, limit: int = SLICE_BYTES) -> Iterator[None]:
    """What is written inside goes to Python in batches of about `limit` bytes, whole rows each,
    instead of the session's limit."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text."""
    return column.cast(pa.binary()).to_pylist()


def joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The values of all packed rows of a column."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def record_batch(schema: StructType, values: list) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    arrays = [
        c if isinstance(c, (pa.Array, pa.ChunkedArray)) and c.type == f.type
        else c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray))
        else pa.array(c, type=f.type)
        for c, f in zip(values, arrow)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=arrow)


def lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    """A list column from all values in a row and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], list]],
    schema: str | StructType,
    column: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Apply a function of text slices on the executors. `make` runs once per task and returns
    the function, which returns the columns of `schema`."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for part in text_slices(batch, column, limit):
                yield record_batch(schema, function(part))

    return df.mapInArrow(run, schema)
