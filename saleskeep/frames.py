"""Frames of a few rows known to the driver."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def small_frame(spark: SparkSession, rows: Iterable[tuple[Any, ...]], schema: StructType) -> DataFrame:
    """A local frame; handed over as Arrow, it costs no Python worker and an empty one is
    known to be empty when the query is planned."""
    records = [dict(zip(schema.names, row)) for row in rows]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)
