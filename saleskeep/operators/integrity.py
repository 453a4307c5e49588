"""Key checks over the published star: what a database would refuse, counted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleskeep.operators.mart import Mart

# Constraint name, dimension of the mart (None for the fact), columns that must be unique.
UNIQUE_KEYS = (
    ("fact_ventas.venta_key", None, "venta_key"),
    ("fact_ventas.id_venta", None, "id_venta"),
    ("dim_fecha.fecha_key", "dates", "fecha_key"),
    ("dim_fecha.fecha", "dates", "fecha"),
    ("dim_producto.producto_key", "products", "producto_key"),
    ("dim_producto.producto", "products", "producto"),
    ("dim_region.region_key", "regions", "region_key"),
    ("dim_region.region", "regions", "region"),
)


def duplicate_groups(df: DataFrame, *key: str) -> DataFrame:
    """Keys on more than one row."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def unique_violations(mart: Mart) -> DataFrame:
    """Per unique key the number of values that occur more than once; zero on good data."""
    counts = []
    for name, dimension, column in UNIQUE_KEYS:
        table = mart.fact if dimension is None else getattr(mart, dimension).df
        bad = duplicate_groups(table, column).agg(F.count("*").alias("violations"))
        counts.append(bad.select(F.lit(name).alias("constraint_name"), "violations"))
    return reduce(DataFrame.unionByName, counts)


def orphans(mart: Mart) -> DataFrame:
    """Per foreign key the number of fact rows without a dimension row; zero on good data.

    The fact is read once: its rows are counted per combination of the keys, and each
    combination is compared with every dimension.
    """
    dimensions = {"fk_fact_fecha": mart.dates, "fk_fact_producto": mart.products, "fk_fact_region": mart.regions}
    rows = mart.fact.groupBy(*(d.key for d in dimensions.values())).agg(F.count("*").alias("n"))
    for name, dimension in dimensions.items():
        known = dimension.df.select(dimension.key, F.lit(True).alias(name)).distinct()
        rows = rows.join(F.broadcast(known) if dimension.fits else known, dimension.key, "left")
    lost = (
        F.coalesce(F.sum(F.when(F.col(name).isNull(), F.col("n"))), F.lit(0)).alias(name)
        for name in dimensions
    )
    return rows.agg(*lost).unpivot([], list(dimensions), "constraint_name", "orphan_rows")


def key_ranges(mart: Mart) -> DataFrame:
    """Rows and distinct surrogate keys of each keyed table."""
    tables = (
        ("fact_ventas", mart.fact, "venta_key"),
        ("dim_producto", mart.products.df, "producto_key"),
        ("dim_region", mart.regions.df, "region_key"),
    )
    counts = []
    for name, table, key in tables:
        per_key = table.groupBy(key).agg(F.count("*").alias("n"))
        counts.append(
            per_key.agg(
                F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows_total"),
                F.count(key).alias("distinct_keys"),
                (F.min(key) >= 1).alias("all_positive"),
            ).withColumn("table_name", F.lit(name))
        )
    return reduce(DataFrame.unionByName, counts)
