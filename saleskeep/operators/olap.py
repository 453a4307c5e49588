"""OLAP reports: grouping, rollup, cube, grouping sets, matrix.

Multi-level reports first total the finest level they need, then build the levels from those
totals: rows are multiplied per level only after they have become few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleskeep.operators.mart import MONEY, Mart

# Labels of the rollup's total rows.
GRAND_TOTAL = "TOTAL GENERAL"
ALL_PRODUCTS = "TODOS LOS PRODUCTOS"
REGION_SUBTOTAL = "SUBTOTAL REGIÓN"


def _amount():
    return F.sum("ventas_totales").cast(MONEY).alias("ventas_totales")


def sales_by_region(mart: Mart) -> DataFrame:
    totals = mart.totals("region").select("region", "ventas_totales", "unidades_vendidas")
    return totals.orderBy(F.desc("ventas_totales"))


def sales_by_month_and_category(mart: Mart) -> DataFrame:
    keys = ("anio", "mes", "categoria")
    return mart.totals(*keys).select(*keys, "ventas_totales").orderBy(*keys)


def monthly_sales(mart: Mart) -> DataFrame:
    return mart.totals("anio", "mes").orderBy("anio", "mes")


def rollup_region_product(mart: Mart) -> DataFrame:
    """Detail, region subtotals and grand total, the totals labelled."""
    levels = (
        mart.totals("region", "producto")
        .rollup("region", "producto")
        .agg(
            F.grouping("region").alias("_all_regions"),
            F.grouping("producto").alias("_all_products"),
            _amount(),
        )
    )
    region_label = F.when(F.col("_all_regions") == 1, GRAND_TOTAL).otherwise(F.col("region"))
    product_label = (
        F.when(F.col("_all_regions") == 1, ALL_PRODUCTS)
        .when(F.col("_all_products") == 1, REGION_SUBTOTAL)
        .otherwise(F.col("producto"))
    )
    return (
        levels.withColumn("producto", product_label)
        .withColumn("region", region_label)
        .orderBy("_all_regions", "region", "_all_products", F.desc("ventas_totales"))
        .select("region", "producto", "ventas_totales")
    )


def cube_region_category_month(mart: Mart) -> DataFrame:
    """Every combination of region, category and month, with flags for the summed-out ones."""
    keys = ("region", "categoria", "mes")
    flags = [f"agrupa_{key}" for key in keys]
    return (
        mart.totals(*keys)
        .cube(*keys)
        .agg(*(F.grouping(key).cast("int").alias(f) for key, f in zip(keys, flags)), _amount())
        .orderBy(*flags, *keys)
    )


def selected_groupings(mart: Mart) -> DataFrame:
    """Region by month, category by month, region, and grand total, with their level number."""
    keys = ("region", "categoria", "mes")
    levels = [("region", "mes"), ("categoria", "mes"), ("region",), ()]
    return (
        mart.totals(*keys)
        .groupingSets([[F.col(name) for name in level] for level in levels], *keys)
        .agg(F.grouping_id(*keys).cast("int").alias("nivel_agrupacion"), _amount())
        .orderBy("nivel_agrupacion", *keys)
    )


def category_region_totals(mart: Mart) -> DataFrame:
    """The cells of the matrix as rows, for any number of regions."""
    return mart.totals("categoria", "region").select("categoria", "region", "ventas_totales")


def matrix_category_region(mart: Mart, regions: Sequence[str]) -> DataFrame:
    """Categories down, the regions named across, amounts in the cells."""
    totals = category_region_totals(mart)
    return totals.groupBy("categoria").pivot("region", list(regions)).agg(_amount())
