"""Star schema growth: dimensions only gain members, the first batch to publish a sale wins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleskeep.contract import FACT_SCHEMA
from saleskeep.functions.clock import date_key, month_name
from saleskeep.operators.keys import numbered, numbered_in_order
from saleskeep.operators.lookup import Lookup, lookup_join


def new_dates(valid: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Calendar rows of the sale dates that the date dimension lacks."""
    day = F.col("fecha")
    return (
        valid.select(F.col("fecha_venta").alias("fecha"))
        .distinct()
        .join(dim_date.select("fecha"), "fecha", "left_anti")
        .select(
            date_key(day).alias("fecha_key"),
            "fecha",
            F.dayofmonth(day).alias("dia"),
            F.month(day).alias("mes"),
            month_name(day).alias("nombre_mes"),
            F.quarter(day).alias("trimestre"),
            F.year(day).alias("anio"),
        )
    )


def new_products(valid: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Products, whatever their case, that the dimension lacks.

    Of several spellings (and categories) in one batch the smallest is kept.
    """
    current = dim_product.filter("vigente").select(F.lower("producto").alias("_producto"))
    # Distinct spellings first: they are found by hashing, the smallest text needs a sort.
    spellings = valid.select("producto", "categoria").distinct()
    return (
        spellings.groupBy(F.lower("producto").alias("_producto"))
        .agg(F.min("producto").alias("producto"), F.min("categoria").alias("categoria"))
        .join(current, "_producto", "left_anti")
        .select("producto", "categoria")
    )


def new_regions(valid: DataFrame, dim_region: DataFrame) -> DataFrame:
    current = dim_region.filter("vigente").select(F.lower("region").alias("_region"))
    return (
        valid.select("region")
        .distinct()
        .groupBy(F.lower("region").alias("_region"))
        .agg(F.min("region").alias("region"))
        .join(current, "_region", "left_anti")
        .select("region")
    )


def keyed_products(products: DataFrame, start: int, buckets: int = 1) -> DataFrame:
    """Product members with their surrogate keys, numbered on from ``start``."""
    keyed = numbered(products, F.lower("producto"), "producto_key", start, buckets)
    return keyed.select(
        F.col("producto_key").cast("bigint"), "producto", "categoria", F.lit(True).alias("vigente")
    )


def keyed_regions(regions: DataFrame, start: int, buckets: int = 1) -> DataFrame:
    """Region members with their surrogate keys, numbered on from ``start``."""
    keyed = numbered(regions, F.lower("region"), "region_key", start, buckets)
    return keyed.select(F.col("region_key").cast("int"), "region", F.lit(True).alias("vigente"))


@dataclass(frozen=True)
class DimensionKeys:
    """Surrogate keys by business key, sizes already measured."""

    dates: Lookup
    products: Lookup
    regions: Lookup

    @classmethod
    def measured(
        cls, dim_date: DataFrame, dim_product: DataFrame, dim_region: DataFrame
    ) -> DimensionKeys:
        dates = dim_date.select(F.col("fecha").alias("fecha_venta"), "fecha_key")
        products = dim_product.filter("vigente").select(
            F.lower("producto").alias("_producto"), "producto_key"
        )
        regions = dim_region.filter("vigente").select(
            F.lower("region").alias("_region"), "region_key"
        )
        return cls(
            Lookup.measured(dates, "fecha_venta"),
            Lookup.measured(products, "_producto"),
            Lookup.measured(regions, "_region"),
        )


def unpublished(valid: DataFrame, published: DataFrame) -> DataFrame:
    """Valid rows whose sale no earlier batch has published.

    Both sides hold an id at most once, so the shuffle on it is even.
    """
    return valid.join(published.select("id_venta"), "id_venta", "left_anti")


def fact_rows(
    valid: DataFrame,
    published: DataFrame | None,
    keys: DimensionKeys,
    loaded_at: Column,
) -> DataFrame:
    """Fact rows of the valid rows that are not published yet, with their row key for a key."""
    keyed = valid.withColumn("_producto", F.lower("producto")).withColumn(
        "_region", F.lower("region")
    )
    rows = keyed if published is None else unpublished(keyed, published)
    for lookup in (keys.dates, keys.products, keys.regions):
        rows = lookup_join(rows, lookup, ["raw_row_key"], "inner", counted=keyed)
    rows = rows.withColumn("venta_key", F.col("raw_row_key")).withColumn("fecha_carga", loaded_at)
    return rows.select(*FACT_SCHEMA.names)


def keyed_facts(facts: DataFrame, start: int) -> DataFrame:
    """Fact rows of a written table with surrogate keys start+1, start+2, ... without gaps, in the
    order of the row keys."""
    keyed = numbered_in_order(facts.withColumnRenamed("venta_key", "_row"), "_row", "venta_key", start)
    return keyed.select(*FACT_SCHEMA.names)


def id_aliases(evaluated: DataFrame) -> DataFrame:
    """Valid ids written in more than one way (7 and 07), which a unique key must refuse.

    Such a group needs at least one unusual spelling, so only those ids are looked at.
    """
    valid = evaluated.filter("es_valido").select("id_venta", "id_usual")
    unusual = valid.filter("NOT id_usual").select("id_venta").distinct()
    return (
        valid.join(unusual, "id_venta", "left_semi")
        .groupBy("id_venta")
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )
