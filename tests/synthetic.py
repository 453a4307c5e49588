"""Repeatable synthetic sales with twenty controlled errors, generated on the executors.

Every value is a function of the sale id, the seed and the column, so the same arguments give
the same rows on any cluster.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleskeep.sources.catalog import SEED_PRODUCTS, SEED_REGIONS

# Defaults, weights in percent, and the texts of unknown values.
DEFAULT_SEED = 20260905
FIRST_DAY = date(2023, 9, 1)
PROCESSING_DATE = date(2026, 9, 1)
REGION_WEIGHTS = (45, 17, 15, 13, 10)
QUANTITY_WEIGHTS = (46, 27, 15, 8, 4)
UNKNOWN_REGION = "REGION_NO_RECONOCIDA"
WRONG_CATEGORY = "CATEGORIA_INCONSISTENTE"
CONTROLLED_ERRORS = 20


def _draw(seed: int, column: str, choices: Column) -> Column:
    """A number from 0 to choices-1."""
    return F.pmod(F.xxhash64(F.col("id_venta"), F.lit(seed), F.lit(column)), choices)


def _weighted(draw: Column, values: tuple, weights: tuple[int, ...]) -> Column:
    """The value whose share of 0..99 holds the draw."""
    chosen, limit = F.lit(values[-1]), 100
    for value, weight in reversed(list(zip(values, weights))):
        chosen = F.when(draw < limit, F.lit(value)).otherwise(chosen)
        limit -= weight
    return chosen


def synthetic_sales(
    spark: SparkSession,
    rows: int = 10_000,
    seed: int = DEFAULT_SEED,
    processing_date: date = PROCESSING_DATE,
) -> DataFrame:
    """Clean sales: any product, a price within its range, any day up to the processing date."""
    if rows < CONTROLLED_ERRORS:
        raise ValueError(f"at least {CONTROLLED_ERRORS} rows are needed for the controlled errors")
    products = F.array(
        *(
            F.struct(
                F.lit(name).alias("name"),
                F.lit(category).alias("category"),
                F.lit(lowest * 100).alias("lowest"),
                F.lit(highest * 100).alias("highest"),
            )
            for name, category, lowest, highest in SEED_PRODUCTS
        )
    )
    days = F.lit((processing_date - FIRST_DAY).days + 1)
    product_number = _draw(seed, "producto", F.lit(len(SEED_PRODUCTS))) + 1
    drawn = spark.range(1, rows + 1).select(F.col("id").alias("id_venta")).select(
        "id_venta", F.element_at(products, product_number.cast("int")).alias("p")
    )
    cents = F.col("p.lowest") + _draw(
        seed, "precio_unitario", F.col("p.highest") - F.col("p.lowest") + 1
    )
    hundred = F.lit(100)
    return drawn.select(
        "id_venta",
        F.date_add(F.lit(FIRST_DAY), _draw(seed, "fecha_venta", days).cast("int")).alias(
            "fecha_venta"
        ),
        F.col("p.name").alias("producto"),
        F.col("p.category").alias("categoria"),
        _weighted(_draw(seed, "region", hundred), SEED_REGIONS, REGION_WEIGHTS).alias("region"),
        _weighted(_draw(seed, "cantidad", hundred), (1, 2, 3, 4, 5), QUANTITY_WEIGHTS).alias(
            "cantidad"
        ),
        (cents.cast("decimal(12,0)") / 100).cast("decimal(12,2)").alias("precio_unitario"),
    )


def with_controlled_errors(
    sales: DataFrame, rows: int, processing_date: date = PROCESSING_DATE
) -> DataFrame:
    """Break the last twenty sales in known ways.

    In order: four quantities and four prices of zero, three blank products, three unknown
    regions, three wrong categories, and sales one, two and three days in the future.
    """
    place = F.col("id_venta") - (rows - CONTROLLED_ERRORS)

    def broken(name: str, first: int, last: int, value: Column) -> Column:
        hit = (place >= first) & (place <= last)
        return F.when(hit, value).otherwise(F.col(name)).alias(name)

    return sales.select(
        "id_venta",
        broken("fecha_venta", 18, 20,
               F.date_add(F.lit(processing_date), (place - 17).cast("int"))),
        broken("producto", 9, 11, F.lit("")),
        broken("categoria", 15, 17, F.lit(WRONG_CATEGORY)),
        broken("region", 12, 14, F.lit(UNKNOWN_REGION)),
        broken("cantidad", 1, 4, F.lit(0)),
        broken("precio_unitario", 5, 8, F.lit(0).cast("decimal(12,2)")),
    )
