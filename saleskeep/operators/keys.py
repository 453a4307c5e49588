"""Surrogate keys and ranks without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleskeep.operators.lookup import Lookup, lookup_join


def next_key(table: DataFrame, key: str) -> int:
    """Largest key in use, 0 for an empty table."""
    return table.agg(F.max(key)).first()[0] or 0


def numbered(
    df: DataFrame, order: Column, name: str, start: int = 0, buckets: int = 1
) -> DataFrame:
    """Number the rows start+1, start+2, ... without gaps.

    ``order`` must differ on every row. With one bucket the numbers follow it; with more, rows
    go to buckets by a hash of it, each bucket is numbered on its own and shifted by the sizes
    of the buckets before it. The numbers depend on the rows alone, not on how they were
    partitioned.
    """
    if buckets == 1:
        number = F.row_number().over(Window.orderBy(order))
        return df.withColumn(name, F.lit(start) + number)
    bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(order), F.lit(buckets)))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    # One row per bucket: the window below sees no more rows than there are buckets.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(order))
    return (
        bucketed.withColumn("_within", within)
        .join(F.broadcast(shifts), "_bucket")
        .withColumn(name, F.lit(start) + F.col("_shift") + F.col("_within"))
        .drop("_bucket", "_within", "_shift")
    )


#: Values of a whole-number order that one task numbers.
SPAN = 1_000_000


def numbered_in_order(
    df: DataFrame, order: str, name: str, start: int = 0, span: int = SPAN
) -> DataFrame:
    """Number the rows start+1, start+2, ... without gaps, in the order of a whole number that
    differs on every row.

    The numbers are cut into spans; each is numbered on its own and shifted by the rows of the
    spans before it, so no task sees more than ``span`` rows, and the shifts have a row per span.
    ``df`` is read twice and has to be a written table.
    """
    ranged = df.withColumn("_span", F.floor(F.col(order) / span))
    shifts = _shifts(ranged.groupBy("_span").agg(F.count("*").alias("_size")), "_span")
    within = F.row_number().over(Window.partitionBy("_span").orderBy(order))
    return (
        ranged.withColumn("_within", within)
        .join(F.broadcast(shifts), "_span")
        .withColumn(name, F.lit(start) + F.col("_shift") + F.col("_within"))
        .drop("_span", "_within", "_shift")
    )


def numbered_by_place(df: DataFrame, file: str, block: str, place: str, name: str) -> DataFrame:
    """Number the rows 1, 2, ... by file, block and place, where the places in a block follow each
    other. Nothing is shuffled: the shifts have a row per block. ``df`` is read twice and has to give
    the same places within a block each time."""
    blocks = df.groupBy(file, block).agg(F.count("*").alias("_size"), F.min(place).alias("_first"))
    shifts = _shifts(blocks, file, block)
    return (
        df.join(F.broadcast(shifts), [file, block])
        .withColumn(name, F.col("_shift") + F.col(place) - F.col("_first") + 1)
        .drop(file, block, place, "_first", "_shift")
    )


def _shifts(sizes: DataFrame, *order: str) -> DataFrame:
    """The rows before each group: one window over a row per group."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_shift", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")


def ranked_desc(
    df: DataFrame, value: str, name: str, spread: list[str], buckets: int = 1
) -> DataFrame:
    """Standard competition rank (ties share a rank, then a gap) by a value, largest first.

    With one bucket this is a plain window. With more, equal values are counted first, so a
    tie of any length is one row; the distinct values are cut into ranges at approximate
    quantiles, ranked inside each range, and shifted by the rows in the ranges above. The cuts
    only place the work: any cuts give the same ranks.
    """
    if buckets == 1:
        rank = F.rank().over(Window.orderBy(F.desc(value)))
        return df.withColumn(name, rank.cast("bigint"))
    values = df.groupBy(value).agg(F.count("*").alias("_ties"))
    shares = [part / buckets for part in range(1, buckets)]
    approx = values.select(F.col(value).cast("double").alias("v"))
    cuts = sorted(set(approx.approxQuantile("v", shares, 1 / (4 * buckets))))
    cut_list = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<double>")
    below = F.size(F.filter(cut_list, lambda cut: cut < F.col(value).cast("double")))
    ranged = values.withColumn("_range", below)
    sizes = ranged.groupBy("_range").agg(F.sum("_ties").alias("_size"))
    above = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(above), F.lit(0)).alias("_shift")
    )
    larger = (
        Window.partitionBy("_range")
        .orderBy(F.desc(value))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        ranged.withColumn("_larger", F.coalesce(F.sum("_ties").over(larger), F.lit(0)))
        .join(F.broadcast(shifts), "_range")
        .select(value, (F.col("_shift") + F.col("_larger") + 1).cast("bigint").alias(name))
    )
    weights = values.withColumnRenamed("_ties", "n")
    return lookup_join(df, Lookup(ranks, value, fits=False), spread, weights=weights)
