"""Report measures: cards, month-over-month change, regional share, ranking."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleskeep.operators.keys import ranked_desc
from saleskeep.operators.mart import MONEY, Mart
from saleskeep.workspace import Workspace

# The report's measures over totals of the mart, for any grouping of them. Published sale ids
# are unique, so counting sales is counting distinct ones.
MEASURES: dict[str, Callable[[], Column]] = {
    "total_ventas": lambda: F.sum("ventas_totales").cast(MONEY),
    "total_unidades": lambda: F.sum("unidades_vendidas"),
    "numero_ventas": lambda: F.coalesce(F.sum("numero_ventas"), F.lit(0)),
    "ticket_promedio": lambda: F.round(
        F.try_divide(F.sum("ventas_totales").cast("double"), F.sum("numero_ventas")), 6
    ),
}
# Ranges used to rank more products than one task should.
RANK_RANGES = 256


def kpi_cards(
    mart: Mart,
    years: Sequence[int] | None = None,
    categories: Sequence[str] | None = None,
    regions: Sequence[str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Total sales, units, number of sales and average ticket, within the chosen slices.

    One row, or one per value of ``by``. The average ticket is NULL when there are no sales.
    """
    rows = _sliced(mart, Mart.totals, years, categories, regions, by)
    return rows.groupBy(*by).agg(*(measure().alias(name) for name, measure in MEASURES.items()))


def distinct_sales(
    mart: Mart,
    years: Sequence[int] | None = None,
    categories: Sequence[str] | None = None,
    regions: Sequence[str] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """The number of different sale ids within the chosen slices, exact also where the fact holds
    an id twice. An id is shuffled once per task and slice that hold it, whatever its neighbours."""
    rows = _sliced(mart, Mart.sale_ids, years, categories, regions, by)
    return rows.groupBy(*by).agg(F.count_distinct("id_venta").alias("numero_ventas_distintas"))


def _sliced(
    mart: Mart,
    read: Callable[..., DataFrame],
    years: Sequence[int] | None,
    categories: Sequence[str] | None,
    regions: Sequence[str] | None,
    by: Sequence[str],
) -> DataFrame:
    """What ``read`` gives of the mart per value of ``by``, within the chosen slices."""
    if years is not None:
        mart = mart.in_years(years)
    slices = {"categoria": categories, "region": regions}
    chosen = {column: values for column, values in slices.items() if values is not None}
    rows = read(mart, *dict.fromkeys((*chosen, *by)))
    for column, values in chosen.items():
        rows = rows.filter(F.col(column).isin(list(values)))
    return rows


def month_over_month(mart: Mart, *by: str) -> DataFrame:
    """Monthly sales, those of the calendar month before, and the change in percent.

    The previous month is NULL when it had no sales. The window runs over monthly totals: at
    most twelve rows a year per value of ``by``.
    """
    month_index = F.col("anio") * 12 + F.col("mes")
    previous_month = Window.partitionBy(*by).orderBy("_month").rangeBetween(-1, -1)
    sales, before = F.col("ventas_totales"), F.col("ventas_mes_anterior")
    change = F.try_divide((sales - before).cast("double"), before.cast("double"))
    return (
        mart.totals("anio", "mes", *by)
        .withColumn("_month", month_index)
        .withColumn("ventas_mes_anterior", F.sum("ventas_totales").over(previous_month).cast(MONEY))
        .withColumn("variacion_mom", F.round(change, 6))
        .select("anio", "mes", *by, "ventas_totales", "ventas_mes_anterior", "variacion_mom")
    )


def regional_share(mart: Mart, *by: str) -> DataFrame:
    """Each region's part of the total over all regions, within every other grouping column."""
    totals = mart.totals(*by, "region")
    total = F.sum("ventas_totales")
    all_regions = total.over(Window.partitionBy(*by)) if by else totals.agg(total).scalar()
    share = F.try_divide(F.col("ventas_totales").cast("double"), all_regions.cast("double"))
    return (
        totals
        .withColumn("participacion_regional", F.round(share, 6))
        .select(*by, "region", "ventas_totales", "participacion_regional")
    )


def product_ranking(mart: Mart, buckets: int | None = None) -> DataFrame:
    """Products by sales, largest first; equal sales share a rank."""
    if buckets is None:
        buckets = 1 if mart.products.fits else RANK_RANGES
    totals = mart.totals("producto").select("producto", "ventas_totales", "unidades_vendidas")
    if buckets > 1:  # read once per step of the ranking
        totals = Workspace(totals.sparkSession).keep(totals, "totals")
    return ranked_desc(totals, "ventas_totales", "posicion", ["producto"], buckets)
