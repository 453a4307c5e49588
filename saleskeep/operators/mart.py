"""The published star schema and the aggregates over it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleskeep.contract import FLAT_COLUMNS
from saleskeep.operators.lookup import Lookup, lookup_join

MONEY = "decimal(38,2)"
# Columns each dimension gives to the flat view.
DATE_COLUMNS = ("fecha", "mes", "nombre_mes", "trimestre", "anio")
PRODUCT_COLUMNS = ("producto", "categoria")
REGION_COLUMNS = ("region",)


@dataclass(frozen=True)
class Mart:
    """A fact table and its dimensions, sizes already measured.

    A dimension is joined only when one of its columns is asked for: every fact row has
    exactly one row in each dimension, so a join that adds no column changes nothing.
    """

    fact: DataFrame
    dates: Lookup
    products: Lookup
    regions: Lookup

    @classmethod
    def measured(
        cls, fact: DataFrame, dim_date: DataFrame, dim_product: DataFrame, dim_region: DataFrame
    ) -> Mart:
        return cls(
            fact,
            Lookup.measured(dim_date, "fecha_key"),
            Lookup.measured(dim_product, "producto_key"),
            Lookup.measured(dim_region, "region_key"),
        )

    def _needed(self, columns: tuple[str, ...]) -> list[Lookup]:
        """Dimensions that supply some of the columns, cut down to those columns."""
        sources = (
            (self.dates, DATE_COLUMNS),
            (self.products, PRODUCT_COLUMNS),
            (self.regions, REGION_COLUMNS),
        )
        needed = []
        for dimension, supplied in sources:
            wanted = [column for column in supplied if column in columns]
            if wanted:
                part = dimension.df.select(dimension.key, *wanted)
                needed.append(Lookup(part, dimension.key, dimension.fits))
        return needed

    def flat(self, *columns: str) -> DataFrame:
        """The flat sales view, or the given columns of it."""
        wanted = columns or FLAT_COLUMNS
        rows = self.fact
        for dimension in self._needed(wanted):
            rows = lookup_join(rows, dimension, ["id_venta"], "inner", counted=self.fact)
        return rows.select(*wanted)

    def in_years(self, years: Sequence[int]) -> Mart:
        """The mart with the sales of some years only.

        Date keys read yyyymmdd, so a year is a range of them: the scan skips what lies
        outside and no join is needed.
        """
        ranges = [
            F.col("fecha_key").between(year * 10_000 + 101, year * 10_000 + 1231)
            for year in years
        ]
        fact = self.fact.filter(reduce(or_, ranges, F.lit(False)))
        return Mart(fact, self.dates, self.products, self.regions)

    def totals(self, *by: str) -> DataFrame:
        """Amount, units and number of sales per value of the ``by`` columns.

        Small dimensions are joined first, inside the scan. A dimension too large for that is
        joined after the fact has been summed per surrogate key, when no key is hot any more.
        The number of sales is a plain count: a published sale id is unique.
        """
        needed = self._needed(by)
        rows = self.fact
        for dimension in needed:
            if dimension.fits:
                rows = rows.join(F.broadcast(dimension.df), dimension.key)
        large = [dimension for dimension in needed if not dimension.fits]
        late = {column for dimension in large for column in dimension.df.columns}
        early = [column for column in by if column not in late]
        sums = rows.groupBy(*early, *(dimension.key for dimension in large)).agg(
            F.sum("total_venta").cast(MONEY).alias("ventas_totales"),
            F.sum("cantidad").alias("unidades_vendidas"),
            F.count("*").alias("numero_ventas"),
        )
        if not large:
            return sums
        for dimension in large:
            sums = sums.join(dimension.df, dimension.key)
        return add_up(sums, *by)

    def sale_ids(self, *by: str) -> DataFrame:
        """The sale ids with the ``by`` columns."""
        return self.flat("id_venta", *by)


def add_up(sums: DataFrame, *by: str) -> DataFrame:
    """Coarser totals from finer ones."""
    return sums.groupBy(*by).agg(
        F.sum("ventas_totales").cast(MONEY).alias("ventas_totales"),
        F.sum("unidades_vendidas").alias("unidades_vendidas"),
        F.sum("numero_ventas").alias("numero_ventas"),
    )
