"""Row-level access by region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleskeep.operators.lookup import Lookup, lookup_join
from saleskeep.operators.mart import Mart


def permitted_regions(access: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Region keys each user may see: active grants on current regions."""
    regions = dim_region.filter("vigente").select(
        F.lower("region").alias("_region"), "region_key"
    )
    grants = access.filter("activo").withColumn("_region", F.lower("region"))
    joined = lookup_join(
        grants, Lookup.measured(regions, "_region"), ["usuario_correo"], "inner"
    )
    return joined.select("usuario_correo", "region_key")


def visible_sales(mart: Mart, permitted: DataFrame, user: str | None) -> Mart:
    """The mart as a user sees it, its regions and the sales in them; ``None`` stands for the
    role without restriction.

    The user's keys are measured themselves: few are broadcast, many meet the salted fact.
    """
    if user is None:
        return mart
    granted = permitted.filter(F.col("usuario_correo") == user).select("region_key").distinct()
    keys = Lookup.measured(granted, "region_key")
    fact = lookup_join(mart.fact, keys, ["id_venta"], "inner").select(*mart.fact.columns)
    regions = mart.regions.df.join(granted, "region_key", "left_semi")
    return Mart(fact, mart.dates, mart.products, Lookup(regions, "region_key", mart.regions.fits))
