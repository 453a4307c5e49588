"""The data contract's rules, counted field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleskeep.contract import SOURCE_FIELDS
from saleskeep.functions.parse import dashed_date, plain_decimal, whole_number
from saleskeep.functions.text import filled
from saleskeep.operators.lookup import Lookup, lookup_join
from saleskeep.operators.quality import repeated_ids
from saleskeep.sources.catalog import Catalogs
from saleskeep.workspace import Workspace


def field_findings(
    rows: DataFrame, catalogs: Catalogs, processing_date: Column, workspace: Workspace
) -> DataFrame:
    """Per contract field: position, type, rows without a value, of another type, against the rule.

    ``rows`` are staged text rows and ``catalogs`` come from :meth:`Catalogs.exact`. A row
    without a value is not counted again under type or rule.

    No row meets a lookup: rows are counted per sale id, product, category and region, so that
    only keys and counts are shuffled and joined.
    """
    text = rows.select("raw_row_key", *(name for name, *_ in SOURCE_FIELDS))

    def typed(name: str, kind: str) -> Column:
        text = filled(F.col(name))
        if kind == "date":
            return dashed_date(text)
        if kind.startswith("decimal"):
            return plain_decimal(text, 12, 2)
        return text if kind == "string" else whole_number(text, kind)

    def unknown(name: str, lookup: Lookup, found: str) -> DataFrame:
        """The rows with a value that the catalog lacks."""
        key = filled(F.col(name)).alias(lookup.key)
        values = text.groupBy(key).agg(F.count("*").alias("n")).filter(F.col(lookup.key).isNotNull())
        matched = lookup_join(values, lookup, [lookup.key], weights=values)
        return matched.agg(F.coalesce(F.sum(F.when(F.col(found).isNull(), F.col("n"))), F.lit(0)))

    repeats = repeated_ids(text, filled(F.col("id_venta")), "_id").filter(F.col("_id").isNotNull())
    counted = {
        "unique": repeats.agg(F.coalesce(F.sum("n"), F.lit(0))),
        "known_product": unknown("producto", catalogs.products, "categoria_catalogo"),
        "known_category": unknown("categoria", catalogs.categories, "categoria_conocida"),
        "known_region": unknown("region", catalogs.regions, "region_conocida"),
    }
    broken = {
        "not_future": lambda value: value > processing_date,
        "greater_than_zero": lambda value: value <= 0,
    }
    counts = []
    for name, kind, _, rule in SOURCE_FIELDS:
        value, missing = typed(name, kind), filled(F.col(name)).isNull()
        counts += [
            F.count_if(missing).alias(f"{name}_missing"),
            F.count_if(~missing & value.isNull()).alias(f"{name}_mistyped"),
        ]
        if rule in broken:
            counts.append(F.count_if(~missing & broken[rule](value)).alias(f"{name}_broken"))
    totals = text.agg(*counts)
    for name, _, _, rule in SOURCE_FIELDS:
        if rule in counted:
            totals = totals.crossJoin(counted[rule].toDF(f"{name}_broken"))
    per_field = F.array(
        *(
            F.struct(
                F.lit(at).alias("position"),
                F.lit(name).alias("field"),
                F.lit(kind).alias("field_type"),
                F.lit(rule).alias("rule"),
                (F.col(f"{name}_missing") if not nullable else F.lit(0).cast("bigint")).alias(
                    "missing_rows"
                ),
                F.col(f"{name}_mistyped").alias("mistyped_rows"),
                F.col(f"{name}_broken").alias("rule_broken_rows"),
            )
            for at, (name, kind, nullable, rule) in enumerate(SOURCE_FIELDS, 1)
        )
    )
    return totals.select(F.explode(per_field).alias("f")).select("f.*")
