"""Warehouse quality rules: one verdict per staged row decides what is published."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleskeep.contract import EVALUATED_SCHEMA, SOURCE_COLUMNS
from saleskeep.functions.clock import after_business_day
from saleskeep.functions.parse import dashed_date, plain_decimal, whole_number
from saleskeep.functions.text import filled, match_key
from saleskeep.operators.lookup import Lookup, lookup_join
from saleskeep.sources.catalog import Catalogs
from saleskeep.workspace import Workspace

LINE_TOTAL = "decimal(14,2)"
RULES = tuple(f"DQ-{number:03d}" for number in range(1, 9))


def repeated_ids(rows: DataFrame, key: Column, name: str) -> DataFrame:
    """Ids on more than one row: how many rows, and the key of the first.

    Counting combines rows before the shuffle, so an id (blank ids, say) that fills a third of
    the table costs one row per task.
    """
    return (
        rows.groupBy(key.alias(name))
        .agg(F.count("*").alias("n"), F.min("raw_row_key").alias("first_row_key"))
        .filter(F.col("n") > 1)
    )


def with_repeats(
    rows: DataFrame, key: Column, name: str, workspace: Workspace, counted: DataFrame | None = None
) -> DataFrame:
    """Add ``n`` and ``first_row_key`` of each row's id group, NULL for ids that occur once.
    Where ``rows`` are the result of joins, ``counted`` holds the same row keys and ids.

    The repeated ids are written first. They are few in ordinary batches and then a measured
    broadcast leaves the wide rows where they are; otherwise the join is shuffled and salted.
    """
    repeats = workspace.keep(repeated_ids(rows if counted is None else counted, key, name), "repeated_ids")
    lookup = Lookup.measured(repeats, name)
    weights = repeats.select(name, "n")
    return lookup_join(rows.withColumn(name, key), lookup, ["raw_row_key"], weights=weights)


def prepare(staged: DataFrame, catalogs: Catalogs, workspace: Workspace) -> DataFrame:
    """Typed columns, duplicate count and catalog matches next to the staged text.

    Staged text is never NULL (the readers fill blanks), yet NULL ids and NULL categories are
    honoured: NULL ids form one group, a NULL category cannot contradict the product.
    """
    id_key = match_key(F.col("id_venta"))
    counted = with_repeats(staged, F.coalesce(id_key, F.lit("\0")), "_id", workspace)
    rows = counted.select(*staged.columns, F.coalesce("n", F.lit(1)).cast("bigint").alias("id_count"))
    # What is made of a row's text is made behind the joins: a shuffle moves the text alone.
    return with_catalogs(rows, staged, catalogs, match_key).withColumns({
        "id_typed": whole_number(F.trim("id_venta"), "bigint"),
        "fecha_typed": dashed_date(F.trim("fecha_venta")),
        "cantidad_typed": whole_number(F.trim("cantidad"), "int"),
        "precio_typed": plain_decimal(F.trim("precio_unitario"), 12, 2),
    })


def with_catalogs(
    rows: DataFrame, counted: DataFrame, catalogs: Catalogs, clean: Callable[[Column], Column]
) -> DataFrame:
    """Add the three catalog keys of text rows, cleaned in the dialect's way, and their matches;
    ``counted`` holds the same text, read cheaply."""
    for name, lookup in (
        ("producto", catalogs.products), ("region", catalogs.regions), ("categoria", catalogs.categories)
    ):
        key = clean(F.col(name)).alias(lookup.key)
        rows = lookup_join(rows.select("*", key), lookup, ["raw_row_key"], counted=counted.select(key))
    return rows


def rule_failures() -> dict[str, Column]:
    """Failure condition of each rule over prepared rows, in code order."""
    blank = [filled(F.col(name)).isNull() for name in ("producto", "categoria", "region")]
    return dict(
        zip(
            RULES,
            (
                F.col("id_typed").isNull(),
                F.col("id_count") > 1,
                F.col("fecha_typed").isNull()
                | after_business_day(F.col("fecha_typed"), F.col("ingestion_timestamp")),
                blank[0] | blank[1] | blank[2],
                F.col("cantidad_typed").isNull() | (F.col("cantidad_typed") <= 0),
                F.col("precio_typed").isNull() | (F.col("precio_typed") <= 0),
                F.col("producto_catalogo").isNull()
                | F.col("region_catalogo").isNull()
                | F.col("categoria_conocida").isNull(),
                F.col("producto_catalogo").isNotNull()
                & (F.lower("categoria_catalogo") != F.col("_categoria")),
            ),
        )
    )


def evaluate(prepared: DataFrame, strict: bool = True) -> DataFrame:
    """Clean columns, line total, failed rules and verdict of every row.

    ``dq_errors`` holds the failed codes, each followed by a comma. A line total too large for
    its column fails the batch; with ``strict`` off it becomes NULL.
    """
    errors = F.concat(
        *(F.when(failed, F.lit(f"{code},")).otherwise("") for code, failed in rule_failures().items())
    )
    total = F.col("cantidad_typed") * F.col("precio_typed")
    line_total = total.try_cast(LINE_TOTAL)
    if strict:
        too_large = F.raise_error(F.lit(f"a line total does not fit {LINE_TOTAL}"))
        line_total = F.coalesce(
            line_total, F.when(total.isNotNull(), too_large.cast(LINE_TOTAL))
        )
    # What has been read already need not be parsed again.
    money = "decimal(18,2)"
    quantity = F.coalesce(
        F.col("cantidad_typed").cast(money), plain_decimal(F.col("cantidad"), 18, 2)
    )
    price = F.coalesce(
        F.col("precio_typed").cast(money), plain_decimal(F.col("precio_unitario"), 18, 2)
    )
    judged = prepared.withColumn("dq_errors", errors)
    valid = F.col("dq_errors") == ""
    original = F.struct(*SOURCE_COLUMNS)
    columns = {
        "raw_row_key": F.col("raw_row_key"),
        "id_venta": F.col("id_typed"),
        "fecha_venta": F.col("fecha_typed"),
        "producto": filled(F.col("producto")),
        "categoria": filled(F.col("categoria")),
        "region": filled(F.col("region")),
        "cantidad": F.col("cantidad_typed"),
        "precio_unitario": F.col("precio_typed"),
        "total_venta": line_total,
        "batch_id": F.col("batch_id"),
        "ingestion_timestamp": F.col("ingestion_timestamp"),
        "dq_errors": F.col("dq_errors"),
        "es_valido": valid,
        "original": F.when(~valid, original),
        "importe_fila": (quantity * price).cast("decimal(37,4)"),
        "id_usual": F.trim("id_venta") == F.col("id_typed").cast("string"),
    }
    return judged.select(*(columns[name].alias(name) for name in EVALUATED_SCHEMA.names))


def error_codes(errors: Column) -> Column:
    """The failed codes as an array."""
    return F.filter(F.split(errors, ","), lambda code: code != "")


def valid_rows(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter("es_valido")


def rejects(evaluated: DataFrame, rejected_at: Column) -> DataFrame:
    """Invalid rows with their text as it came in and the rules they broke.

    The reject key is the key of the raw row, so a repeated batch writes the same keys.
    """
    return evaluated.filter("NOT es_valido").select(
        F.col("raw_row_key").alias("rechazo_key"),
        "batch_id",
        "raw_row_key",
        F.col("original.id_venta").alias("id_venta_original"),
        F.col("original.fecha_venta").alias("fecha_venta_original"),
        F.col("original.producto").alias("producto_original"),
        F.col("original.categoria").alias("categoria_original"),
        F.col("original.region").alias("region_original"),
        F.col("original.cantidad").alias("cantidad_original"),
        F.col("original.precio_unitario").alias("precio_original"),
        F.col("dq_errors").alias("reglas_incumplidas"),
        rejected_at.alias("fecha_rechazo"),
    )


def rule_counts(evaluated: DataFrame) -> DataFrame:
    """Rows that broke each rule; rules nobody broke do not appear.

    Rows are counted per combination of codes first, of which there are at most 2^8.
    """
    combinations = evaluated.groupBy("dq_errors").agg(F.count("*").alias("n"))
    codes = combinations.select(F.explode(error_codes(F.col("dq_errors"))).alias("code"), "n")
    return codes.groupBy("code").agg(F.sum("n").alias("failed_rows"))
