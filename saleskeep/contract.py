"""Schemas of every table and the data contract of the source.

Column names, types and rules are fixed values: they are the interface that existing
queries and reports rely on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CONTRACT_NAME = "ventas_origen"
SCHEMA_VERSION = "1.0"
SOURCE_SYSTEM = "VENTAS_OLTP"

# Name, type, nullable, rule of each source field, in order.
SOURCE_FIELDS = (
    ("id_venta", "bigint", False, "unique"),
    ("fecha_venta", "date", False, "not_future"),
    ("producto", "string", False, "known_product"),
    ("categoria", "string", False, "known_category"),
    ("region", "string", False, "known_region"),
    ("cantidad", "int", False, "greater_than_zero"),
    ("precio_unitario", "decimal(12,2)", False, "greater_than_zero"),
)
SOURCE_COLUMNS = tuple(name for name, _, _, _ in SOURCE_FIELDS)


_KINDS = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(12,2)": T.DecimalType(12, 2),
    "decimal(14,2)": T.DecimalType(14, 2),
    "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(38,2)": T.DecimalType(38, 2),
    "decimal(37,4)": T.DecimalType(37, 4),
}


def _schema(columns: str, **nested: T.StructType) -> T.StructType:
    """Schema from "name kind, ..."; works without a session, unlike parsing DDL."""
    schema = T.StructType()
    for name, kind in (column.split() for column in columns.split(", ")):
        schema.add(name, nested.get(kind) or _KINDS[kind])
    return schema


SALES_SCHEMA = _schema(", ".join(f"{name} {kind}" for name, kind, _, _ in SOURCE_FIELDS))
SALES_TEXT_SCHEMA = _schema(", ".join(f"{name} string" for name in SOURCE_COLUMNS))

PRODUCT_CATALOG_SCHEMA = _schema("producto string, categoria string, activo boolean")
REGION_CATALOG_SCHEMA = _schema("region string, activo boolean")

STAGED_SCHEMA = _schema(
    "raw_row_key bigint, id_venta string, fecha_venta string, producto string, "
    "categoria string, region string, cantidad string, precio_unitario string, "
    "batch_id string, ingestion_timestamp timestamp_ntz"
)

# The thirteen columns of the evaluated table, then what later steps need from the raw text:
# the raw values of invalid rows, the amount as it came in, and whether the id was written
# the usual way. Keeping them saves joining the raw rows again.
EVALUATED_SCHEMA = _schema(
    "raw_row_key bigint, id_venta bigint, fecha_venta date, producto string, categoria string, "
    "region string, cantidad int, precio_unitario decimal(12,2), total_venta decimal(14,2), "
    "batch_id string, ingestion_timestamp timestamp_ntz, dq_errors string, es_valido boolean, "
    "original sale, importe_fila decimal(37,4), id_usual boolean",
    sale=SALES_TEXT_SCHEMA,
)
EVALUATED_COLUMNS = tuple(EVALUATED_SCHEMA.names[:13])

REJECTS_SCHEMA = _schema(
    "rechazo_key bigint, batch_id string, raw_row_key bigint, id_venta_original string, "
    "fecha_venta_original string, producto_original string, categoria_original string, "
    "region_original string, cantidad_original string, precio_original string, "
    "reglas_incumplidas string, fecha_rechazo timestamp_ntz"
)
CONTROL_SCHEMA = _schema(
    "batch_id string, fecha_inicio timestamp_ntz, fecha_fin timestamp_ntz, "
    "registros_origen bigint, registros_validos bigint, registros_rechazados bigint, "
    "registros_publicados bigint, importe_origen decimal(38,2), "
    "importe_publicado decimal(38,2), estado string, registros_ya_publicados bigint, "
    "ultima_venta_key bigint, id_minimo bigint, id_maximo bigint"
)
# The last four control columns are additions: valid rows that an earlier batch had published,
# the largest fact key of the batch, and the range of the sale ids it published.
CONTROL_COLUMNS = tuple(CONTROL_SCHEMA.names[:10])

DIM_DATE_SCHEMA = _schema(
    "fecha_key int, fecha date, dia int, mes int, nombre_mes string, trimestre int, anio int"
)
DIM_PRODUCT_SCHEMA = _schema(
    "producto_key bigint, producto string, categoria string, vigente boolean"
)
DIM_REGION_SCHEMA = _schema("region_key int, region string, vigente boolean")
FACT_SCHEMA = _schema(
    "venta_key bigint, id_venta bigint, fecha_key int, producto_key bigint, region_key int, "
    "cantidad int, precio_unitario decimal(12,2), total_venta decimal(14,2), batch_id string, "
    "fecha_carga timestamp_ntz"
)
ACCESS_SCHEMA = _schema("usuario_correo string, region string, activo boolean")
ARTIFACT_SCHEMA = _schema(
    "batch_id string, artifact string, uri string, schema_version string, sha256 string, "
    "record_count bigint, files_sha256 string"
)
ARTIFACT_CHECK_SCHEMA = _schema(
    "batch_id string, artifact string, uri string, n_files bigint, n_bytes bigint, intact boolean"
)

FLAT_COLUMNS = (
    "id_venta", "fecha", "mes", "nombre_mes", "trimestre", "anio", "producto", "categoria",
    "region", "cantidad", "precio_unitario", "total_venta", "batch_id", "fecha_carga",
)


def schema_findings(df: DataFrame) -> list[str]:
    """Differences between a frame's columns and the contract: names, order and types."""
    found = [(field.name, field.dataType.simpleString()) for field in df.schema.fields]
    expected = [(name, kind) for name, kind, _, _ in SOURCE_FIELDS]
    findings = [
        f"column {at + 1}: expected {want[0]} {want[1]}, found {have[0]} {have[1]}"
        for at, (want, have) in enumerate(zip(expected, found))
        if want != have
    ]
    findings += [f"missing column {name} {kind}" for name, kind in expected[len(found):]]
    findings += [f"unexpected column {name} {kind}" for name, kind in found[len(expected):]]
    return findings
