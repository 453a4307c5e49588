"""The seven named views of the warehouse, as SQL that reads the log.

Spark keeps a view's text and plans it anew for each query, so a view always shows the last
version, whoever wrote it, also in a session that registered it before. The folders of a table are
joined with the few rows of the log that name them, so the scan leaves out all others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from saleskeep.contract import CONTROL_COLUMNS, FLAT_COLUMNS
from saleskeep.plans.store import BATCH_TABLES, TABLES, Store

View = Callable[[Store], str]


def _quoted(path: str) -> str:
    return "`" + path.replace("`", "``") + "`"


def live_rows(store: Store, table: str) -> str:
    """SQL for the rows of a table as the log's last version has it."""
    kinds = TABLES[table].names
    columns = ", ".join(f"named.{name}" if name == "batch_id" and table in BATCH_TABLES else f"rows.{name}" for name in kinds)
    return f"""
SELECT /*+ BROADCAST(named) */ {columns}
FROM parquet.{_quoted(store.path(table))} AS rows
JOIN (SELECT batch_id, commit
      FROM (SELECT *, max(CASE WHEN action = 'replace' THEN version ELSE 0 END)
              OVER (PARTITION BY batch_id) AS since
            FROM json.{_quoted(store.log.folder)} WHERE `table` = '{table}')
      WHERE version >= since AND commit IS NOT NULL) AS named
ON rows.commit = named.commit"""


def _plain(table: str, columns: str = "*", condition: str = "true") -> View:
    return lambda store: f"SELECT {columns} FROM ({live_rows(store, table)}) WHERE {condition}"


def _flat(store: Store) -> str:
    return f"""
SELECT {', '.join(FLAT_COLUMNS)} FROM ({live_rows(store, 'fact_ventas')})
JOIN ({live_rows(store, 'dim_fecha')}) USING (fecha_key)
JOIN ({live_rows(store, 'dim_producto')}) USING (producto_key)
JOIN ({live_rows(store, 'dim_region')}) USING (region_key)"""


def _permitted(store: Store) -> str:
    return f"""
SELECT usuario_correo, region_key
FROM ({live_rows(store, 'usuario_region')}) AS access
JOIN ({live_rows(store, 'dim_region')}) AS regions ON lower(access.region) = lower(regions.region)
WHERE access.activo AND regions.vigente"""


# Reports should read nothing else.
VIEWS: dict[str, View] = {
    "vw_ventas_analiticas": _flat,
    "vw_fact_ventas": _plain("fact_ventas"),
    "vw_dim_fecha": _plain("dim_fecha"),
    "vw_dim_producto": _plain("dim_producto", "producto_key, producto, categoria", "vigente"),
    "vw_dim_region": _plain("dim_region", "region_key, region", "vigente"),
    "vw_usuario_region": _permitted,
    "vw_control_etl": _plain("etl_control", ", ".join(CONTROL_COLUMNS)),
}


def view(store: Store, name: str) -> DataFrame:
    return store.spark.sql(VIEWS[name](store))


def register_views(store: Store) -> list[str]:
    """Register the views for SQL in the session; returns their names."""
    for name, text in VIEWS.items():
        store.spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {text(store)}")
    return list(VIEWS)
