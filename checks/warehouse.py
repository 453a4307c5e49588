"""A warehouse over the given tables, built once per session and input.

Two batches run through it. The first is an earlier extract, sales up to a day; the second
extracts every sale, so it meets sales that the first has published.
"""

from __future__ import annotations

from datetime import UTC, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables
from saleskeep.operators.mart import Mart
from saleskeep.plans.batch import extract_raw, initialize, process_batch, stage_raw
from saleskeep.plans.store import Store
from saleskeep.sources.catalog import Catalogs
from saleskeep.workspace import PACKED, PACKED_TEXT, Workspace

FIRST_BATCH = "BATCH-20260831-070000"
BATCH = "BATCH-20260901-070000"
CLOCK = datetime(2026, 9, 1, 12, 0, tzinfo=UTC)
CLOCKS = {FIRST_BATCH: datetime(2026, 8, 31, 12, 0, tzinfo=UTC), BATCH: CLOCK}
FIRST_BATCH_UNTIL = "1996-12-31"


class Warehouse:
    """Each step is taken when a query first needs its result."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.workspace, self._source = (Workspace(spark, options=PACKED) for _ in range(2))
        self._landed: dict[str, dict] = {}
        self._staged: set[str] = set()

    @cached_property
    def store(self) -> Store:
        """The store with its catalogs and access grants, whatever batches it holds."""
        base = f"{self.workspace.folder}/warehouse"
        products = tables.products(self.spark, self.sf_dir)
        store = initialize(self.spark, base, products, tables.regions(self.spark, self.sf_dir))
        store.replace("usuario_region", tables.access(self.spark, self.sf_dir))
        return store

    @cached_property
    def sales(self) -> DataFrame:
        return self._source.keep(tables.faulty_sales(self.spark, self.sf_dir), "sales")

    def landed(self, batch_id: str) -> dict:
        """Where a batch was landed, and its row count."""
        if batch_id not in self._landed:
            rows = self.sales
            if batch_id == FIRST_BATCH:
                rows = rows.filter(F.col("fecha_venta") <= FIRST_BATCH_UNTIL)
            self._landed[batch_id] = extract_raw(self.store, rows, batch_id, CLOCKS[batch_id], PACKED_TEXT)
            if len(self._landed) == len(CLOCKS):  # nothing else reads the sales
                del self.sales
                self._source.drop()
        return self._landed[batch_id]

    def staged(self, batch_id: str = BATCH) -> DataFrame:
        if batch_id not in self._staged:
            stage_raw(self.store, batch_id, self.landed(batch_id)["raw_uri"], CLOCKS[batch_id])
            self._staged.add(batch_id)
        return self.store.read("stg_ventas_raw", batch_id)

    @cached_property
    def done(self) -> Store:
        """The store after both batches."""
        for batch_id, clock in CLOCKS.items():
            self.staged(batch_id)
            workspace = Workspace(self.spark, options=PACKED)
            process_batch(self.store, batch_id, clock, workspace)
            workspace.drop()
        return self.store

    def evaluated(self, batch_id: str = BATCH) -> DataFrame:
        return self.done.read("stg_ventas_evaluadas", batch_id)

    @cached_property
    def mart(self) -> Mart:
        return self.done.mart()

    @cached_property
    def catalogs(self) -> Catalogs:
        return Catalogs.active(self.store.read("productos"), self.store.read("regiones"))

    @cached_property
    def exact_catalogs(self) -> Catalogs:
        return Catalogs.exact(self.store.read("productos"), self.store.read("regiones"))


_built: dict[tuple, Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of these inputs, built again when the session or a file has changed."""
    session = (spark.sparkContext.applicationId, sf_dir)
    key = (*session, *tables.fingerprint(spark, sf_dir))
    if key not in _built:
        for stale in [k for k in _built if k[:2] == session or k[0] != session[0]]:
            del _built[stale]
        _built[key] = Warehouse(spark, sf_dir)
    return _built[key]
