"""The daily batch: land, stage, evaluate, publish, audit, quarantine, reconcile.

What is staged, judged, rejected and published, the members that the dimensions gain and the
control row show together, or not at all. Running a batch again replaces everything it wrote.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleskeep.contract import ARTIFACT_CHECK_SCHEMA, ARTIFACT_SCHEMA, SCHEMA_VERSION
from saleskeep.frames import small_frame
from saleskeep.functions.clock import checked_batch_id, date_folder, instant, utc_now
from saleskeep.functions.parse import whole_number
from saleskeep.operators.audit import (
    batch_control,
    batch_summary,
    content_digest,
    files_digest,
    manifest,
    reconciliation,
    require_reconciled,
)
from saleskeep.operators.keys import next_key, numbered_by_place
from saleskeep.operators.quality import evaluate, prepare, rejects, valid_rows
from saleskeep.operators.warehouse import (
    DimensionKeys,
    fact_rows,
    id_aliases,
    keyed_facts,
    keyed_products,
    keyed_regions,
    new_dates,
    new_products,
    new_regions,
)
from saleskeep.plans.store import Store, Transaction
from saleskeep.sources.catalog import Catalogs
from saleskeep.sources.landing import is_finished, land_manifest, land_raw, quarantine_json, read_landed
from saleskeep.sources.sales import POSITION
from saleskeep.workspace import PACKED, Workspace

# Groups that number new members, whatever their number: it decides the keys.
KEY_BUCKETS = 4_096

Clock = Callable[[], datetime]


class BatchError(RuntimeError):
    """A batch that cannot be published."""


def extract_raw(
    store: Store, sales: DataFrame, batch_id: str, now: datetime, packing: dict[str, str] | None = None
) -> dict[str, Any]:
    """Land the source rows, packed as told, and their manifest; returns their places and the row count."""
    spark = store.spark
    folder = f"ventas/{date_folder(now)}/{batch_id}"
    raw_uri = f"{store.base}/raw/{folder}/ventas_origen.csv"
    land_raw(spark, sales, raw_uri, packing)
    landed = read_landed(spark, store.base, raw_uri)
    described = manifest(landed, batch_id, instant(now))
    facts = described.first()
    document = small_frame(spark, [facts], described.schema)
    manifest_uri = f"{store.base}/manifests/{folder}/manifest.json"
    land_manifest(spark, document, manifest_uri)
    digest = content_digest(document).first()
    _log_artifacts(
        store,
        batch_id,
        (batch_id, "raw", raw_uri, SCHEMA_VERSION, facts.sha256, facts.record_count),
        (batch_id, "manifest", manifest_uri, SCHEMA_VERSION, digest.sha256, digest.record_count),
    )
    return {
        "batch_id": batch_id,
        "date_prefix": date_folder(now),
        "extracted_count": facts.record_count,
        "raw_uri": raw_uri,
        "manifest_uri": manifest_uri,
    }


def _log_artifacts(store: Store, batch_id: str, *entries: tuple) -> None:
    """Record artifacts of a batch next to its others, with the digests of their files; a batch has
    three at most."""
    renewed = [entry[1] for entry in entries]
    entries = [(*entry, files_digest(store.spark, entry[2]).first().sha256) for entry in entries]
    with store.begin() as change:
        kept = change.read("artefactos", batch_id).filter(~F.col("artifact").isin(renewed)).collect()
        rows = small_frame(store.spark, [*kept, *entries], ARTIFACT_SCHEMA)
        change.replace_batch("artefactos", rows, batch_id)


def artifact_integrity(store: Store, batch_id: str) -> DataFrame:
    """The files of a batch's artifacts as they are now, against the log: (batch_id, artifact, uri,
    n_files, n_bytes, intact). An artifact whose folder is gone has no files and is not intact."""
    checked = []
    for entry in store.read("artefactos", batch_id).collect():
        found = (0, 0, None)
        if is_finished(store.spark, entry.uri):
            found = files_digest(store.spark, entry.uri).first()
        intact = found[2] == entry.files_sha256
        checked.append((entry.batch_id, entry.artifact, entry.uri, found[0], found[1], intact))
    return small_frame(store.spark, checked, ARTIFACT_CHECK_SCHEMA)


def staged(landed: DataFrame, batch_id: str, ingested_at: datetime) -> DataFrame:
    """Landed rows, read back with their positions, with their batch, ingestion time and row key:
    1, 2, ... in the order of files and of the rows in them, however they were split for reading."""
    return (
        numbered_by_place(landed, *POSITION, "raw_row_key")
        .withColumn("batch_id", F.lit(batch_id))
        .withColumn("ingestion_timestamp", instant(ingested_at))
    )


def stage_raw(store: Store | Transaction, batch_id: str, raw_uri: str, ingested_at: datetime) -> None:
    """Stage a landed batch. The row keys are fixed by being written here. Landed files never change
    and each is read by one task, so their places are the same when they are read for the shifts
    and for the rows."""
    landed = read_landed(store.spark, store.base, raw_uri, positions=True)
    store.replace_batch("stg_ventas_raw", staged(landed, batch_id, ingested_at), batch_id)


def process_batch(
    store: Store, batch_id: str, now: datetime, workspace: Workspace, strict: bool = True
) -> None:
    """Process a batch that is staged, all or nothing."""
    with store.begin() as change:
        process(change, batch_id, now, workspace, strict)


def process(
    change: Transaction, batch_id: str, now: datetime, workspace: Workspace, strict: bool = True
) -> None:
    """Judge a staged batch, grow the dimensions, publish the facts and write the control row."""
    catalogs = Catalogs.active(change.read("productos"), change.read("regiones"))
    prepared = prepare(change.read("stg_ventas_raw", batch_id), catalogs, workspace)
    change.replace_batch("stg_ventas_evaluadas", evaluate(prepared, strict), batch_id)

    evaluated = change.read("stg_ventas_evaluadas", batch_id)
    summary = workspace.keep(batch_summary(evaluated), "batch_summary")
    figures = summary.first()
    if figures is None:
        raise BatchError(f"batch {batch_id} has no staged rows")
    if figures.unusual_ids and not id_aliases(evaluated).isEmpty():
        raise BatchError(f"batch {batch_id} writes one sale id in several ways")

    # What an earlier run of the batch published is about to be replaced, and is no duplicate.
    change.clear_batch("fact_ventas", batch_id)
    change.replace_batch("dq_rechazos", rejects(evaluated, instant(now)), batch_id)
    valid = valid_rows(evaluated)
    grow_dimensions(change, valid, workspace)
    # Ids outside the batch's own range are no duplicates of it, whoever published them.
    published = change.published(figures.lowest_id, figures.highest_id)
    keys = DimensionKeys.measured(
        change.read("dim_fecha"), change.read("dim_producto"), change.read("dim_region")
    )
    facts = fact_rows(
        valid,
        published,
        keys,
        instant(now),
    )
    others = change.read("etl_control").filter(F.col("batch_id") != batch_id)
    facts = keyed_facts(workspace.keep(facts, "facts"), next_key(others, "ultima_venta_key"))
    # Sorted inside each file, so that reports on a span of dates skip row groups.
    change.replace_batch("fact_ventas", facts.sortWithinPartitions("fecha_key"), batch_id)
    control = batch_control(summary, change.read("fact_ventas", batch_id), instant(now))
    change.replace_batch("etl_control", control, batch_id)


def grow_dimensions(change: Transaction, valid: DataFrame, workspace: Workspace) -> None:
    """Append the members that valid rows bring and the dimensions lack."""
    dim_date, dim_product = change.read("dim_fecha"), change.read("dim_producto")
    dim_region = change.read("dim_region")
    products = keyed_products(
        new_products(valid, dim_product),
        next_key(dim_product, "producto_key"),
        KEY_BUCKETS,
    )
    regions = keyed_regions(
        new_regions(valid, dim_region),
        next_key(dim_region, "region_key"),
        KEY_BUCKETS,
    )
    for table, members in (
        ("dim_fecha", new_dates(valid, dim_date)),
        ("dim_producto", products),
        ("dim_region", regions),
    ):
        found = workspace.keep(members, table)
        if not found.isEmpty():
            change.append(table, found)


def export_quarantine(store: Store, batch_id: str, date_prefix: str) -> str:
    """Export the rejects of a batch; returns the place of the export."""
    path = f"{store.base}/quarantine/ventas/{date_prefix}/{batch_id}/rechazos.jsonl"
    rejected = store.read("dq_rechazos", batch_id)
    quarantine_json(store.spark, rejected, path)
    digest = content_digest(rejected.drop("fecha_rechazo")).first()
    entry = (batch_id, "quarantine", path, SCHEMA_VERSION, digest.sha256, digest.record_count)
    _log_artifacts(store, batch_id, entry)
    return path


def reconcile(store: Store, batch_id: str, extracted_count: int) -> dict[str, Any]:
    """Check a batch's counts and state; raises when they do not agree."""
    extracted = store.spark.range(1).select(
        F.lit(batch_id).alias("batch_id"), F.lit(extracted_count).alias("extracted_count")
    )
    return require_reconciled(reconciliation(store.read("etl_control", batch_id), extracted))


def only_new(store: Store, sales: DataFrame) -> DataFrame:
    """Sales that no earlier batch published: new ones, rejected ones that were mended since,
    and those whose id is blank or no number, which the quality rules then judge."""
    published = store.published().select(F.col("id_venta").alias("published_id"))
    number = whole_number(F.col("id_venta").cast("string"), "bigint")
    return sales.join(published, number == F.col("published_id"), "left_anti")


def run_daily_batch(
    store: Store,
    sales: DataFrame,
    batch_id: str | None = None,
    clock: Clock = utc_now,
    incremental: bool = False,
    strict: bool = True,
) -> dict[str, Any]:
    """Run one batch from the source rows to its reconciliation.

    By default every source row is extracted. Sales that earlier batches published are then
    skipped, and a batch that holds such sales ends as FAILED; ``incremental`` extracts only
    those not published yet. Rejects are exported before the reconciliation, so they
    survive its failure.
    """
    chosen = checked_batch_id(batch_id, clock())
    rows = only_new(store, sales) if incremental else sales
    raw = extract_raw(store, rows, chosen, clock())
    workspace = Workspace(store.spark, options=PACKED)
    try:
        with store.begin() as change:
            stage_raw(change, chosen, raw["raw_uri"], clock())
            process(change, chosen, clock(), workspace, strict)
    finally:
        workspace.drop()
    quarantine_uri = export_quarantine(store, chosen, raw["date_prefix"])
    figures = reconcile(store, chosen, raw["extracted_count"])
    return {**raw, **figures, "quarantine_uri": quarantine_uri}


def initialize(
    spark: SparkSession, base: str, products: DataFrame, regions: DataFrame
) -> Store:
    """A warehouse under a base folder, with its catalogs loaded."""
    store = Store(spark, base)
    store.start()
    with store.begin() as change:
        change.replace("productos", products)
        change.replace("regiones", regions)
    return store
