"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables
from checks.warehouse import BATCH, CLOCK, FIRST_BATCH, Warehouse, warehouse
from saleskeep.contract import CONTROL_COLUMNS, EVALUATED_COLUMNS, SOURCE_COLUMNS
from saleskeep.functions.clock import batch_id_of, batch_instant, instant, is_batch_id
from saleskeep.operators import audit, integrity, issues, measures, olap, quality
from saleskeep.operators import warehouse as star
from saleskeep.operators.contract_checks import field_findings
from saleskeep.operators.mart import Mart
from saleskeep.operators.security import permitted_regions, visible_sales
from saleskeep.plans import store as stores
from saleskeep.plans.batch import artifact_integrity as check_artifacts
from saleskeep.plans.batch import initialize, run_daily_batch
from saleskeep.plans.views import view as warehouse_view
from saleskeep.sources import catalog, landing
from saleskeep.sources import sales as source
from saleskeep.sources.split_csv import read_split_csv
from saleskeep.workspace import PACKED, PACKED_TEXT, Workspace

Query = Callable[[SparkSession, str], DataFrame]

# Row and surrogate keys depend on file layout and are compared through other queries.
LAYOUT_KEYS = ("raw_row_key", "rechazo_key", "venta_key", "producto_key", "region_key")


def on_warehouse(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(warehouse(spark, sf_dir))


# Source and staging


def scan_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.sales(spark, sf_dir)


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Workspace(spark).path("csv")
    source.write_csv(tables.sales(spark, sf_dir), path)
    return source.read_csv(spark, path)


def replace_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the source table twice from CSV; the second load replaces the first."""
    workspace = Workspace(spark)
    sales, path, table = tables.sales(spark, sf_dir), workspace.path("csv"), workspace.path("t")
    source.write_csv(sales, path)
    source.replace_source(spark, path, table)
    source.replace_source(spark, path, table)
    return source.scan_sales(spark, table)


def outside_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales from files that quote every field and break lines inside some, each file in splits."""
    workspace = Workspace(spark, options=PACKED)
    path = workspace.path("csv")
    notes = F.concat("producto", F.lit('\n"'), "categoria", F.lit('",\r\n\n'))
    rows = source.as_text(tables.sales(spark, sf_dir)).withColumn(
        "producto", F.when(F.col("id_venta").endswith("2"), notes).otherwise(F.col("producto"))
    )
    exact = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(header=True, quoteAll=True, escape='"', **exact).csv(path)
    return read_split_csv(spark, path, workspace)


def raw_landing(w: Warehouse) -> DataFrame:
    return landing.read_landed(w.spark, w.store.base, w.landed(BATCH)["raw_uri"])


def write_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every sale, then land the same sales again in another order: the first stays."""
    workspace = Workspace(spark)
    path = f"{workspace.folder}/raw/ventas_origen.csv"
    text = workspace.keep(source.as_text(tables.sales(spark, sf_dir)), "text")
    landing.land_raw(spark, text, path)
    landing.land_raw(spark, text.orderBy(F.desc("id_venta")), path)
    return landing.read_landed(spark, workspace.folder, path)


def daily_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One whole batch in a new warehouse: land, stage, judge, publish, export, reconcile."""
    store = initialize(
        spark,
        Workspace(spark).folder,
        tables.products(spark, sf_dir),
        tables.regions(spark, sf_dir),
    )
    run_daily_batch(store, tables.faulty_sales(spark, sf_dir), clock=lambda: CLOCK)
    extracted = store.read("artefactos").groupBy("batch_id").agg(
        *(F.max(F.when(F.col("artifact") == kind, F.col("record_count"))).alias(name)
          for kind, name in (("raw", "extracted_count"), ("quarantine", "exported_rejects")))
    )
    checked = audit.reconciliation(store.read("etl_control"), extracted.drop("exported_rejects"))
    return checked.join(extracted.drop("extracted_count"), "batch_id")


def stage_raw(w: Warehouse) -> DataFrame:
    return w.staged().drop(*LAYOUT_KEYS)


def row_keys(w: Warehouse) -> DataFrame:
    """Row keys of each staged batch: how many, the smallest and the largest."""
    key = F.col("raw_row_key")
    staged = w.done.read("stg_ventas_raw").groupBy("batch_id")
    return staged.agg(F.countDistinct(key).alias("n_keys"), F.min(key).alias("lowest"), F.max(key).alias("highest"))


def replace_batch(w: Warehouse) -> DataFrame:
    """Write two batches, replace one by other rows and the other by none, in a new store."""
    store = stores.Store(w.spark, w.workspace.path("replace"))
    store.start()
    first = w.staged(FIRST_BATCH)
    store.replace_batch("stg_ventas_raw", first, FIRST_BATCH)
    store.replace_batch("stg_ventas_raw", w.staged(), "OTHER")
    store.replace_batch("stg_ventas_raw", w.staged(), BATCH)
    store.replace_batch("stg_ventas_raw", w.staged(), FIRST_BATCH)
    store.clear_batch("stg_ventas_raw", "OTHER")
    return store.read("stg_ventas_raw").select("batch_id", *SOURCE_COLUMNS)


def quarantine_json(w: Warehouse) -> DataFrame:
    rejected = w.done.read("dq_rechazos", BATCH)
    path = w.workspace.path("quarantine")
    landing.quarantine_json(w.spark, rejected, path, PACKED_TEXT)
    return landing.read_quarantine(w.spark, path, rejected).drop(*LAYOUT_KEYS)


def batch_id_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = tables.table(spark, sf_dir, "events")
    return events.select("event_id", batch_id_of(F.col("ts")).alias("batch_id"))


def batch_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants named by batch ids; every tenth-second id is spoilt on purpose."""
    events = tables.table(spark, sf_dir, "events")
    named = batch_id_of(F.col("ts"))
    spoilt = F.when(F.second("ts") == 0, F.concat(named, F.lit("-X"))).otherwise(named)
    return events.select("event_id", batch_instant(spoilt).alias("extracted_at"))


def valid_batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tables.table(spark, sf_dir, "orders")
    candidate = F.concat("o_orderpriority", F.lit("-"), F.col("o_orderkey").cast("string"))
    return orders.select(candidate.alias("batch_id")).filter(is_batch_id(F.col("batch_id")))


def batch_manifest(w: Warehouse) -> DataFrame:
    manifests = [
        audit.manifest(
            landing.read_landed(w.spark, w.store.base, w.landed(batch_id)["raw_uri"]),
            batch_id,
            instant(CLOCK),
        )
        for batch_id in (FIRST_BATCH, BATCH)
    ]
    return manifests[0].unionByName(manifests[1])


def content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.content_digest(source.as_text(tables.sales(spark, sf_dir)))


def artifact_log(w: Warehouse) -> DataFrame:
    for batch_id in (FIRST_BATCH, BATCH):
        w.landed(batch_id)
    return w.store.read("artefactos").select("batch_id", "artifact", "schema_version", "sha256", "record_count")


def artifact_integrity(w: Warehouse) -> DataFrame:
    """Whether what both batches landed still has the bytes that were logged."""
    for batch_id in (FIRST_BATCH, BATCH):
        w.landed(batch_id)
    first, second = (check_artifacts(w.store, batch_id) for batch_id in (FIRST_BATCH, BATCH))
    checked = first.unionByName(second).filter("artifact IN ('raw', 'manifest')")
    return checked.select("batch_id", "artifact", "intact")


# Catalogs and contract


def priced_catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The parts and regions as a catalog document: written as JSON, read back nested."""
    part, path = tables.table(spark, sf_dir, "part"), Workspace(spark).path("catalog")
    price = F.col("p_retailprice").cast("decimal(12,2)")
    products = part.select(
        F.array().cast("array<string>").alias("regions"),
        F.array(
            F.struct(
                tables.product_name().alias("name"),
                F.col("p_type").alias("category"),
                price.alias("min_price"),
                (price * F.col("p_size")).cast("decimal(12,2)").alias("max_price"),
            )
        ).alias("products"),
    )
    regions = tables.table(spark, sf_dir, "region").select(
        F.array("r_name").alias("regions"),
        F.array().cast(products.schema["products"].dataType).alias("products"),
    )
    products.unionByName(regions).write.json(path)
    return catalog.read_catalog_json(spark, path, multi_line=False)


def catalog_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return priced_catalog(spark, sf_dir)[0]


def catalog_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.catalog_checks(*priced_catalog(spark, sf_dir))


def catalog_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.categories(tables.products(spark, sf_dir))


def contract_check(w: Warehouse) -> DataFrame:
    return field_findings(w.staged(), w.exact_catalogs, instant(CLOCK).cast("date"), w.workspace)


# Quality


def dq_prepared(w: Warehouse) -> DataFrame:
    prepared = quality.prepare(w.staged(), w.catalogs, w.workspace)
    return prepared.select(
        *SOURCE_COLUMNS, "id_typed", "fecha_typed", "cantidad_typed", "precio_typed", "id_count",
        "producto_catalogo", "categoria_catalogo", "region_catalogo",
        F.coalesce("categoria_conocida", F.lit(False)).alias("categoria_conocida"),
    )


def dq_evaluate(w: Warehouse) -> DataFrame:
    judged = quality.evaluate(quality.prepare(w.staged(), w.catalogs, w.workspace))
    return judged.select(*EVALUATED_COLUMNS).drop(*LAYOUT_KEYS)


def dq_issues(w: Warehouse) -> DataFrame:
    today = instant(CLOCK).cast("date")
    return issues.quality_issues(w.staged(), w.exact_catalogs, today, w.workspace)


def dq_issues_long(w: Warehouse) -> DataFrame:
    return dq_issues(w).select("sale_id", "code", "message")


def dq_summary(w: Warehouse) -> DataFrame:
    return issues.issue_summary(dq_issues(w))


def dq_rule_counts(w: Warehouse) -> DataFrame:
    return quality.rule_counts(w.evaluated())


def valid_rows(w: Warehouse) -> DataFrame:
    return quality.valid_rows(w.evaluated()).select(*EVALUATED_COLUMNS).drop(*LAYOUT_KEYS)


def rejects(w: Warehouse) -> DataFrame:
    return quality.rejects(w.evaluated(), instant(CLOCK)).drop(*LAYOUT_KEYS)


# Warehouse. "New" members are those that every valid sale brings to the first batch's star.


def first_valid(w: Warehouse) -> DataFrame:
    return quality.valid_rows(w.evaluated(FIRST_BATCH))


def valid(w: Warehouse) -> DataFrame:
    return quality.valid_rows(w.evaluated())


def new_dates(w: Warehouse) -> DataFrame:
    nothing = w.done.read("dim_fecha").limit(0)
    return star.new_dates(valid(w), star.new_dates(first_valid(w), nothing))


def new_products(w: Warehouse) -> DataFrame:
    nothing = w.done.read("dim_producto").limit(0)
    known = star.new_products(first_valid(w), nothing).withColumn("vigente", F.lit(True))
    return star.new_products(valid(w), known)


def new_regions(w: Warehouse) -> DataFrame:
    """Regions the whole batch brings to a star that knows the smaller half of them."""
    known = valid(w).filter("lower(region) < 'asia'").select("region").distinct()
    return star.new_regions(valid(w), known.withColumn("vigente", F.lit(True)))


def new_facts(w: Warehouse) -> DataFrame:
    published = w.done.read("fact_ventas", FIRST_BATCH)
    return star.unpublished(valid(w), published).select(*EVALUATED_COLUMNS).drop(*LAYOUT_KEYS)


def fact_sales(w: Warehouse) -> DataFrame:
    """Every valid sale with its dimension keys, the keys shown by what they stand for."""
    keys = star.DimensionKeys.measured(
        w.mart.dates.df, w.mart.products.df, w.mart.regions.df
    )
    facts = star.fact_rows(valid(w), None, keys, instant(CLOCK))
    mart = Mart(facts, w.mart.dates, w.mart.products, w.mart.regions)
    return mart.flat("id_venta", "fecha", "producto", "categoria", "region", "cantidad",
                     "precio_unitario", "total_venta", "batch_id", "fecha_carga")


# Audit


def control(w: Warehouse) -> DataFrame:
    evaluated, fact = w.done.read("stg_ventas_evaluadas"), w.done.read("fact_ventas")
    # Keys differ by file layout.
    return audit.batch_control(
        audit.batch_summary(evaluated), fact, instant(CLOCK)
    ).select(*CONTROL_COLUMNS, "registros_ya_publicados", "id_minimo", "id_maximo")


def control_lookup(w: Warehouse) -> DataFrame:
    return stores.query_all(
        w.spark,
        "SELECT registros_origen, registros_validos, registros_rechazados, "
        "registros_publicados, importe_publicado, estado FROM {control} WHERE batch_id = :batch",
        {"batch": BATCH},
        control=w.done.read("etl_control"),
    ).limit(1)


def reconcile(w: Warehouse) -> DataFrame:
    """Both batches against the rows landed, and against one row more."""
    extracted = w.done.read("artefactos").filter("artifact = 'raw'").select(
        "batch_id", F.explode(F.array("record_count", F.col("record_count") + 1)).alias(
            "extracted_count")
    )
    return audit.reconciliation(w.done.read("etl_control"), extracted)


def ops_quality(w: Warehouse) -> DataFrame:
    return audit.operations(w.done.read("etl_control"))


# Views, access


def view(name: str) -> Query:
    return on_warehouse(lambda w: warehouse_view(w.done, name).drop(*LAYOUT_KEYS))


def vw_user_region(w: Warehouse) -> DataFrame:
    region = w.done.read("dim_region")
    permitted = permitted_regions(w.store.read("usuario_region"), region)
    return permitted.join(region, "region_key").select("usuario_correo", "region")


def seen_by_user(w: Warehouse) -> Mart:
    permitted = permitted_regions(w.store.read("usuario_region"), w.done.read("dim_region"))
    return visible_sales(w.mart, permitted, "customer#000000001@example.com")


def rls_sales(w: Warehouse) -> DataFrame:
    """Sales by region and month as one regional user sees them."""
    return seen_by_user(w).totals("region", "anio", "mes")


def rls_regions(w: Warehouse) -> DataFrame:
    """The regions that this user sees, with sales or without."""
    return seen_by_user(w).regions.df.select("region")


def on_mart(report: Callable, *arguments, **options) -> Query:
    return on_warehouse(lambda w: report(w.mart, *arguments, **options))


QUERIES: dict[str, Query] = {
    "scan_sales": scan_sales,
    "csv_roundtrip": csv_roundtrip,
    "outside_csv": outside_csv,
    "replace_source": replace_source,
    "raw_landing": on_warehouse(raw_landing),
    "write_once": write_once,
    "daily_batch": daily_batch,
    "stage_raw": on_warehouse(stage_raw),
    "replace_batch": on_warehouse(replace_batch),
    "quarantine_json": on_warehouse(quarantine_json),
    "batch_id_format": batch_id_format,
    "batch_instants": batch_instants,
    "valid_batch_ids": valid_batch_ids,
    "row_keys": on_warehouse(row_keys),
    "batch_manifest": on_warehouse(batch_manifest),
    "content_digest": content_digest,
    "artifact_log": on_warehouse(artifact_log),
    "artifact_integrity": on_warehouse(artifact_integrity),
    "catalog_products": catalog_products,
    "catalog_categories": catalog_categories,
    "catalog_checks": catalog_checks,
    "contract_check": on_warehouse(contract_check),
    "dq_prepared": on_warehouse(dq_prepared),
    "dq_evaluate": on_warehouse(dq_evaluate),
    "dq_issues_long": on_warehouse(dq_issues_long),
    "dq_summary": on_warehouse(dq_summary),
    "dq_rule_counts": on_warehouse(dq_rule_counts),
    "valid_rows": on_warehouse(valid_rows),
    "rejects": on_warehouse(rejects),
    "dim_date": on_warehouse(lambda w: w.done.read("dim_fecha")),
    "dim_product": on_warehouse(lambda w: w.done.read("dim_producto").drop(*LAYOUT_KEYS)),
    "dim_region": on_warehouse(lambda w: w.done.read("dim_region").drop(*LAYOUT_KEYS)),
    "new_dates": on_warehouse(new_dates),
    "new_products": on_warehouse(new_products),
    "new_regions": on_warehouse(new_regions),
    "new_facts": on_warehouse(new_facts),
    "fact_sales": on_warehouse(fact_sales),
    "surrogate_keys": on_mart(integrity.key_ranges),
    "fk_orphans": on_mart(integrity.orphans),
    "uk_violations": on_mart(integrity.unique_violations),
    "batch_control": on_warehouse(control),
    "control_lookup": on_warehouse(control_lookup),
    "reconcile": on_warehouse(reconcile),
    "ops_quality": on_warehouse(ops_quality),
    "vw_sales": view("vw_ventas_analiticas"),
    "vw_fact": view("vw_fact_ventas"),
    "vw_dim_date": view("vw_dim_fecha"),
    "vw_dim_producto": view("vw_dim_producto"),
    "vw_dim_region": view("vw_dim_region"),
    "vw_control": view("vw_control_etl"),
    "vw_user_region": on_warehouse(vw_user_region),
    "rls_sales": on_warehouse(rls_sales),
    "rls_regions": on_warehouse(rls_regions),
    "olap_region": on_mart(olap.sales_by_region),
    "olap_month_category": on_mart(olap.sales_by_month_and_category),
    "olap_rollup": on_mart(olap.rollup_region_product),
    "olap_cube": on_mart(olap.cube_region_category_month),
    "olap_grouping_sets": on_mart(olap.selected_groupings),
    "category_region": on_mart(olap.category_region_totals),
    "matrix_category_region": on_mart(
        olap.matrix_category_region, regions=["africa", "america", "asia", "europe", "middle east"]
    ),
    "monthly_sales": on_mart(olap.monthly_sales),
    "kpi_cards": on_mart(measures.kpi_cards),
    "distinct_sales": on_mart(measures.distinct_sales),
    "distinct_sales_by_region_month": on_mart(measures.distinct_sales, by=("region", "anio", "mes")),
    "distinct_sales_sliced": on_mart(
        measures.distinct_sales, years=[1997, 1998], categories=["SMALL", "LARGE"], by=("region",)
    ),
    "kpis_by_region_month": on_mart(measures.kpi_cards, by=("region", "anio", "mes")),
    "sliced_kpis": on_mart(
        measures.kpi_cards, years=[1997, 1998], categories=["SMALL", "LARGE"], regions=["asia"]
    ),
    "mom_sales": on_mart(measures.month_over_month),
    "mom_by_product": on_mart(measures.month_over_month, "producto"),
    "regional_share": on_mart(measures.regional_share, "categoria"),
    "regional_share_total": on_mart(measures.regional_share),
    "product_ranking": on_mart(measures.product_ranking),
}
