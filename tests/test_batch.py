import json
from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

import pytest
from synthetic import synthetic_sales, with_controlled_errors
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from saleskeep import contract
from saleskeep.operators import audit, integrity
from saleskeep.plans import batch as batches
from saleskeep.plans.batch import BatchError, initialize, only_new, run_daily_batch
from saleskeep.plans.store import query_all, query_one
from saleskeep.plans.log import CommitConflict, Entry, live
from saleskeep.plans.store import TABLES, Store
from saleskeep.plans.views import register_views
from saleskeep.sources.catalog import seed_products, seed_regions
from saleskeep.sources.landing import ImmutableArtifactError, land_raw, read_quarantine
from saleskeep.workspace import Workspace, shared_folder

CLOCK = datetime(2026, 9, 1, 12, 0, tzinfo=UTC)


def at(days=0):
    return lambda: CLOCK + timedelta(days=days)


@pytest.fixture
def store(spark, tmp_path):
    return initialize(spark, str(tmp_path / "base"), seed_products(spark), seed_regions(spark))


def source(spark, rows=200):
    return with_controlled_errors(synthetic_sales(spark, rows), rows)


def text_sales(spark, *changes):
    base = ("1", "2026-08-01", "Laptop Pro", "Computación", "Lima", "2", "3500.00")
    rows = [tuple({**dict(zip(contract.SOURCE_COLUMNS, base)), **c}.values()) for c in changes]
    return spark.createDataFrame(rows, contract.SALES_TEXT_SCHEMA)


def tables(store, names=("fact_ventas", "dim_fecha", "dim_producto", "dim_region", "dq_rechazos",
                         "etl_control", "stg_ventas_evaluadas")):
    return {name: sorted(map(str, store.read(name).collect())) for name in names}


def test_ten_thousand_sales(spark, store, tmp_path):
    result = run_daily_batch(store, source(spark, 10_000), "BATCH-20260901-001", at())
    assert {k: result[k] for k in ("extracted_count", "source_count", "valid_count", "rejected_count",
                                   "published_count", "status", "date_prefix")} == {
        "extracted_count": 10_000, "source_count": 10_000, "valid_count": 9_980,
        "rejected_count": 20, "published_count": 9_980, "status": "SUCCESS",
        "date_prefix": "2026/09/01"}
    mart = store.mart()
    assert result["published_amount"] == mart.fact.agg(F.sum("total_venta")).first()[0]
    assert mart.dates.df.count() <= 1097
    assert (mart.products.df.count(), mart.regions.df.count()) == (20, 5)
    assert {r.violations for r in integrity.unique_violations(mart).collect()} == {0}
    assert {r.orphan_rows for r in integrity.orphans(mart).collect()} == {0}
    keys = {r.table_name: r for r in integrity.key_ranges(mart).collect()}
    assert all(r.rows_total == r.distinct_keys and r.all_positive for r in keys.values())
    assert result["raw_uri"].endswith("/raw/ventas/2026/09/01/BATCH-20260901-001/ventas_origen.csv")
    text = "".join(p.read_text() for p in (tmp_path / "base/manifests/ventas/2026/09/01/BATCH-20260901-001"
                                           / "manifest.json").glob("part-*.json"))
    assert json.loads(text)["record_count"] == 10_000
    log = {r.artifact: r for r in store.read("artefactos").collect()}
    assert log["raw"].record_count == 10_000 and len(log["raw"].sha256) == 64
    assert log["quarantine"].record_count == 20 and log["manifest"].record_count == 1
    rejected = store.read("dq_rechazos")
    exported = read_quarantine(spark, result["quarantine_uri"], rejected)
    assert sorted(map(str, exported.collect())) == sorted(map(str, rejected.collect()))
    lines = [json.loads(r.value) for r in spark.read.text(result["quarantine_uri"]).collect()]
    assert [line["rechazo_key"] for line in lines] == sorted(line["rechazo_key"] for line in lines)
    assert all(list(line) == contract.REJECTS_SCHEMA.names for line in lines)


def test_large_lookups_and_hot_keys_give_the_same_tables(spark, tmp_path, limits):
    """Nothing fits a broadcast and every key is hot: only surrogate keys may differ."""
    sales = source(spark, 400).withColumn(
        "producto", F.when(F.col("id_venta") % 3 == 0, F.lit("Tablet 10")).otherwise(F.col("producto"))
    ).withColumn("categoria", F.when(F.col("id_venta") % 3 == 0, F.lit("Computación")).otherwise(
        F.col("categoria"))).unionByName(source(spark, 400).filter("id_venta % 5 = 0"))

    def outcome(name):
        store = initialize(spark, str(tmp_path / name), seed_products(spark), seed_regions(spark))
        with pytest.raises(audit.ReconciliationError):
            run_daily_batch(store, sales.filter("id_venta <= 100").dropDuplicates(["id_venta"]), "A", at())
            run_daily_batch(store, sales, "B", at(1))
        control = store.read("etl_control").drop("ultima_venta_key").collect()
        keyless = store.mart().flat().collect()
        return sorted(map(str, control)), sorted(map(str, keyless)), store

    usual = outcome("usual")
    limits(0, 2)
    split = outcome("split")
    assert split[:2] == usual[:2] and len(usual[1]) > 250
    mart = split[2].mart()
    assert not mart.products.fits
    assert {r.violations for r in integrity.unique_violations(mart).collect()} == {0}
    keys = sorted(r.producto_key for r in mart.products.df.collect())
    assert keys == list(range(1, len(keys) + 1))


def test_a_repeated_batch_leaves_the_same_tables(spark, store):
    run_daily_batch(store, source(spark), "BATCH-A", at())
    before = tables(store)
    run_daily_batch(store, source(spark), "BATCH-A", at())
    assert tables(store) == before
    with pytest.raises(ImmutableArtifactError):
        run_daily_batch(store, source(spark, 300), "BATCH-A", at())
    assert tables(store) == before


def test_the_first_batch_to_publish_a_sale_wins(spark, store):
    run_daily_batch(store, source(spark, 100), "BATCH-A", at())
    first = store.read("fact_ventas", "BATCH-A").collect()
    with pytest.raises(audit.ReconciliationError, match="WAREHOUSE NOT FULLY PUBLISHED"):
        run_daily_batch(store, synthetic_sales(spark, 150), "BATCH-B", at(1))
    assert sorted(store.read("fact_ventas", "BATCH-A").collect()) == sorted(first)
    control = store.read("etl_control", "BATCH-B").first()
    assert (control.registros_origen, control.registros_validos, control.registros_publicados,
            control.registros_ya_publicados, control.estado) == (150, 150, 70, 80, "FAILED")
    assert store.read("fact_ventas").count() == 150
    mart = store.mart()
    assert {r.violations for r in integrity.unique_violations(mart).collect()} == {0}
    # The rejects of a failed batch were exported all the same.
    exported = [r.artifact for r in store.read("artefactos", "BATCH-B").collect()]
    assert sorted(exported) == ["manifest", "quarantine", "raw"]


def test_incremental_batches_reconcile(spark, store):
    run_daily_batch(store, synthetic_sales(spark, 100), "BATCH-A", at())
    result = run_daily_batch(
        store, synthetic_sales(spark, 130), "BATCH-B", at(1), incremental=True
    )
    assert (result["extracted_count"], result["published_count"]) == (30, 30)
    assert store.read("fact_ventas").agg(F.countDistinct("venta_key")).first()[0] == 130


def test_a_repeated_batch_can_shrink_to_nothing(spark, store):
    store.replace_batch("fact_ventas", spark.createDataFrame([], contract.FACT_SCHEMA), "A")
    run_daily_batch(store, text_sales(spark, {}), "BATCH-A", at())
    run_daily_batch(store, text_sales(spark, {"id_venta": "9"}), "BATCH-B", at())
    assert store.read("fact_ventas").count() == 2
    batches.stage_raw(store, "BATCH-B", _land(store, text_sales(spark, {"cantidad": "0"})), CLOCK)
    batches.process_batch(store, "BATCH-B", CLOCK, _workspace(store))
    assert [r.batch_id for r in store.read("fact_ventas").collect()] == ["BATCH-A"]
    assert store.read("dq_rechazos", "BATCH-B").count() == 1


def _workspace(store):
    return Workspace(store.spark, store.base)


def _land(store, rows):
    path = f"{store.base}/raw/other"
    land_raw(store.spark, rows, path)
    return path


def test_unsafe_batch_ids_stop_before_any_work():
    with pytest.raises(ValueError, match="unsupported"):
        run_daily_batch(object(), object(), "BATCH/../1")


def test_one_id_written_in_two_ways_publishes_nothing(spark, store):
    run_daily_batch(store, text_sales(spark, {"id_venta": "05"}), "BATCH-A", at())
    before = tables(store, ("fact_ventas", "etl_control"))
    with pytest.raises(BatchError, match="several ways"):
        run_daily_batch(store, text_sales(spark, {"id_venta": "7"}, {"id_venta": "07"}), "BATCH-B", at())
    assert tables(store, ("fact_ventas", "etl_control")) == before


def test_an_empty_batch_is_an_error(spark, store):
    with pytest.raises(BatchError, match="no staged rows"):
        run_daily_batch(store, text_sales(spark, {}).limit(0), "BATCH-A", at())


def test_facts_of_an_unfinished_batch_do_not_count(spark, store, monkeypatch):
    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(batches, "batch_control", crash)
        with pytest.raises(RuntimeError, match="driver lost"):
            run_daily_batch(store, source(spark, 60), "BATCH-A", at())
    assert store.read("fact_ventas").count() == 0 and store.mart().fact.count() == 0
    result = run_daily_batch(store, source(spark, 60), "BATCH-B", at(1))
    assert result["published_count"] == 40 + 1  # one of three future dates has arrived
    assert store.mart().fact.count() == 41


def test_new_members_keep_the_first_spelling_and_old_keys(spark, store):
    run_daily_batch(store, text_sales(spark, {"producto": "LAPTOP pro", "region": "lima"},
                                      {"id_venta": "2", "producto": "Laptop Pro"}), "BATCH-A", at())
    product, region = store.read("dim_producto"), store.read("dim_region")
    assert [tuple(r) for r in product.collect()] == [(1, "LAPTOP pro", "Computación", True)]
    assert [r.region for r in region.collect()] == ["Lima"]
    sold = {"producto": "Archivador", "categoria": "muebles", "region": "SUR", "id_venta": "3"}
    run_daily_batch(store, text_sales(spark, sold, {"id_venta": "4"}), "BATCH-B", at())
    assert [tuple(r) for r in store.read("dim_producto").orderBy("producto_key").collect()] == [
        (1, "LAPTOP pro", "Computación", True), (2, "Archivador", "muebles", True)]
    flat = {r.id_venta: r for r in store.mart().flat().collect()}
    assert (flat[4].producto, flat[3].categoria, flat[3].region) == ("LAPTOP pro", "muebles", "SUR")
    assert flat[4].fecha == date(2026, 8, 1) and flat[4].total_venta == Decimal("7000.00")


def test_reconciliation_messages(spark):
    def checked(control, extracted):
        row = dict(zip(contract.CONTROL_SCHEMA.names, (
            "B", None, None, *control[:4], None, Decimal("4410.07"), control[4], 0, 0, 1, 9)))
        frame = spark.createDataFrame([tuple(row.values())], contract.CONTROL_SCHEMA)
        counts = spark.createDataFrame([("B", extracted)], "batch_id string, extracted_count bigint")
        return audit.reconciliation(frame, counts)

    good = audit.require_reconciled(checked((7_400, 7_313, 87, 7_313, "SUCCESS"), 7_400))
    assert good == {"source_count": 7_400, "valid_count": 7_313, "rejected_count": 87,
                    "published_count": 7_313, "published_amount": Decimal("4410.07"),
                    "status": "SUCCESS"}
    for control, extracted, message in (
        ((100, 99, 1, 98, "FAILED"), 100, "WAREHOUSE NOT FULLY PUBLISHED"),
        ((100, 99, 1, 99, "FAILED"), 100, "WAREHOUSE NOT FULLY PUBLISHED"),
        ((100, 98, 1, 98, "SUCCESS"), 100, "VALID AND REJECTED DIFFER FROM SOURCE"),
        ((100, 99, 1, 98, "FAILED"), 101, "SOURCE COUNT DIFFERS: .*101.*100"),
    ):
        with pytest.raises(audit.ReconciliationError, match=message):
            audit.require_reconciled(checked(control, extracted))
    missing = checked((1, 1, 0, 1, "SUCCESS"), 1).select("batch_id")
    none = audit.reconciliation(
        spark.createDataFrame([], contract.CONTROL_SCHEMA),
        missing.withColumn("extracted_count", F.lit(1).cast("bigint")),
    )
    with pytest.raises(audit.ReconciliationError, match="NO CONTROL ROW.*'B'"):
        audit.require_reconciled(none)


def test_views_and_parameterised_queries(spark, store):
    run_daily_batch(store, source(spark, 100), "BATCH-A", at())
    store.replace("usuario_region", spark.createDataFrame(
        [("a@x", "LIMA", True), ("a@x", "Sur", False), ("b@x", "Nada", True)], contract.ACCESS_SCHEMA))
    names = register_views(store)
    assert len(names) == 7
    assert spark.table("vw_ventas_analiticas").columns == list(contract.FLAT_COLUMNS)
    assert spark.table("vw_control_etl").columns == list(contract.CONTROL_COLUMNS)
    assert [r.usuario_correo for r in spark.table("vw_usuario_region").collect()] == ["a@x"]
    control = store.read("etl_control")
    sql = "SELECT registros_validos n, estado FROM {control} WHERE batch_id = :batch"
    assert query_one(spark, sql, {"batch": "BATCH-A"}, control=control) == {"n": 80, "estado": "SUCCESS"}
    assert query_one(spark, sql, {"batch": "'x"}, control=control) is None
    assert query_all(spark, "SELECT 1 AS a").collect()[0].a == 1


def test_shared_folder_comes_from_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert before is None or shared_folder(spark) == before.rstrip("/")


def test_only_batches_that_can_hold_an_id_are_read(spark, store):
    run_daily_batch(store, synthetic_sales(spark, 100), "BATCH-A", at())
    run_daily_batch(store, synthetic_sales(spark, 200), "BATCH-B", at(), incremental=True)

    def read(*ids):
        found = store.published(*ids)
        return found.count(), sorted({f.split("batch_id=")[1][:7] for f in found.inputFiles()})

    assert read() == (200, ["BATCH-A", "BATCH-B"])
    assert read(150, 160) == (11, ["BATCH-B"])
    assert read(90, 101) == (12, ["BATCH-A", "BATCH-B"])
    assert read(201, 300) == (0, [])
    assert read(None, 10) == (10, ["BATCH-A"])


def test_a_lost_fact_folder_is_an_error(spark, store, tmp_path):
    run_daily_batch(store, synthetic_sales(spark, 100), "BATCH-A", at())
    run_daily_batch(store, synthetic_sales(spark, 130), "BATCH-B", at(1), incremental=True)
    assert store.published().count() == sum(r["registros_publicados"] for r in store.read("etl_control").collect())
    entry, = live(store.log.entries(store.log.latest()), "fact_ventas", "BATCH-A")
    folder = spark._jvm.org.apache.hadoop.fs.Path(store.folder("fact_ventas", "BATCH-A", entry.commit))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    with pytest.raises(AnalysisException):
        store.published().count()


def test_incremental_extraction_loses_no_row(spark, store):
    rows = spark.createDataFrame([(i,) for i in ("-4", "0", "3", None, "", "A7")], "id_venta string")
    assert only_new(store, rows).count() == 6
    run_daily_batch(store, synthetic_sales(spark, 100), "BATCH-A", at())
    published = {r["id_venta"] for r in store.published().collect()}
    rejected = sorted(set(range(1, 101)) - published)
    ids = [str(i) for i in (*published, *rejected, 900)]
    found = only_new(store, rows.union(spark.createDataFrame([(i,) for i in ids], "id_venta string")))
    left = {r["id_venta"] for r in found.collect()}
    assert {"-4", "0", None, "", "A7", "900", *map(str, rejected)} - {"3"} <= left
    assert not left & {str(i) for i in published}


def everything(store):
    return {name: sorted(map(str, store.read(name).collect())) for name in TABLES if name != "artefactos"}


def test_a_refused_batch_changes_no_table(spark, store, monkeypatch):
    """Whatever it had written by then: verdicts, rejects, members, facts."""
    run_daily_batch(store, source(spark, 100), "BATCH-A", at())
    before, version = everything(store), store.log.latest()
    new = {"producto": "Archivador", "categoria": "Muebles", "id_venta": "900"}
    twice = text_sales(spark, new, {"id_venta": "7", "cantidad": "0"}, {"id_venta": "08"}, {"id_venta": "8"})
    path = f"{store.base}/raw/twice"
    land_raw(spark, twice, path)
    with pytest.raises(BatchError, match="several ways"):
        with store.begin() as change:
            batches.stage_raw(change, "BATCH-A", path, CLOCK)
            batches.process(change, "BATCH-A", CLOCK, _workspace(store))
    assert everything(store) == before

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(batches, "batch_control", crash)
        with pytest.raises(RuntimeError, match="driver lost"), store.begin() as change:
            batches.stage_raw(change, "BATCH-A", _land(store, text_sales(spark, new)), CLOCK)
            batches.process(change, "BATCH-A", CLOCK, _workspace(store))
    assert everything(store) == before and store.log.latest() == version
    with store.begin() as change:
        batches.stage_raw(change, "BATCH-A", f"{store.base}/raw/other", CLOCK)
        batches.process(change, "BATCH-A", CLOCK, _workspace(store))
    assert [r.id_venta for r in store.read("fact_ventas").collect()] == [900]
    assert everything(store) != before and store.log.latest() == version + 1
    assert sorted(map(str, store.read("fact_ventas", version=version).collect())) == before["fact_ventas"]
    gone = store.vacuum()
    assert gone and store.read("fact_ventas").count() == 1
    with pytest.raises(AnalysisException):
        store.read("fact_ventas", version=version).count()


def test_two_writers_cannot_both_commit(spark, store):
    other = Store(spark, store.base)
    path = _land(store, text_sales(spark, {}))
    with pytest.raises(CommitConflict, match="fact_ventas"):
        with store.begin() as first:
            batches.stage_raw(first, "BATCH-A", path, CLOCK)
            batches.process(first, "BATCH-A", CLOCK, _workspace(store))
            with other.begin() as second:
                batches.stage_raw(second, "BATCH-B", path, CLOCK)
                batches.process(second, "BATCH-B", CLOCK, _workspace(store))
    assert [r.batch_id for r in store.read("fact_ventas").collect()] == ["BATCH-B"]
    assert [r.batch_id for r in store.read("stg_ventas_raw").collect()] == ["BATCH-B"]
    # Writers of different tables don't get in each other's way.
    access = spark.createDataFrame([("a@x", "Lima", True)], contract.ACCESS_SCHEMA)
    with store.begin() as first:
        first.replace("usuario_region", access)
        other.append("dim_region", spark.createDataFrame([(9, "Nueva", True)], contract.DIM_REGION_SCHEMA))
    assert store.read("usuario_region").count() == 1 and store.read("dim_region").filter("region = 'Nueva'").count() == 1


def test_only_one_writer_gets_a_version(spark, store):
    entry = [Entry(0, "dim_fecha", "", "c1", "add")]
    version = store.log.latest()
    assert store.log.commit(version, set(), entry) == version + 1
    assert not store.log._put(version + 1, [{"version": version + 1}])
    assert store.log.commit(version, {"fact_ventas"}, entry) == version + 2
    with pytest.raises(CommitConflict, match="dim_fecha"):
        store.log.commit(version, {"dim_fecha"}, entry)
    with pytest.raises(FileNotFoundError, match="no log"):
        Store(spark, f"{store.base}/nothing").read("dim_fecha")


def test_live_entries():
    log = [Entry(n, *rest) for n, rest in enumerate((
        ("f", "A", "1", "replace"), ("f", "B", "2", "replace"), ("d", "", "3", "add"), ("d", "", "4", "add"),
        ("f", "A", "5", "replace"), ("f", "B", None, "replace"), ("d", "", "6", "replace"), ("d", "", "7", "add")))]
    assert [e.commit for e in live(log, "f")] == ["5"]
    assert [e.commit for e in live(log[:5], "f")] == ["5", "2"]
    assert [e.commit for e in live(log, "d")] == ["6", "7"]
    assert live(log, "f", "B") == [] and live(log, "x") == []


def test_views_show_batches_that_came_later(spark, store):
    names = register_views(store)
    assert all(spark.table(name).isEmpty() for name in names)
    other = Store(spark, store.base)
    run_daily_batch(other, source(spark, 100), "20260901", at())
    counts = lambda: {name: spark.table(name).count() for name in names}
    assert counts()["vw_fact_ventas"] == counts()["vw_ventas_analiticas"] == 80
    run_daily_batch(store, synthetic_sales(spark, 150), "20260902", at(1), incremental=True)
    after = counts()
    assert after["vw_fact_ventas"] == after["vw_ventas_analiticas"] == store.read("fact_ventas").count() == 150
    assert after["vw_control_etl"] == 2
    assert {r.batch_id for r in spark.table("vw_fact_ventas").select("batch_id").distinct().collect()} == {"20260901", "20260902"}
    flat = store.mart().flat()
    assert sorted(map(str, spark.table("vw_ventas_analiticas").collect())) == sorted(map(str, flat.collect()))
    assert spark.table("vw_ventas_analiticas").dtypes == flat.dtypes
    store.vacuum()
    assert counts() == after


def test_fact_keys_have_no_gaps(spark, store):
    run_daily_batch(store, source(spark, 100), "BATCH-A", at())
    run_daily_batch(store, synthetic_sales(spark, 130), "BATCH-B", at(1), incremental=True)
    keys = sorted(r.venta_key for r in store.read("fact_ventas").collect())
    assert keys == list(range(1, 131))


def test_row_keys_follow_the_input(spark, store):
    """Files in their order and rows in theirs, whatever a task reads at a time."""
    path = f"{store.base}/raw/parts"
    land_raw(spark, synthetic_sales(spark, 3_000).repartition(7), path)
    expected = []
    for file in sorted(f for f in spark.read.text(path).inputFiles()):
        expected += [r[0] for r in spark.read.csv(file, header=True).coalesce(1).collect()]
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        for size in ("1m", "16k", "200k"):
            spark.conf.set(name, size)
            batches.stage_raw(store, f"BATCH-{size}", path, CLOCK)
            rows = store.read("stg_ventas_raw", f"BATCH-{size}").orderBy("raw_row_key").collect()
            assert [r.raw_row_key for r in rows] == list(range(1, 3_001))
            assert [r.id_venta for r in rows] == expected
    finally:
        spark.conf.set(name, before)


def test_a_quantity_of_any_length_is_only_a_rejected_row(spark, store):
    rows = text_sales(spark, {}, {"id_venta": "2", "cantidad": "4" * 40}, {"id_venta": "3", "cantidad": "1e2000"})
    result = run_daily_batch(store, rows, "BATCH-A", at())
    assert (result["valid_count"], result["rejected_count"], result["status"]) == (1, 2, "SUCCESS")
