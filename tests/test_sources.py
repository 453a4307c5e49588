import json
from datetime import UTC, date, datetime
from decimal import Decimal, localcontext

import pytest
import synthetic as synth
from pyspark.sql import functions as F

from saleskeep import contract
from saleskeep.contract import SALES_TEXT_SCHEMA
from saleskeep.functions.clock import instant
from saleskeep.operators import audit
from saleskeep.operators.audit import content_digest, manifest
from saleskeep.sources import catalog, landing, sales


def text_rows(spark, rows):
    return spark.createDataFrame(rows, contract.SALES_TEXT_SCHEMA)


TRICKY = [
    ("1", "2026-08-01", 'He said "hi", ok', "a\\b", " padded ", "\t2", "3.50"),
    ("2", "", "line\nbreak", "", "ñandú", "", ""),
    ("3", "2026-08-02", "'", '"', ",", "-1", "1e2"),
    ("", "", "", "", "", "", ""),
]


def test_csv_keeps_every_text(spark, tmp_path):
    path = str(tmp_path / "csv")
    sales.write_csv(text_rows(spark, TRICKY), path)
    assert sorted(map(tuple, sales.read_csv(spark, path).collect())) == sorted(TRICKY)


def test_csv_form_of_typed_sales(spark, tmp_path):
    typed = spark.createDataFrame(
        [(7, date(2026, 8, 1), "p", None, "r", 2, Decimal("3.5"))], contract.SALES_SCHEMA
    )
    path = str(tmp_path / "csv")
    sales.write_csv(typed.coalesce(1), path)
    lines = spark.read.text(path).collect()
    assert [line.value for line in lines] == [
        "id_venta,fecha_venta,producto,categoria,region,cantidad,precio_unitario",
        "7,2026-08-01,p,,r,2,3.50",
    ]


def write_file(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


HEADER = ",".join(contract.SOURCE_COLUMNS) + "\n"


def test_repeated_headers_and_blank_lines_are_skipped(spark, tmp_path):
    body = "1,2026-08-01,p,c,r,1,2\n\n" + HEADER + ",,,,,,\n2,2026-08-01,p,c,r,1,2\n"
    path = write_file(tmp_path / "x.csv", HEADER + body)
    assert [row.id_venta for row in sales.read_csv(spark, path).collect()] == ["1", "", "2"]


@pytest.mark.parametrize("bad", ["1,2026-08-01,p\n", "1,2026-08-01,p,c,r,1,2,extra\n"])
def test_rows_of_another_width_fail_the_read(spark, tmp_path, bad):
    path = write_file(tmp_path / "x.csv", HEADER + bad)
    with pytest.raises(Exception, match="(?i)malformed"):
        sales.read_csv(spark, path).collect()


def test_source_is_replaced_as_a_whole(spark, tmp_path):
    table = str(tmp_path / "table")
    for count in (30, 20):
        path = str(tmp_path / f"csv{count}")
        sales.write_csv(synth.synthetic_sales(spark, count), path)
        assert sales.replace_source(spark, path, table) == count
    loaded = sales.scan_sales(spark, table, ordered=True)
    assert loaded.schema == contract.SALES_SCHEMA
    assert [row.id_venta for row in loaded.collect()] == list(range(1, 21))


def test_source_refuses_text_of_another_type(spark, tmp_path):
    path = write_file(tmp_path / "x.csv", HEADER + "x,2026-08-01,p,c,r,1,2\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sales.replace_source(spark, path, str(tmp_path / "table"))


def test_jdbc_scan_is_cut_by_sale_id():
    options = sales.jdbc_options("jdbc:x", "oltp.ventas_origen", 1, 100, 4)
    assert options["partitionColumn"] == "id_venta"
    assert options["numPartitions"] == "4"
    assert options["dbtable"].startswith("(SELECT id_venta, fecha_venta, producto,")


def test_landing_is_written_once(spark, tmp_path):
    path, rows = str(tmp_path / "raw"), text_rows(spark, TRICKY)
    landing.land_raw(spark, rows, path)
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "raw").iterdir()}
    landing.land_raw(spark, rows.repartition(3), path)
    assert {p.name: p.stat().st_mtime_ns for p in (tmp_path / "raw").iterdir()} == before
    with pytest.raises(landing.ImmutableArtifactError):
        landing.land_raw(spark, rows.limit(2), path)
    assert landing.read_landed(spark, str(tmp_path), path).count() == len(TRICKY)


def test_an_interrupted_landing_is_written_again(spark, tmp_path):
    path = tmp_path / "raw"
    path.mkdir()
    (path / "part-0.csv").write_text(HEADER + "1,2,3,4,5,6,7\n")
    landing.land_raw(spark, text_rows(spark, TRICKY), str(path))
    assert sales.read_csv(spark, str(path)).count() == len(TRICKY)


@pytest.mark.parametrize("uri", ["/elsewhere/raw", "/base", "/base/", "/base/../x", "/basement/raw"])
def test_landed_reads_stay_inside_the_base(spark, uri):
    with pytest.raises(ValueError, match="does not belong"):
        landing.read_landed(spark, "/base", uri)


def test_digest_sees_content_and_not_layout(spark):
    rows = text_rows(spark, TRICKY)
    first = content_digest(rows).first()
    assert (first.record_count, len(first.sha256)) == (4, 64)
    assert content_digest(rows.repartition(4).orderBy(F.desc("id_venta"))).first() == first
    for other in (rows.union(rows.limit(1)), rows.limit(3),
                  rows.withColumn("region", F.nullif("region", F.lit(""))),
                  rows.withColumn("producto", F.concat("producto", F.lit(" ")))):
        assert content_digest(other).first().sha256 != first.sha256
    assert content_digest(rows.limit(0)).first().record_count == 0


def test_manifest_counts_every_row_and_adds_what_it_can_read(spark):
    rows = text_rows(spark, [
        ("1", "", "", "", "", "2", "3.50"), ("2", "", "", "", "", "x", "1"),
        ("3", "", "", "", "", "1.5", "0.333"), ("4", "", "", "", "", "", "")])
    now = instant(datetime(2026, 9, 5, 1, 2, 3, tzinfo=UTC))
    document = manifest(rows, "BATCH-20260905-073045", now).first().asDict()
    assert list(document) == ["batch_id", "source_system", "schema_version", "extracted_at_utc",
                              "file_name", "record_count", "total_amount", "sha256"]
    assert document["record_count"] == 4
    assert document["total_amount"] == "7.50"
    assert document["extracted_at_utc"] == "2026-09-05T12:30:45+00:00"
    other = manifest(rows, "TEST-001", now).first()
    assert other.extracted_at_utc == "2026-09-05T01:02:03+00:00"


def test_manifest_adds_amounts_of_any_size(spark):
    pairs = [("1e23", "19.99"), ("3", "1e-19"), ("20000", "0.00000025"), ("-7", ".5"), ("1" * 19, "9" * 19), ("9" * 19, "9" * 19),
             ("0", "1e99"), (" 2 ", "3.50"), ("x", "1"), ("", ""), (None, "2")]
    rows = text_rows(spark, [("1", "", "", "", "", q, p) for q, p in pairs])
    with localcontext(prec=200):
        want = sum(Decimal(q) * Decimal(p) for q, p in pairs[:8])
        assert manifest(rows, "T", F.lit(None)).first().total_amount == f"{want:.2f}"
    assert manifest(rows.limit(0), "T", F.lit(None)).first().total_amount == "0.00"


def test_manifest_adds_plain_numbers_as_decimals(spark):
    """And takes only others apart into limbs."""
    pairs = [("17", "901.00"), ("0", "5"), ("007", "0.10"), ("999999999", "999999999.99")]
    others = [("1000000000", "1"), ("3", "1.005"), ("-2", "4"), ("1_000", "2.5"), ("2", "1e2"), (" 2", "3"), ("x", "1"), ("", "1"), ("2", None), ("2\n", "1")]
    rows = spark.createDataFrame([("1", "d", "p", "c", "r", q, x) for q, x in pairs + others], SALES_TEXT_SCHEMA)
    found = audit._products(rows).select("_plain", "_amount").collect()
    assert [r["_plain"] for r in found] == [Decimal(q) * Decimal(x) for q, x in pairs] + [None] * len(others)
    assert all(r["_amount"] is None for r in found[: len(pairs)])
    old = [r["_amount"] is not None for r in found[len(pairs) :]]
    readable = [(q, x) for (q, x), told in zip(others, old) if told]
    assert {(q, x) for q, x in others[:5]} <= set(readable) and ("x", "1") not in readable
    want = sum(Decimal(q.strip()) * Decimal(x) for q, x in pairs + readable)
    count, total, _ = audit.landed_figures(rows)
    assert (count, total) == (len(pairs + others), want)


def test_manifest_adds_numbers_of_any_length(spark):
    pairs = [("1" * 40, "9" * 60 + ".25"), ("-" + "7" * 25, "0." + "0" * 30 + "3"), ("1e1001", "2"), ("-1e1001", "2"), ("5E-1200", "1"),
             ("1_000", "1.5_0"), ("1e400", "1e-399"), ("0e9999999", "7"), ("+.5", "00012."), ("123456789" * 9, "987654321" * 9)]
    skipped = [("1e1000001", "1"), ("1e" + "9" * 30, "1"), ("1e-" + "9" * 30, "1"), ("NaN", "1"), ("1e", "2"), ("Infinity", "2"), ("--1", "2")]
    rows = text_rows(spark, [("1", "", "", "", "", q, p) for q, p in pairs + skipped]).repartition(4)
    found = manifest(rows, "T", F.lit(None)).first()
    with localcontext(prec=5_000):
        assert found.total_amount == f"{sum(Decimal(q) * Decimal(p) for q, p in pairs):.2f}"
    assert found.record_count == len(pairs + skipped)
    assert found.sha256 == content_digest(rows).first().sha256
    ties = text_rows(spark, [("1", "", "", "", "", "1", p) for p in ("0.125", "0.01", "1e-9", "-1e-9")])
    assert manifest(ties, "T", F.lit(None)).first().total_amount == "0.14"
    half = text_rows(spark, [("1", "", "", "", "", "1", "0.125")])
    assert manifest(half, "T", F.lit(None)).first().total_amount == "0.12"


def test_synthetic_sales_are_repeatable_and_in_range(spark):
    first = synth.synthetic_sales(spark, 5_000)
    assert first.schema.simpleString() == contract.SALES_SCHEMA.simpleString()
    assert content_digest(first).first() == content_digest(synth.synthetic_sales(spark, 5_000)).first()
    assert content_digest(first).first() != content_digest(synth.synthetic_sales(spark, 5_000, seed=1)).first()
    priced = spark.createDataFrame(synth.SEED_PRODUCTS, "producto string, c string, low int, high int")
    joined = first.join(priced, "producto")
    assert joined.filter("categoria = c AND precio_unitario BETWEEN low AND high").count() == 5_000
    facts = first.agg(F.min("fecha_venta"), F.max("fecha_venta"), F.countDistinct("producto"),
                      F.countDistinct("cantidad"), F.countDistinct("id_venta")).first()
    assert facts[0] >= synth.FIRST_DAY and facts[1] <= synth.PROCESSING_DATE
    assert tuple(facts)[2:] == (20, 5, 5_000)
    shares = {r.region: r["count"] / 5_000 for r in first.groupBy("region").count().collect()}
    for region, weight in zip(synth.SEED_REGIONS, synth.REGION_WEIGHTS):
        assert abs(shares[region] - weight / 100) < 0.03
    with pytest.raises(ValueError):
        synth.synthetic_sales(spark, 19)


def test_controlled_errors_sit_in_the_last_twenty_sales(spark):
    clean = synth.synthetic_sales(spark, 100)
    broken = synth.with_controlled_errors(clean, 100).orderBy("id_venta").collect()
    assert [r.id_venta for r in broken if r.cantidad == 0] == [81, 82, 83, 84]
    assert [r.id_venta for r in broken if r.precio_unitario == 0] == [85, 86, 87, 88]
    assert [r.id_venta for r in broken if r.producto == ""] == [89, 90, 91]
    assert [r.id_venta for r in broken if r.region == synth.UNKNOWN_REGION] == [92, 93, 94]
    assert [r.id_venta for r in broken if r.categoria == synth.WRONG_CATEGORY] == [95, 96, 97]
    assert [r.fecha_venta for r in broken[97:]] == [date(2026, 9, 2), date(2026, 9, 3), date(2026, 9, 4)]
    assert broken[:80] == clean.orderBy("id_venta").collect()[:80]


def catalog_file(tmp_path, change=lambda document: None):
    document = {
        "regions": list(catalog.SEED_REGIONS),
        "products": [dict(zip(("name", "category", "min_price", "max_price"), row))
                     for row in catalog.SEED_PRODUCTS],
    }
    change(document)
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps(document, ensure_ascii=False, indent=2), encoding="utf-8")
    return str(path)


def test_catalog_document(spark, tmp_path):
    products, regions = catalog.read_catalog_json(spark, catalog_file(tmp_path))
    catalog.require_valid_catalog(products, regions)
    assert {tuple(r) for r in products.select("name", "category").collect()} == {
        row[:2] for row in catalog.SEED_PRODUCTS}
    assert [r.region for r in regions.collect()] == list(catalog.SEED_REGIONS)
    assert catalog.categories(catalog.seed_products(spark)).count() == 5


@pytest.mark.parametrize("change", [
    lambda d: d["regions"].pop(),
    lambda d: d["regions"].__setitem__(0, "Sur"),
    lambda d: d["products"].pop(),
    lambda d: d["products"][0].update(name="Tablet 10"),
    lambda d: [p.update(category="Oficina") for p in d["products"] if p["category"] == "Muebles"],
    lambda d: d["products"][3].update(min_price=0),
    lambda d: d["products"][3].update(max_price=1),
])
def test_catalog_checks_refuse(spark, tmp_path, change):
    products, regions = catalog.read_catalog_json(spark, catalog_file(tmp_path, change))
    with pytest.raises(ValueError, match="catalog"):
        catalog.require_valid_catalog(products, regions)


def test_schema_against_the_contract(spark):
    good = synth.synthetic_sales(spark, 20)
    assert contract.schema_findings(good) == []
    bad = good.withColumn("cantidad", F.col("cantidad").cast("string")).drop("precio_unitario")
    assert contract.schema_findings(bad) == [
        "column 6: expected cantidad int, found cantidad string",
        "missing column precio_unitario decimal(12,2)",
    ]
    assert contract.schema_findings(good.withColumn("x", F.lit(1))) == ["unexpected column x int"]
    assert contract.SOURCE_COLUMNS == ("id_venta", "fecha_venta", "producto", "categoria", "region",
                                       "cantidad", "precio_unitario")
