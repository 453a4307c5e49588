from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F
from synthetic import synthetic_sales, with_controlled_errors

from saleskeep.contract import EVALUATED_SCHEMA, SOURCE_COLUMNS, STAGED_SCHEMA
from saleskeep.functions.clock import instant
from saleskeep.operators import issues, quality
from saleskeep.operators.contract_checks import field_findings
from saleskeep.operators.lookup import Lookup
from saleskeep.operators.quality import evaluate, prepare
from saleskeep.sources.catalog import Catalogs, seed_products, seed_regions
from saleskeep.sources.sales import as_text

CLOCK = datetime(2026, 9, 1, 12, 0, tzinfo=UTC)
BASE = {
    "id_venta": "1", "fecha_venta": "2026-08-01", "producto": "Laptop Pro",
    "categoria": "Computación", "region": "Lima", "cantidad": "2", "precio_unitario": "3500.00",
}
# Change to the base row, warehouse codes, diagnostic codes.
CASES = [
    ({}, "", []),
    ({"id_venta": ""}, "DQ-001,", ["DQ-001"]),
    ({"id_venta": "A7"}, "DQ-001,", []),
    ({"fecha_venta": "2026-09-02"}, "DQ-003,", ["DQ-003"]),
    ({"fecha_venta": "2026-09-01"}, "", []),
    ({"fecha_venta": "2026-02-30"}, "DQ-003,", ["DQ-003"]),
    ({"fecha_venta": "20260801"}, "DQ-003,", []),
    ({"producto": ""}, "DQ-004,DQ-007,", ["DQ-004"]),
    ({"categoria": ""}, "DQ-004,DQ-007,DQ-008,", ["DQ-004", "DQ-008"]),
    ({"categoria": None}, "DQ-004,DQ-007,", ["DQ-004", "DQ-008"]),
    ({"region": "  "}, "DQ-004,DQ-007,", ["DQ-004"]),
    ({"region": "X"}, "DQ-007,", ["DQ-007"]),
    ({"region": " lima "}, "", ["DQ-007"]),
    ({"categoria": "X"}, "DQ-007,DQ-008,", ["DQ-007", "DQ-008"]),
    ({"categoria": "Oficina"}, "DQ-008,", ["DQ-008"]),
    ({"producto": "laptop pro"}, "", ["DQ-007"]),
    ({"producto": "Nada", "region": "Nada", "categoria": "Nada"}, "DQ-007,", ["DQ-007"] * 3),
    ({"cantidad": "0"}, "DQ-005,", ["DQ-005"]),
    ({"cantidad": "-1"}, "DQ-005,", ["DQ-005"]),
    ({"cantidad": "2.5"}, "DQ-005,", ["DQ-005"]),
    ({"cantidad": "x"}, "DQ-005,", ["DQ-005"]),
    ({"cantidad": "2.0"}, "DQ-005,", []),
    ({"cantidad": " 3 "}, "", []),
    ({"precio_unitario": "0"}, "DQ-006,", ["DQ-006"]),
    ({"precio_unitario": "-1"}, "DQ-006,", ["DQ-006"]),
    ({"precio_unitario": "x"}, "DQ-006,", ["DQ-006"]),
    ({"precio_unitario": "1e2"}, "DQ-006,", []),
    ({"precio_unitario": "0.004"}, "DQ-006,", []),
    ({"cantidad": "0", "precio_unitario": "0"}, "DQ-005,DQ-006,", ["DQ-005", "DQ-006"]),
]


@pytest.fixture(scope="module")
def catalogs(spark):
    inactive = spark.createDataFrame([("Retirado", "Museo", False)], seed_products(spark).schema)
    return Catalogs.active(seed_products(spark).union(inactive), seed_regions(spark))


@pytest.fixture(scope="module")
def exact_catalogs(spark):
    return Catalogs.exact(seed_products(spark), seed_regions(spark))


def staged_rows(spark, changes):
    rows = [
        (key, *({**BASE, "id_venta": str(key * 10), **change}[name] for name in SOURCE_COLUMNS), "B",
         CLOCK.replace(tzinfo=None))
        for key, change in enumerate(changes, 1)
    ]
    return spark.createDataFrame(rows, STAGED_SCHEMA)


def codes_by_row(evaluated):
    return {row.raw_row_key: row.dq_errors for row in evaluated.collect()}


def issue_codes(found):
    by_row = {}
    for row in found.orderBy("raw_row_key", "check_number").collect():
        by_row.setdefault(row.raw_row_key, []).append(row.code)
    return by_row


def too_large(catalogs):
    """The same catalogs, counted as too large for a broadcast."""
    lookups = (catalogs.products, catalogs.regions, catalogs.categories)
    return Catalogs(*(Lookup(lookup.df, lookup.key, False) for lookup in lookups))


@pytest.mark.parametrize("large", [False, True])
def test_rules_case_by_case(spark, workspace, catalogs, exact_catalogs, large, limits):
    rows = staged_rows(spark, [change for change, _, _ in CASES])
    if large:
        limits(0, 3)
        catalogs, exact_catalogs = too_large(catalogs), too_large(exact_catalogs)
    evaluated = evaluate(prepare(rows, catalogs, workspace))
    assert evaluated.columns == EVALUATED_SCHEMA.names
    assert [f.dataType for f in evaluated.schema] == [f.dataType for f in EVALUATED_SCHEMA]
    got = codes_by_row(evaluated)
    today = instant(CLOCK).cast("date")
    found = issue_codes(issues.quality_issues(rows, exact_catalogs, today, workspace))
    for key, (change, errors, diagnostic) in enumerate(CASES, 1):
        assert got[key] == errors, change
        assert found.get(key, []) == diagnostic, change


def test_repeated_ids(spark, workspace, catalogs, exact_catalogs):
    ids = ["7", "7", " 7 ", "", " ", "08", "8", "a", "A", None, None, "\t9", "9"]
    rows = staged_rows(spark, [{"id_venta": value} for value in ids])
    got = codes_by_row(evaluate(prepare(rows, catalogs, workspace)))
    assert [got[key] for key in range(1, 14)] == [
        "DQ-002,", "DQ-002,", "DQ-002,", "DQ-001,DQ-002,", "DQ-001,DQ-002,", "", "",
        "DQ-001,DQ-002,", "DQ-001,DQ-002,", "DQ-001,DQ-002,", "DQ-001,DQ-002,", "DQ-001,", "",
    ]
    today = instant(CLOCK).cast("date")
    found = issue_codes(issues.quality_issues(rows, exact_catalogs, today, workspace))
    assert found == {2: ["DQ-002"], 3: ["DQ-002"], 4: ["DQ-001"], 5: ["DQ-001"], 10: ["DQ-001"],
                     11: ["DQ-001"], 13: ["DQ-002"]}


def test_a_third_of_all_rows_without_an_id(spark, workspace, catalogs, exact_catalogs, limits):
    """The shuffled and salted way gives what brute force gives."""
    limits(0, 50)
    ids = ["" if n % 3 == 0 else str(n % 150) for n in range(900)]
    rows = staged_rows(spark, [{"id_venta": value} for value in ids]).repartition(6)
    today = instant(CLOCK).cast("date")
    evaluated = evaluate(prepare(rows, too_large(catalogs), workspace))
    counts = {value: ids.count(value) for value in set(ids)}
    expected = {
        key: ("DQ-001," if value == "" else "") + ("DQ-002," if counts[value] > 1 else "")
        for key, value in enumerate(ids, 1)
    }
    assert codes_by_row(evaluated) == expected
    found = issues.quality_issues(rows, too_large(exact_catalogs), today, workspace)
    repeats = {key for key, value in enumerate(ids, 1) if value and value in ids[: key - 1]}
    blanks = {key for key, value in enumerate(ids, 1) if not value}
    assert {r.raw_row_key for r in found.filter("code = 'DQ-002'").collect()} == repeats
    assert {r.raw_row_key for r in found.filter("code = 'DQ-001'").collect()} == blanks
    assert found.count() == len(repeats) + len(blanks)


def test_future_dates_follow_the_business_day(spark, workspace, catalogs):
    rows = staged_rows(spark, [{"fecha_venta": "2026-09-01"}, {"fecha_venta": "2026-08-31"}])
    early = rows.withColumn("ingestion_timestamp", instant(datetime(2026, 9, 1, 4, 59, tzinfo=UTC)))
    assert codes_by_row(evaluate(prepare(early, catalogs, workspace))) == {1: "DQ-003,", 2: ""}


def test_line_totals_that_do_not_fit_fail_the_batch(spark, workspace, catalogs):
    rows = staged_rows(spark, [{"cantidad": "2000000000", "precio_unitario": "9999999999.99"}, {}])
    prepared = prepare(rows, catalogs, workspace)
    with pytest.raises(Exception, match="does not fit"):
        evaluate(prepared).collect()
    lenient = {row.raw_row_key: row.total_venta for row in evaluate(prepared, strict=False).collect()}
    assert lenient[1] is None and str(lenient[2]) == "7000.00"


def test_inactive_products_are_unknown(spark, workspace, catalogs):
    rows = staged_rows(spark, [{"producto": "Retirado", "categoria": "Museo"}])
    assert codes_by_row(evaluate(prepare(rows, catalogs, workspace))) == {1: "DQ-007,"}


def test_rejects_keep_the_text_as_it_came(spark, workspace, catalogs):
    rows = staged_rows(spark, [{"cantidad": " x ", "producto": " laptop PRO"}, {}])
    evaluated = evaluate(prepare(rows, catalogs, workspace))
    reject = quality.rejects(evaluated, instant(CLOCK)).collect()
    assert len(reject) == 1
    assert (reject[0].cantidad_original, reject[0].producto_original) == (" x ", " laptop PRO")
    assert reject[0].reglas_incumplidas == "DQ-005,"
    assert reject[0].rechazo_key == 1
    kept = quality.valid_rows(evaluated).first()
    assert kept.producto == "Laptop Pro" and kept.original is None


def test_controlled_errors(spark, workspace, catalogs, exact_catalogs):
    sales = with_controlled_errors(synthetic_sales(spark, 10_000), 10_000)
    text = as_text(sales).fillna("").withColumns({
        "batch_id": F.lit("B"), "ingestion_timestamp": instant(CLOCK), "raw_row_key": F.monotonically_increasing_id() + 1})
    rows = workspace.keep(text, "staged")
    evaluated = workspace.keep(evaluate(prepare(rows, catalogs, workspace)), "evaluated")
    assert quality.valid_rows(evaluated).count() == 9_980
    assert evaluated.filter("NOT es_valido").count() == 20
    assert {r.code: r.failed_rows for r in quality.rule_counts(evaluated).collect()} == {
        "DQ-003": 3, "DQ-004": 3, "DQ-005": 4, "DQ-006": 4, "DQ-007": 9, "DQ-008": 3}
    found = issues.quality_issues(rows, exact_catalogs, instant(CLOCK).cast("date"), workspace)
    summary = issues.issue_summary(found).first()
    assert (summary.quality_issue_count, summary.invalid_record_count) == (23, 20)


def test_contract_rules_per_field(spark, workspace, exact_catalogs):
    changes = [{"id_venta": "1"}, {"id_venta": "1"}, {"id_venta": " "}, {"id_venta": "x"},
               {"fecha_venta": "2027-01-01"}, {"fecha_venta": "?"}, {"producto": "Nada"},
               {"categoria": ""}, {"region": "Nada"}, {"cantidad": "0"}, {"precio_unitario": "x"}]
    rows = staged_rows(spark, changes)
    found = field_findings(rows, exact_catalogs, instant(CLOCK).cast("date"), workspace)
    got = [tuple(r)[1:2] + tuple(r)[4:] for r in found.orderBy("position").collect()]
    assert got == [
        ("id_venta", 1, 1, 2), ("fecha_venta", 0, 1, 1), ("producto", 0, 0, 1),
        ("categoria", 1, 0, 0), ("region", 0, 0, 1), ("cantidad", 0, 0, 1),
        ("precio_unitario", 0, 1, 0),
    ]


def test_error_codes_as_array(spark):
    row = spark.sql("SELECT 'DQ-001,DQ-005,' a, '' b").select(
        quality.error_codes(F.col("a")).alias("a"), quality.error_codes(F.col("b")).alias("b")
    ).first()
    assert (row.a, row.b) == (["DQ-001", "DQ-005"], [])


def test_lookups_of_any_size_give_the_same(spark, workspace, limits):
    """Broadcast or shuffled, with hot keys, blank and repeated ids."""
    changes = [change for change, *_ in CASES] * 3 + [{"id_venta": "5"}] * 4 + [{"id_venta": ""}] * 3
    rows = workspace.keep(staged_rows(spark, changes), "staged")
    found = []
    for setting in ((1 << 27, 2_000_000), (0, 2)):
        limits(*setting)
        products, regions = seed_products(spark), seed_regions(spark)
        exact, active = Catalogs.exact(products, regions), Catalogs.active(products, regions)
        assert exact.products.fits == (setting[0] > 0)
        today = instant(CLOCK).cast("date")
        tables = (
            evaluate(prepare(rows, active, workspace)),
            issues.quality_issues(rows, exact, today, workspace),
            field_findings(rows, exact, today, workspace),
        )
        found.append([sorted(map(str, table.collect())) for table in tables])
    assert found[0] == found[1] and all(found[0])


def test_contract_counts_move_no_rows(spark, workspace, exact_catalogs):
    rows = workspace.keep(staged_rows(spark, [{}]), "staged")
    found = field_findings(rows, exact_catalogs, instant(CLOCK).cast("date"), workspace)
    assert "raw_row_key" not in found._jdf.queryExecution().executedPlan().toString()


def test_issues_move_no_text_whose_checks_are_done(spark, workspace, limits):
    limits(0, 2_000_000)
    exact = Catalogs.exact(seed_products(spark), seed_regions(spark))
    rows = workspace.keep(staged_rows(spark, [{}, {"id_venta": "10"}]), "staged")
    found = issues.quality_issues(rows, exact, instant(CLOCK).cast("date"), workspace)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_fecha" not in plan.split("Join")[1] and "_failed" in plan
