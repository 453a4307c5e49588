from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleskeep import contract
from saleskeep.functions.clock import date_key
from saleskeep.operators import integrity, measures, olap
from saleskeep.operators.lookup import Lookup
from saleskeep.operators.mart import Mart
from saleskeep.operators.security import permitted_regions, visible_sales

DAYS = [date(2025, 12, 15), date(2026, 1, 10), date(2026, 1, 20), date(2026, 3, 5)]
PRODUCTS = [(1, "a", "X"), (2, "b", "X"), (3, "c", "Y"), (4, "unsold", "Z")]
REGIONS = [(1, "Lima"), (2, "Sur")]
# Sale id, day, product key, region key, quantity, total.
SALES = [
    (1, 0, 1, 1, 1, 100), (2, 1, 1, 1, 2, 200), (3, 1, 2, 2, 1, 50), (4, 2, 3, 1, 3, 250),
    (5, 3, 3, 2, 1, 300), (6, 3, 1, 1, 1, 100), (7, 3, 2, 1, 2, 100),
]


@pytest.fixture(scope="module")
def frames(spark):
    days = spark.createDataFrame([(day,) for day in DAYS], "fecha date").select(
        date_key(F.col("fecha")).alias("fecha_key"), "fecha", F.dayofmonth("fecha").alias("dia"),
        F.month("fecha").alias("mes"), F.lit("-").alias("nombre_mes"),
        F.quarter("fecha").alias("trimestre"), F.year("fecha").alias("anio"))
    products = spark.createDataFrame([(*p, True) for p in PRODUCTS], contract.DIM_PRODUCT_SCHEMA)
    regions = spark.createDataFrame([(*r, True) for r in REGIONS], contract.DIM_REGION_SCHEMA)
    rows = [
        (sale, sale, int(f"{DAYS[day]:%Y%m%d}"), product, region, quantity, Decimal(total) / quantity,
         Decimal(total), "B", datetime(2026, 9, 1))
        for sale, day, product, region, quantity, total in SALES
    ]
    return spark.createDataFrame(rows, contract.FACT_SCHEMA), days, products, regions


@pytest.fixture(scope="module", params=["small", "large"])
def mart(request, frames):
    """The same star, its dimensions broadcast or counted as too large for that."""
    if request.param == "small":
        return Mart.measured(*frames)
    fact, days, products, regions = frames
    return Mart(fact, Lookup(days, "fecha_key", False), Lookup(products, "producto_key", False),
                Lookup(regions, "region_key", False))


def rows(frame):
    return [tuple(int(v) if isinstance(v, Decimal) else v for v in row) for row in frame.collect()]


def test_flat_view(mart):
    flat = mart.flat()
    assert flat.columns == list(contract.FLAT_COLUMNS)
    assert flat.count() == len(SALES)
    sale = flat.filter("id_venta = 4").first()
    assert (sale.fecha, sale.producto, sale.categoria, sale.region, sale.trimestre) == (
        date(2026, 1, 20), "c", "Y", "Lima", 1)


def test_group_by_reports(mart):
    assert rows(olap.sales_by_region(mart)) == [("Lima", 750, 9), ("Sur", 350, 2)]
    assert rows(olap.sales_by_month_and_category(mart)) == [
        (2025, 12, "X", 100), (2026, 1, "X", 250), (2026, 1, "Y", 250), (2026, 3, "X", 200),
        (2026, 3, "Y", 300)]
    assert rows(olap.monthly_sales(mart))[0] == (2025, 12, 100, 1, 1)


def test_rollup_labels_and_order(mart):
    assert rows(olap.rollup_region_product(mart)) == [
        ("Lima", "a", 400), ("Lima", "c", 250), ("Lima", "b", 100), ("Lima", "SUBTOTAL REGIÓN", 750),
        ("Sur", "c", 300), ("Sur", "b", 50), ("Sur", "SUBTOTAL REGIÓN", 350),
        ("TOTAL GENERAL", "TODOS LOS PRODUCTOS", 1100)]


def test_cube(mart):
    cube = rows(olap.cube_region_category_month(mart))
    totals = {row[:3]: row[6] for row in cube}
    assert len(cube) == len(totals) == 28
    assert totals[(None, None, None)] == 1100
    assert totals[("Lima", None, None)] == 750
    assert totals[(None, "Y", 3)] == 300
    assert totals[("Lima", "X", 3)] == 200
    assert cube[-1] == (None, None, None, 1, 1, 1, 1100)
    assert [row[3:6] for row in cube] == sorted(row[3:6] for row in cube)


def test_grouping_sets(mart):
    got = rows(olap.selected_groupings(mart))
    assert {row[3] for row in got} == {2, 3, 4, 7}
    assert (None, None, None, 7, 1100) in got
    assert ("Sur", None, 3, 2, 300) in got
    assert (None, "X", 1, 4, 250) in got
    assert ("Sur", None, None, 3, 350) in got
    assert [row[3] for row in got] == sorted(row[3] for row in got)


def test_matrix(mart):
    matrix = olap.matrix_category_region(mart, ["Lima", "Sur"])
    assert matrix.columns == ["categoria", "Lima", "Sur"]
    assert sorted(rows(matrix)) == [("X", 500, 50), ("Y", 250, 300)]
    assert sorted(rows(olap.matrix_category_region(mart, ["Sur"]))) == [("X", 50), ("Y", 300)]


def test_cards(mart):
    card = measures.kpi_cards(mart).first()
    assert (int(card.total_ventas), card.total_unidades, card.numero_ventas) == (1100, 11, 7)
    assert card.ticket_promedio == round(1100 / 7, 6)
    sliced = measures.kpi_cards(mart, years=[2026], categories=["X"], regions=["Lima"]).first()
    assert (int(sliced.total_ventas), sliced.numero_ventas) == (400, 3)
    by_month = measures.kpi_cards(mart, years=[2025, 2026], by=["anio", "mes"]).collect()
    assert {(r.anio, r.mes): (int(r.total_ventas), r.numero_ventas) for r in by_month} == {
        (2025, 12): (100, 1), (2026, 1): (500, 3), (2026, 3): (500, 3)}
    assert measures.kpi_cards(mart, years=[]).first().numero_ventas == 0
    nothing = measures.kpi_cards(mart, regions=[]).first()
    assert (nothing.total_ventas, nothing.numero_ventas, nothing.ticket_promedio) == (None, 0, None)


def test_month_over_month_skips_no_gap(mart):
    got = rows(measures.month_over_month(mart).orderBy("anio", "mes"))
    assert got == [(2025, 12, 100, None, None), (2026, 1, 500, 100, 4.0), (2026, 3, 500, None, None)]
    by_category = rows(measures.month_over_month(mart, "categoria"))
    assert (2026, 1, "X", 250, 100, 1.5) in by_category
    assert (2026, 1, "Y", 250, None, None) in by_category


def test_regional_share(mart):
    assert sorted(rows(measures.regional_share(mart))) == [
        ("Lima", 750, 0.681818), ("Sur", 350, 0.318182)]
    by_category = {r[:2]: r[3] for r in rows(measures.regional_share(mart, "categoria"))}
    assert by_category[("X", "Sur")] == round(50 / 550, 6)


@pytest.mark.parametrize("buckets", [1, 4])
def test_product_ranking(mart, buckets):
    ranking = measures.product_ranking(mart, buckets).orderBy("posicion", "producto")
    assert [(r.producto, r.posicion) for r in ranking.collect()] == [("c", 1), ("a", 2), ("b", 3)]


def test_access_by_region(spark, mart, frames):
    access = spark.createDataFrame(
        [("a@x", "SUR", True), ("b@x", "Lima", False), ("c@x", "Lima", True), ("c@x", "Sur", True)],
        contract.ACCESS_SCHEMA)
    permitted = permitted_regions(access, frames[3])

    def total(user):
        return measures.kpi_cards(visible_sales(mart, permitted, user)).first().total_ventas

    assert [total(user) for user in ("a@x", "b@x", "c@x", None)] == [350, None, 1100, 1100]
    seen = [visible_sales(mart, permitted, user).regions.df.count() for user in ("a@x", "b@x", "c@x", None)]
    assert seen == [1, 0, 2, 2]


def test_only_needed_dimensions_are_read(frames):
    small = Mart.measured(*frames)
    plan = small.totals("region")._jdf.queryExecution().optimizedPlan().toString()
    assert "producto_key" not in plan.split("Join")[0] and "fecha" not in plan.split("Join")[0]
    assert plan.count("Join") == 1
    assert small.totals()._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0


def test_broken_keys_are_counted(frames):
    fact, days, products, regions = frames
    doubled = Mart.measured(fact.union(fact.filter("id_venta = 1")), days, products,
                            regions.filter("region = 'Lima'"))
    orphans = {r.constraint_name: r.orphan_rows for r in integrity.orphans(doubled).collect()}
    assert orphans == {"fk_fact_fecha": 0, "fk_fact_producto": 0, "fk_fact_region": 2}
    twice = {r.constraint_name: r.violations for r in integrity.unique_violations(doubled).collect()}
    assert {name for name, n in twice.items() if n} == {"fact_ventas.id_venta", "fact_ventas.venta_key"}


def test_repeated_sales_count_once(frames):
    fact, *dimensions = frames
    once, twice = (Mart.measured(f, *dimensions) for f in (fact, fact.union(fact.filter("id_venta < 4"))))
    assert measures.distinct_sales(twice).first()[0] == 7 < twice.fact.count()
    for by in (("region",), ("anio", "categoria"), ("producto",)):
        assert sorted(measures.distinct_sales(twice, by=by).collect()) == sorted(measures.distinct_sales(once, by=by).collect())
        cards = {tuple(r[c] for c in by): r.numero_ventas for r in measures.kpi_cards(once, by=by).collect()}
        assert {tuple(r[c] for c in by): r.numero_ventas_distintas for r in measures.distinct_sales(twice, by=by).collect()} == cards
    assert measures.distinct_sales(twice, years=[2026], categories=["X"], regions=["Lima"]).first()[0] == 3
    assert measures.distinct_sales(twice, regions=[]).first()[0] == 0
    apart = fact.limit(2).drop("id_venta").crossJoin(fact.sparkSession.createDataFrame([(-40_000,), (-7,), (0,), (7,), (40_000,)], "id_venta long"))
    assert measures.distinct_sales(Mart.measured(apart.select(fact.columns), *dimensions)).first()[0] == 5


def test_distinct_sales_shuffle_ids_alone(mart):
    """Not a bitmap of 4 KB for each slice and run of ids that a task holds an id of."""
    found = measures.distinct_sales(mart, by=("region", "anio", "mes"))
    assert "bitmap" not in found._jdf.queryExecution().executedPlan().toString()
