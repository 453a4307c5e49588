from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import database, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data here")


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


def test_flagship_query(spark):
    result = entry.entry(spark)
    assert result.columns == ["region", "ventas_totales", "unidades_vendidas"]
    assert result.count() == 5


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    allowed = ["no rows"] if name in ("new_products", "new_dates") else []
    assert [d for d in differences(spark, connection, SF_DIR, name) if d not in allowed] == []
