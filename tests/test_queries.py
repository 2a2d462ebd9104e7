"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from check_oracle import compare, oracle_connection
from tests.conftest import SF
from tripmill.registry import QUERIES


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    difference, rows = compare(spark, oracle, name, SF)
    assert difference is None
    assert rows > 0


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.count() == 10 and result.columns[0] == "zone"
