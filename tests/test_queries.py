"""Every registered query against its SQL, over the whole small tables."""

import pytest

import __spark_entry__ as entry
from verification.catalog import ORACLES, QUERIES
from verification.compare import connect, differences


@pytest.fixture(scope="module")
def duck(small_folder):
    return connect(small_folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, small_folder, duck):
    assert differences(spark, duck, QUERIES[name], ORACLES[name], small_folder) == []


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns[:2] == ["customer_name", "usage_month"]
    assert 0 < result.count() <= 12


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()
