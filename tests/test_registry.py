"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tallyloom.plans.oracles import SQL as ORACLES
from tallyloom.plans.registry import QUERIES
from tests.compare import difference, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry_offers_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    rows = entry.entry(spark)
    assert "anomaly_score" in rows.columns and rows.count() > 0
