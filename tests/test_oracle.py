"""Every registered query of the library against DuckDB, value by value."""

import pytest
from compare import connect, differences
from conftest import SF_DIR

from __spark_entry__ import entry, oracle_sql, queries
from admetrics.plans.registry import QUERIES
from oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert differences(spark, con, SF_DIR, name) == []


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_queries_are_registered():
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    report = entry(spark)
    assert report.columns[:2] == ["campaign_name", "channel_name"]
    assert report.count() == 40
