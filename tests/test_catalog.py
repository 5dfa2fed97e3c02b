"""Every query with a SQL twin, compared the way the correctness gate does."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    problem = compare(entry.queries()[name](spark, SF), con, ORACLES[name])
    assert problem is None, problem


def test_entry_has_rows_and_names(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"city", "timestamp", "lag_24h_aqi", "rolling_3h_std_aqi", "aqi_change_rate", "is_weekend"} <= set(df.columns)
