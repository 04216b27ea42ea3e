"""Every registered query against its independent DuckDB SQL on the sf0.001 tables."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as E
from dimloom.plans.catalog import queries as base_queries
from dimloom.plans.oracle import oracle_sql as base_sql

SF = os.environ.get("DIMLOOM_TEST_SF_DIR", "/root/testdata/sf0.001")
BASE, BASE_SQL = base_queries(), base_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")

NAMES = sorted(BASE)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(BASE) == set(BASE_SQL)
    assert set(BASE) <= set(E.queries()) and set(BASE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "user_id" and df.columns[-1] == "rn"
    assert df.count() > 0


@pytest.mark.parametrize("name", ["loc_clean", "attr_unified", "attr_sponsor_join", "dim_users"])
def test_query_matches_oracle_with_forced_salting(spark, con, name):
    """Hot-key thresholds low enough that countries, states, sites and invite codes are hot."""
    keys = {"spark.dimloom.skew.hotKeyRows": "5", "spark.dimloom.skew.saltBuckets": "8"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        ok, msg = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert ok, msg
