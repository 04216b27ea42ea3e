"""Physical-plan properties the design relies on (read from ``explain('formatted')``)."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as E

SF = os.environ.get("DIMLOOM_TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["loc_clean", "attr_unified", "dim_users", "user_enriched"])
def test_no_python_and_no_pairwise_joins(spark, name):
    p = plan(E.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, bad


def test_top1_is_limited_before_the_shuffle(spark):
    p = plan(E.queries()["dim_users"](spark, SF))
    assert "row_number(), 1, Partial" in p and "row_number(), 1, Final" in p


def test_filters_reach_the_scan(spark):
    p = plan(E.queries()["loc_components"](spark, SF))
    assert "In(locationtype_id, [1,3,4,7,8])" in p
    p = plan(E.queries()["attr_sponsor_join"](spark, SF))
    assert "EqualTo(action_type,userjoins)" in p
    assert "Not(EqualTo(type,IL))" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["user_race"](spark, SF))
    assert "ReadSchema: struct<id:string,uuid:string,race_ethnicity:string>" in p


def test_places_read_their_edges_once(spark):
    p = plan(E.queries()["loc_clean"](spark, SF))
    assert p.count("dimloom-sources") >= 1
    scans = [x for x in p.split("Location: ") if "location_address_components" in x.split("\n")[0]]
    assert len(scans) == 1


def test_salted_join_reads_one_stored_hot_list(spark):
    """Both sides of a salted join read the same stored table of hot keys, broadcast."""
    from dimloom.operators.joins import skew_join

    left = spark.range(2000).selectExpr("id AS lid", "CAST(id % 7 AS STRING) AS k")
    right = spark.range(50).selectExpr("CAST(id AS STRING) AS rk", "id AS rv")
    df = skew_join(left, right, "k", "rk", "left", hot_rows=100, salt_buckets=4)
    assert df.count() == 2000
    p = plan(df)
    assert p.count("dimloom-hot") >= 2 and "BroadcastExchange" in p
    assert len({x.split("dimloom-hot/")[1][:32] for x in p.split("Location: ") if "dimloom-hot/" in x}) == 1


def test_attributions_are_planned_in_one_pass(spark):
    """All routes meet in one union and one join with the context: no table is scanned for each route."""
    p = plan(E.queries()["attr_unified"](spark, SF))
    tree = p.split("\n\n\n")[0]
    assert tree.count("Scan parquet") <= 15
    assert "LeftAnti" not in p


def test_checks_read_each_table_once(spark):
    """All 21 checks: one scan a table that has any, and no window or join over its rows."""
    p = plan(E.queries()["dq_suite"](spark, SF)).split("\n\n\n")[0]
    assert p.count("Scan parquet") == 10  # seven sources and three models
    assert "SortMergeJoin" not in p
