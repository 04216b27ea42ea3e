"""Hot-key salting gives the same rows as a plain join, for inner and left joins."""

from helpers import srt
import pytest
from pyspark.sql import functions as F

from dimloom.operators.joins import hot_keys, left_join_fanout, skew_join


@pytest.fixture()
def forced(spark):
    """Make every key with 3+ rows hot."""
    spark.conf.set("spark.dimloom.skew.hotKeyRows", "3")
    spark.conf.set("spark.dimloom.skew.saltBuckets", "4")
    yield
    for k in ("hotKeyRows", "saltBuckets"):
        spark.conf.unset(f"spark.dimloom.skew.{k}")


def _frames(spark):
    left = spark.createDataFrame(
        [(i, "hot" if i % 3 else ("cold" if i % 2 else None)) for i in range(60)], "lid int, lk string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("cold", 3), ("other", 4)], "rk string, rv int")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_equals_plain(spark, forced, how):
    left, right = _frames(spark)
    assert {r["__hot_key"] for r in hot_keys(left, "lk", 3).collect()} == {"hot", "cold"}
    got = srt(skew_join(left, right, "lk", "rk", how).collect())
    want = srt(left.join(right, F.col("lk") == F.col("rk"), how).collect())
    assert got == want


def test_fanout_left_join(spark, forced):
    left, right = _frames(spark)
    got = srt(left_join_fanout(right, left, "rk", "lk").collect())
    want = srt(right.join(left, F.col("rk") == F.col("lk"), "left").collect())
    assert got == want


def test_pipeline_same_with_forced_salting(spark, tables, forced):
    from reference_fixture import AS_OF

    from dimloom.operators import attributions as A
    from dimloom.operators import locations as L
    from dimloom.operators import users as U

    salted = (srt(L.locations_clean(tables).collect()), srt(A.user_attributions(tables).collect()),
              srt(U.dim_users(tables, AS_OF).collect()))
    spark.conf.set("spark.dimloom.skew.salting", "false")
    try:
        plain = (srt(L.locations_clean(tables).collect()), srt(A.user_attributions(tables).collect()),
                 srt(U.dim_users(tables, AS_OF).collect()))
    finally:
        spark.conf.unset("spark.dimloom.skew.salting")
    assert salted == plain


def test_hot_key_in_a_third_of_the_rows(spark):
    """Only the hot key is salted and every match is returned."""
    left = spark.range(30000).selectExpr("id AS lid", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS lk")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("7", 3)], "rk string, rv int")
    assert {r["__hot_key"] for r in hot_keys(left, "lk", 5000).collect()} == {"hot"}
    got = skew_join(left, right, "lk", "rk", "left", hot_rows=5000, salt_buckets=16)
    assert got.count() == 20000 + 2 * 10000
    assert got.where("rv IS NOT NULL").count() == 2 * 10000 + 1


def test_one_repeated_row_spreads_over_all_buckets(spark):
    """The salt is the row's position, so copies of one row do not share a bucket."""
    left = spark.range(4000).selectExpr("'hot' AS lk", "'same' AS lv")
    right = spark.createDataFrame([("hot", 1)], "rk string, rv int")
    joined = skew_join(left, right, "lk", "rk", "inner", hot_rows=100, salt_buckets=16)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" in plan
    salts = left.selectExpr("pmod(monotonically_increasing_id(), 16) AS salt").groupBy("salt").count().collect()
    assert len(salts) == 16 and max(r["count"] for r in salts) <= 2 * 4000 / 16
    assert joined.count() == 4000


def test_no_salt_without_a_hot_key(spark):
    left = spark.range(100).selectExpr("CAST(id AS STRING) AS lk")
    right = spark.createDataFrame([("7", 3)], "rk string, rv int")
    assert hot_keys(left, "lk", 50) is None
    plan = skew_join(left, right, "lk", "rk", "left", hot_rows=50)._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" not in plan


def test_summary_names_the_keys_that_counting_names(spark, tables, monkeypatch):
    """The declared tables' sketches and an exact count list the same keys, whatever the threshold."""
    from dimloom.operators import joins as J
    from dimloom.sources.schemas import SOURCE_SCHEMAS

    rows = [(f"u{i % 40}", "userjoins", f"c{i % 9 if i % 3 else 0}") for i in range(900)] + [(None, "userjoins", None)] * 50
    fields = SOURCE_SCHEMAS["user_join_record"].fieldNames()
    wide = [tuple(dict(zip(("user_id", "action_type", "sponsor_invite_code_id"), r, strict=True)).get(f) for f in fields) for r in rows]
    table = spark.createDataFrame(wide, SOURCE_SCHEMAS["user_join_record"]).repartition(7)
    for key in ("user_id", "sponsor_invite_code_id"):
        for hot_rows in (3, 23, 100, 400, 1000):
            listed = J.hot_keys(table, key, hot_rows)
            want = {r[key] for r in table.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") >= hot_rows).collect()}
            assert (set() if listed is None else {r["__hot_key"] for r in listed.collect()}) == want
    monkeypatch.setattr(J, "SKETCH_ROWS", 0)  # the exact way for tables beyond the sketch
    J._STORED.clear()
    assert {r["__hot_key"] for r in J.hot_keys(table, "sponsor_invite_code_id", 300).collect()} == {"c0"}


def test_one_summary_a_table(spark, monkeypatch):
    """Building all models reads each declared table once for its hot keys, whatever the joins that use them."""
    import os

    from dimloom.operators import attributions as A
    from dimloom.operators import joins as J
    from dimloom.operators import users as U
    from dimloom.sources.adapters import sources_from_driver

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("benchmark tables not present")
    T = sources_from_driver(spark, "/root/testdata/sf0.001")
    made = []
    summary = J.key_summary
    monkeypatch.setattr(J, "key_summary", lambda df, keys: made.append(J._identity(df)) or summary(df, keys))
    J._SUMMARIES.clear()
    J._STORED.clear()
    A.user_attributions(T)
    U.dim_users(T)
    assert len(J._SUMMARIES) == len(set(made)) == len(J.JOIN_KEYS)


def test_hot_in_several_tables_together(spark):
    """A key with its share of the rows in one of the tables is listed."""
    one = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2, "k string")
    two = spark.createDataFrame([("a",)] * 3 + [("b",)] * 3 + [("c",)] * 5, "j string")
    assert {r["__hot_key"] for r in hot_keys(one, "k", 9, (two, "j")).collect()} == {"a", "c"}
    assert hot_keys(one, "k", 20, (two, "j")) is None


def test_summary_of_an_empty_table(spark, tables):
    from dimloom.operators import joins as J

    empty = tables["user_join_record"].where("false")
    assert J.hot_keys(empty, "user_id", 1) is None
    nulls = tables["user_join_record"].selectExpr(*[f"CAST(NULL AS STRING) AS {c}" for c in tables["user_join_record"].columns])
    assert J.hot_keys(nulls, "user_id", 1) is None
