"""Sources are staged when they are asked for, memberships of order lines together."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import srt

from dimloom.operators.profile import parquet_folder
from dimloom.plans import build as B
from dimloom.sources.adapters import DRIVER_COLUMNS, adapted_sources, sources_from_driver
from dimloom.sources.schemas import SOURCE_NAMES

TYPES = {"c_acctbal": "double", **{c: "string" for c in ("r_name", "n_name", "s_name", "p_name", "o_orderstatus", "event_type")}}


def _write(spark, folder, lines=2000, odd=False):
    """Benchmark tables of their own rows; ``odd`` adds null keys and order lines that come twice."""
    key = F.col("id")
    made = {
        "region": spark.range(5).select(key.alias("r_regionkey"), F.concat(F.lit("R"), key).alias("r_name")),
        "nation": spark.range(25).select(key.alias("n_nationkey"), F.concat(F.lit("N"), key).alias("n_name"), (key % 5).alias("n_regionkey")),
        "customer": spark.range(90).select(key.alias("c_custkey"), (key % 25).alias("c_nationkey"), (key * 1.5 - 40).alias("c_acctbal")),
        "supplier": spark.range(10).select(key.alias("s_suppkey"), F.concat(F.lit("S"), key).alias("s_name"), (key % 25).alias("s_nationkey")),
        "part": spark.range(100).select(key.alias("p_partkey"), F.concat(F.lit("P"), key).alias("p_name")),
        "orders": spark.range(700).select(key.alias("o_orderkey"), F.when(F.lit(not odd) | (key % 10 > 0), key % 90).alias("o_custkey"), F.lit("F").alias("o_orderstatus")),
        "lineitem": spark.range(lines).select((key % 700).alias("l_orderkey"), (key * 7 % 100).alias("l_partkey")),
        "events": spark.range(50).select(key.alias("event_id"), (key % 90).alias("user_id"), F.lit("signup").alias("event_type")),
    }
    for name, cols in DRIVER_COLUMNS.items():
        df = made[name].select(*[F.col(c).cast(TYPES.get(c, "long")).alias(c) for c in cols])
        (df.union(df.where("l_orderkey < 50")) if odd and name == "lineitem" else df).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def _staged(T):
    folder = T["user_sponsor"].inputFiles()[0].rsplit("/", 2)[0].replace("file://", "")
    return {f.removeprefix("_COMPLETE-") for f in os.listdir(folder) if f.startswith("_COMPLETE")}


def test_a_query_stages_what_it_reads(spark, tmp_path):
    import __spark_entry__ as E

    sf = _write(spark, tmp_path)
    E.queries()["src_sponsor_invite_code"](spark, sf).count()
    T = sources_from_driver(spark, sf)
    assert _staged(T) == {"sponsor_invite_code", "user_sponsor"}
    E.queries()["loc_city_candidates"](spark, sf).count()
    assert _staged(T) == {"sponsor_invite_code", "user_sponsor", "location_core", "location_type", "location_address_components"}
    assert list(T) and set(T) == set(SOURCE_NAMES) and "nothing" not in T
    with pytest.raises(KeyError):
        T["nothing"]


@pytest.mark.parametrize("lines, odd", [(2000, False), (2000, True), (0, False)])
def test_staged_rows_are_those_of_the_mapping(spark, tmp_path, lines, odd):
    sf = _write(spark, tmp_path, lines, odd)
    staged, plain = sources_from_driver(spark, sf), adapted_sources(spark, sf)
    for name in SOURCE_NAMES:
        assert staged[name].dtypes == plain[name].dtypes, name
        assert srt(staged[name].collect()) == srt(plain[name].collect()), name
    assert (staged["learner_classroom_membership"].count() > 0) == (lines > 0)


def test_parts_of_one_table_answer_from_footers_and_derived_tables_do_not(spark, tmp_path):
    T = sources_from_driver(spark, _write(spark, tmp_path))
    assert len(parquet_folder(T["learner_classroom_membership"])) == 2
    assert parquet_folder(T["classroom"].crossJoin(T["user_site"])) is None
    found = {(r.table_name, r.column_name): r.num_rows for r in B.catalog(dict(T), {}).collect()}
    for name in ("learner_classroom_membership", "educator_classroom_membership"):
        assert found[name, "user_id"] == T[name].count()
