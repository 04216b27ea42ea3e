"""Tables laid out by a join key: no exchange on the key, the same rows, plain where a key is hot."""

import os
import re

import pytest
from pyspark.sql import functions as F

from helpers import srt
from reference_fixture import AS_OF
from test_plans import plan

from dimloom.operators.attributions import first_attribution
from dimloom.operators.joins import has_hot_key
from dimloom.operators.users import dim_users
from dimloom.plans.build import build
from dimloom.sources.layout import layout_of, read_stored, table_name
from dimloom.sources.sinks import current_version, read_table, remove_old_versions, write_table

SF = os.environ.get("DIMLOOM_TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df, column):
    """Shuffles by ``column`` in the plan of ``df``."""
    return re.findall(rf"hashpartitioning\({column}#", plan(df))


@needs_data
def test_people_meet_their_attribution_without_an_exchange(spark, tmp_path, no_broadcast):
    from dimloom.sources.adapters import sources_from_driver

    T = sources_from_driver(spark, SF)
    models = build(spark, T, str(tmp_path), AS_OF)
    found = dim_users(T, AS_OF, locations=models["locations_clean"], attribution=first_attribution(models["user_attributions"]))
    p = plan(found)
    # people and attributions are ranked and joined where they lie; only places are reached by a shuffle
    assert p.count("Bucketed: true") >= 2
    assert not exchanges(found, "user_id") and not exchanges(found, "id")
    assert len(exchanges(found, "location_id")) == 1
    assert srt(found.collect()) == srt(dim_users(T, AS_OF).collect()) == srt(models["dim_users"].collect())


@needs_data
def test_staged_people_and_their_join_records_lie_by_person(spark, no_broadcast):
    from dimloom.sources.adapters import adapted_sources, sources_from_driver

    T, plain = sources_from_driver(spark, SF), adapted_sources(spark, SF)
    joined = [x["user_join_record"].join(x["user_core"], F.col("user_id") == x["user_core"]["id"]).select("user_id", "sponsor_invite_code_id", "uuid") for x in (T, plain)]
    assert "hashpartitioning" not in plan(joined[0]) and "hashpartitioning" in plan(joined[1])
    assert srt(joined[0].collect()) == srt(joined[1].collect())


def test_another_application_finds_the_layout(spark, tmp_path):
    """The layout is read from the table's folder: a session that does not know the table declares it."""
    path = str(tmp_path / "t")
    df = spark.range(1000).select((F.col("id") % 300).cast("string").alias("k"), F.col("id").alias("v"), F.struct(F.lit("it's").alias("s")).alias("nested"))
    write_table(df, path, {"k": "the key's \\ text"}, cluster_by="k", buckets=4)
    folder = current_version(spark, path)
    assert layout_of(spark, folder) == ("k", 4)
    spark.sql(f"DROP TABLE {table_name(folder)}")
    back = read_table(spark, path)
    assert srt(back.select("k", "v").collect()) == srt(df.select("k", "v").collect()) and back.columns == df.columns
    assert back.schema["k"].metadata["comment"] == "the key's \\ text"
    assert "hashpartitioning" not in plan(back.groupBy("k").count())
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) <= 4


def test_a_table_with_a_hot_key_stays_plain(spark, tmp_path):
    spark.conf.set("spark.dimloom.skew.hotKeyRows", "100")
    try:
        for i, hot in enumerate((F.lit("a"), F.lit(None).cast("string"))):
            path = str(tmp_path / f"t{i}")
            df = spark.range(600).select(F.when(F.col("id") < 200, hot).otherwise(F.col("id").cast("string")).alias("k"), "id")
            assert has_hot_key(df, "k") and not has_hot_key(df, "id")
            write_table(df, path, cluster_by="k")
            assert layout_of(spark, current_version(spark, path)) is None and read_table(spark, path).count() == 600
            write_table(df, path, cluster_by="id")
            assert layout_of(spark, current_version(spark, path))[0] == "id" and read_table(spark, path).count() == 600
            remove_old_versions(spark, path, keep=1)
            assert len(os.listdir(f"{path}/_versions")) == 1 and read_table(spark, path).count() == 600
    finally:
        spark.conf.unset("spark.dimloom.skew.hotKeyRows")


def test_empty_tables_and_wrong_calls(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(0), path, cluster_by="id")
    assert read_table(spark, path).count() == 0
    write_table(spark.range(5), path, cluster_by="id", unique=True)
    assert sorted(r.id for r in read_stored(spark, current_version(spark, path)).collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="not both"):
        write_table(spark.range(5), path, partition_by=("id",), cluster_by="id")
