"""Sinks (full rebuild with descriptions), data checks and the table profile."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import srt, with_rows
from reference_fixture import AS_OF

from dimloom.operators import quality as Q
from dimloom.operators.locations import locations_clean
from dimloom.operators.profile import table_profile
from dimloom.operators.users import dim_users
from dimloom.operators.attributions import user_attributions
from dimloom.sources import load_parquet
from dimloom.sources.schemas import OUTPUT_COMMENTS, SOURCE_NAMES
from dimloom.sources.sinks import create_view, current_version, read_table, remove_old_versions, save_table, table_descriptions, write_table


def test_write_read_back_keeps_rows_and_comments(spark, tables):
    out = tempfile.mkdtemp(prefix="dimloom-sink-", dir=os.environ.get("TMPDIR", "/tmp"))
    df = locations_clean(tables)
    write_table(df, f"{out}/locations_clean", OUTPUT_COMMENTS)
    write_table(df, f"{out}/locations_clean", OUTPUT_COMMENTS)  # overwrite, not append
    back = read_table(spark, f"{out}/locations_clean")
    assert back.count() == 9
    assert back.schema["city"].metadata["comment"] == OUTPUT_COMMENTS["city"]
    for name in SOURCE_NAMES:
        tables[name].write.parquet(f"{out}/{name}")
    T2 = load_parquet(spark, out)
    assert T2["user_core"].count() == 10
    assert create_view(df, "locations_clean_view") is df
    assert spark.sql("select count(*) c from locations_clean_view").collect()[0].c == 9


def _models(T):
    locs = locations_clean(T)
    return {**T, "locations_clean": locs, "user_attributions": user_attributions(T),
            "dim_users": dim_users(T, AS_OF, locations=locs)}


def test_reference_fixture_passes_all_21_checks(spark, tables):
    rows = Q.run_checks(_models(tables), Q.full_suite()).collect()
    assert len(rows) == 21
    assert all(r.failures == 0 for r in rows), [r for r in rows if r.failures]


def test_checks_count_violations(spark):
    core = [("a", "A", "A", 1.0, 1.0, "a"), ("a", "B", "B", 2.0, 2.0, "a"), (None, "C", "C", 3.0, 3.0, None)]
    T = with_rows(spark, location_core=core)
    got = {r.check_id: r.failures for r in Q.run_checks(T, Q.source_not_null_checks() + Q.source_unique_checks()).collect()}
    assert got["not_null:location_core:id"] == 1
    assert got["unique:location_core:id"] == 1


def test_profile_counts_rows_and_nulls(spark, tables):
    prof = {(r.table_name, r.column_name): r for r in table_profile(tables).collect()}
    r = prof[("user_core", "location_id")]
    assert (r.num_rows, r.null_count, r.column_index, r.column_type) == (10, 2, 14, "STRING")
    assert prof[("location_type", "locationtype_id")].column_type == "INT64"
    assert prof[("location_core", "latitude")].column_comment


def test_build_check_catalog_cycle(spark, tables):
    from dimloom.plans.build import build, catalog, check

    out = tempfile.mkdtemp(prefix="dimloom-build-", dir=os.environ.get("TMPDIR", "/tmp"))
    models = build(spark, tables, out, AS_OF)
    assert {k: v.count() for k, v in models.items()} == {"locations_clean": 9, "user_attributions": 7, "dim_users": 8}
    from helpers import srt
    assert srt(models["dim_users"].collect()) == srt(dim_users(tables, AS_OF).collect())
    assert all(r.failures == 0 for r in check(tables, models).collect())
    prof = catalog(tables, models)
    assert prof.where("table_name = 'dim_users'").count() == 34


def test_command_line_cycle(spark):
    from dimloom.__main__ import main

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    out = tempfile.mkdtemp(prefix="dimloom-cli-", dir=os.environ.get("TMPDIR", "/tmp"))
    code = main(["--benchmark-dir", sf, "--out", f"{out}/m", "--as-of", "2026-03-10"])
    checks = read_table(spark, f"{out}/m/_checks")
    assert checks.count() == 21
    failed = checks.where("failures > 0").count()
    assert code == (1 if failed else 0)
    assert read_table(spark, f"{out}/m/dim_users").count() == read_table(spark, f"{out}/m/dim_users").select("user_id").distinct().count()


def test_catalog_tables_round_trip(spark, tables):
    from dimloom.sources import load_catalog
    from dimloom.sources.sinks import save_table

    loc = tempfile.mkdtemp(prefix="dimloom-db-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS dimloom_test LOCATION '{loc}'")
    try:
        for name in SOURCE_NAMES:
            save_table(tables[name], f"dimloom_test.{name}")
        T = load_catalog(spark, "dimloom_test")
        assert srt(locations_clean(T).collect()) == srt(locations_clean(tables).collect())
        save_table(dim_users(T, AS_OF), "dimloom_test.dim_users", OUTPUT_COMMENTS)
        assert spark.table("dimloom_test.dim_users").count() == 8
        info = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED dimloom_test.dim_users").collect()}
        assert "one row per person" in (info.get("Comment") or "")
        assert spark.table("dimloom_test.dim_users").schema["city"].metadata["comment"] == OUTPUT_COMMENTS["city"]
    finally:
        spark.sql("DROP DATABASE IF EXISTS dimloom_test CASCADE")


def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path):
    """A job killed in the middle publishes nothing; the next one does; a running reader keeps its rows."""
    path = str(tmp_path / "t")
    write_table(spark.range(100).withColumn("v", F.lit("old")), path)
    reader, old = read_table(spark, path), current_version(spark, path)
    broken = spark.range(0, 1000, 1, 8).withColumn("v", F.when(F.col("id") == 990, F.raise_error(F.lit("executor lost"))).otherwise("new"))
    with pytest.raises(Exception, match="executor lost"):
        write_table(broken, path)
    assert current_version(spark, path) == old
    assert read_table(spark, path).where("v = 'old'").count() == 100
    write_table(spark.range(7).withColumn("v", F.lit("new")), path)
    assert read_table(spark, path).count() == 7 and current_version(spark, path) != old
    assert reader.where("v = 'old'").count() == 100
    assert not [f for f in os.listdir(path) if f.startswith("_current-")]
    gone = remove_old_versions(spark, path, keep=1)
    assert len(gone) == 2 and read_table(spark, path).count() == 7  # the old one and what the failed job left


def test_a_short_write_is_not_published(spark, tmp_path, monkeypatch):
    from dimloom.sources import sinks

    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    monkeypatch.setattr(sinks.Observation, "get", property(lambda self: {"rows": 9}))
    with pytest.raises(RuntimeError, match="published version stays"):
        write_table(spark.range(8), path)
    assert read_table(spark, path).count() == 5


def test_partitioned_and_plain_folders(spark, tmp_path):
    write_table(spark.range(10).withColumn("k", F.col("id") % 3), str(tmp_path / "p"), partition_by=("k",))
    assert read_table(spark, str(tmp_path / "p")).where("k = 1").count() == 3
    spark.range(4).write.parquet(str(tmp_path / "plain"))
    assert read_table(spark, str(tmp_path / "plain")).count() == 4 and remove_old_versions(spark, str(tmp_path / "plain")) == []


def test_catalog_table_moves_and_keeps_odd_descriptions(spark):
    loc = tempfile.mkdtemp(prefix="dimloom-db-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS dimloom_moves LOCATION '{loc}'")
    odd = "back\\slash \\n 'quoted' \"double\" and\na second line \\'"
    try:
        df = spark.range(3).withColumn("name", F.lit("x"))
        save_table(df, "dimloom_moves.t", {"id": odd}, odd)
        assert table_descriptions(spark, "dimloom_moves.t") == (odd, {"id": odd, "name": None})
        save_table(df.where("id > 0"), "dimloom_moves.t", {"id": odd}, "second")
        assert spark.table("dimloom_moves.t").count() == 2
        assert table_descriptions(spark, "dimloom_moves.t") == ("second", {"id": odd, "name": None})
        save_table(df.withColumn("more", F.lit(1)), "dimloom_moves.t", {"more": "a new column"})
        assert spark.table("dimloom_moves.t").columns == ["id", "name", "more"] and spark.table("dimloom_moves.t").count() == 3
        broken = df.withColumn("more", F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(1))
        with pytest.raises(Exception, match="lost"):
            save_table(broken, "dimloom_moves.t", {"more": "a new column"})
        assert spark.table("dimloom_moves.t").count() == 3
    finally:
        spark.sql("DROP DATABASE IF EXISTS dimloom_moves CASCADE")


def test_profile_reads_footers_only(spark, tables, tmp_path):
    """Counts of stored tables are pushed into the scan; the rows are those of a full scan."""
    for name in ("user_core", "location_core"):
        tables[name].write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in ("user_core", "location_core")}
    folders = {name: str(tmp_path / name) for name in stored}
    fast = table_profile(stored, folders)
    plan = fast._jdf.queryExecution().toString()
    assert plan.count("PushedAggregation: [COUNT") >= 2 and "FileScan" not in plan
    assert sorted(map(tuple, fast.collect()), key=str) == sorted(map(tuple, table_profile(stored).collect()), key=str)
    empty = spark.createDataFrame([], "a string, b int")
    empty.write.parquet(str(tmp_path / "empty"))
    got = table_profile({"empty": empty, "none": spark.createDataFrame([], "")}, {"empty": str(tmp_path / "empty")}).collect()
    assert sorted(map(tuple, got), key=str) == [("empty", "a", 1, "STRING", "", 0, 0), ("empty", "b", 2, "INT64", "", 0, 0), ("none", " ", 1, " ", "", None, None)]


def test_profile_scans_where_a_footer_lacks_counts(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(tmp_path / "t")
    pq.write_table(pa.table({"a": ["x", None, "y"], "b": [1, 2, None]}), str(tmp_path / "t" / "part-0.parquet"), write_statistics=False)
    df = spark.read.parquet(str(tmp_path / "t"))
    got = {r.column_name: (r.num_rows, r.null_count) for r in table_profile({"t": df}, {"t": str(tmp_path / "t")}).collect()}
    assert got == {"a": (3, 1), "b": (3, 1)}
