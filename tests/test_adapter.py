"""The benchmark adapter is linear: each source is bounded by a constant times its input."""

import os

import pytest

from dimloom.sources.adapters import adapted_sources, read_driver_tables

SF = os.environ.get("DIMLOOM_TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


def test_source_sizes_are_linear_in_the_inputs(spark):
    D = {k: v.count() for k, v in read_driver_tables(spark, SF).items()}
    S = {k: v.count() for k, v in adapted_sources(spark, SF).items()}
    c, s, p, n, r = D["customer"], D["supplier"], D["part"], D["nation"], D["region"]
    assert c <= S["user_core"] <= 1.1 * c + 1
    assert r + 2 * n + s + c <= S["location_core"] <= r + 2 * n + s + c + c // 90 + 1
    assert S["location_address_components"] == 6 * c + 3 * n
    assert r + 2 * n + s + c <= S["location_type"] <= r + 3 * n + s + c
    assert S["user_join_record"] == D["orders"]
    assert D["lineitem"] <= S["learner_classroom_membership"] + S["educator_classroom_membership"] <= 2 * D["lineitem"]
    assert S["classroom"] == p and S["classroom_invite_code"] == p
    assert S["user_site"] == s and S["sponsor_invite_code"] == s and S["user_sponsor"] <= s
    assert S["educator_invitation_record"] == D["events"]


def test_joined_keys_cover_their_targets(spark):
    """No join is confined to a fixed prefix: every site, code and classroom is referred to."""
    S = adapted_sources(spark, SF)
    for table, column, target in (("classroom", "site_id", "user_site"), ("user_join_record", "sponsor_invite_code_id", "sponsor_invite_code"),
                                  ("educator_invitation_record", "classroom_id", "classroom")):
        used = S[table].select(column).distinct()
        missed = S[target].join(used, S[target]["id"] == used[column], "left_anti").count()
        assert missed == 0, (table, missed)


def test_address_links_to_at_most_three_cities(spark):
    comps = adapted_sources(spark, SF)["location_address_components"]
    per_place = (comps.where("to_location_id LIKE 'city%'").groupBy("from_location_id").count()
                 .agg({"count": "max"}).collect()[0][0])
    assert per_place <= 3


def test_model_invariants(spark):
    """One row per place with coordinates; one row per distinct person id."""
    import __spark_entry__ as E

    from dimloom.sources.adapters import sources_from_driver

    T = sources_from_driver(spark, SF)
    q = E.queries()
    with_coords = T["location_core"].where("latitude IS NOT NULL AND longitude IS NOT NULL").select("id").distinct().count()
    locs = q["loc_clean"](spark, SF)
    assert locs.count() == with_coords == locs.select("from_location_id").distinct().count()
    people = T["user_core"].select("id").distinct().count()
    dim = q["dim_users"](spark, SF)
    assert dim.count() == people == dim.select("user_id").distinct().count()


def test_changed_inputs_are_staged_anew(spark, tmp_path):
    import shutil
    import time

    from dimloom.sources.adapters import DRIVER_COLUMNS, sources_from_driver

    for name in DRIVER_COLUMNS:
        shutil.copyfile(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    before = sources_from_driver(spark, str(tmp_path))["user_core"].count()
    time.sleep(1.1)
    half = spark.read.parquet(f"{SF}/customer.parquet").where("c_custkey < 10").toPandas()
    half.to_parquet(tmp_path / "customer.parquet")
    after = sources_from_driver(spark, str(tmp_path))["user_core"].count()
    assert after == 11 < before


def test_a_missing_column_is_an_error(spark, tables, tmp_path):
    from dimloom.sources import load_parquet
    from dimloom.sources.schemas import SOURCE_NAMES

    for name in SOURCE_NAMES:
        df = tables[name].drop("email") if name == "user_core" else tables[name]
        df.write.parquet(str(tmp_path / name))
    with pytest.raises(ValueError, match="email"):
        load_parquet(spark, str(tmp_path))


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from dimloom.session import ensure_checkpoint_dir

    sc = SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda *_: None), getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="shared folder"):
        ensure_checkpoint_dir(session)
