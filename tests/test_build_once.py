"""The build stores the narrow attribution keys and writes the wide attributions once."""

import datetime as dt
import os

from pyspark.sql import functions as F

from helpers import srt
from test_staging import _write

from dimloom.operators.attributions import attribution_keys, most_rows_of_a_key, user_attributions
from dimloom.plans import build as B
from dimloom.sources import sinks
from dimloom.sources.adapters import sources_from_driver
from dimloom.sources.layout import layout_of


def test_wide_attributions_are_written_once(spark, tmp_path, monkeypatch):
    T = sources_from_driver(spark, _write(spark, tmp_path / "sf"))
    keys = attribution_keys(T)
    assert srt(user_attributions(T, keys).collect()) == srt(user_attributions(T).collect())
    per_key = user_attributions(T).groupBy("user_id", "classroom_id").count().agg(F.max("count")).first()[0]
    assert 1 < most_rows_of_a_key(T) and per_key <= 2 * most_rows_of_a_key(T)  # an educator's and a learner's
    plain = []
    whole = sinks._clustered_version
    monkeypatch.setattr(sinks, "_clustered_version", lambda df, path, *more: plain.append(path) or whole(df, path, *more))
    as_of = dt.date(2026, 3, 10)
    models = B.build(spark, T, str(tmp_path / "cold"), as_of)
    assert plain == [] and layout_of(spark, sinks.current_version(spark, str(tmp_path / "cold" / "user_attributions")))[0] == "user_id"
    assert os.listdir(tmp_path / "cold" / "_attribution_keys") == []
    spark.conf.set("spark.dimloom.skew.hotKeyRows", "3")  # persons have more rows than that: the table stays plain
    try:
        hot = B.build(spark, T, str(tmp_path / "hot"), as_of)
        assert len(plain) == 1 and layout_of(spark, sinks.current_version(spark, str(tmp_path / "hot" / "user_attributions"))) is None
        for name in B.MODELS:
            assert srt(hot[name].collect()) == srt(models[name].collect()), name
    finally:
        spark.conf.unset("spark.dimloom.skew.hotKeyRows")


def test_enriched_users_make_the_wide_rows_once(spark, tmp_path, monkeypatch):
    """The plan reads the stored keys once, with no hot person; with hot ones the rows are the same."""
    from dimloom.operators import users as U

    T = sources_from_driver(spark, _write(spark, tmp_path))
    made = []
    whole = U.user_attributions
    monkeypatch.setattr(U, "user_attributions", lambda T, keys=None: made.append(keys) or whole(T, keys))
    as_of = dt.date(2026, 3, 10)
    cold = U.enriched_users(T, as_of)
    plan = cold._jdf.queryExecution().optimizedPlan().toString()
    rows = srt(cold.collect())
    assert len(made) == 1 and "dimloom-keys" in made[0].inputFiles()[0]
    assert plan.count("Relation [route#") == 1 and "LeftAnti" not in plan
    literal = U.enriched_users(T, as_of, attributions=whole(T))
    assert rows == srt(literal.collect()) and len(rows) > T["user_core"].count()
    spark.conf.set("spark.dimloom.skew.hotKeyRows", "3")
    try:
        hot = U.enriched_users(T, as_of)
        assert "LeftAnti" in hot._jdf.queryExecution().optimizedPlan().toString()
        assert srt(hot.collect()) == rows
    finally:
        spark.conf.unset("spark.dimloom.skew.hotKeyRows")
