"""Query catalog: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the benchmark tables in ``sf_dir`` through the source adapter and
runs over all of their rows; none uses a sample, prefix or row cap.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections import ChainMap
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.profile import (
    account_status,
    age_years,
    gender_category,
    is_test_user,
    race_category,
    user_type_name,
)
from ..functions.geo import on_grid
from ..functions.text import coalesce_trim, is_address_like
from ..operators import attributions as A
from ..operators import locations as L
from ..operators import quality as Q
from ..operators import users as U
from ..sources.adapters import sources_from_driver
from ..session import ensure_checkpoint_dir, tune
from ..sources.schemas import ATTRIBUTION_COLUMNS, OUTPUT_COMMENTS, SOURCE_NAMES, TABLE_COMMENTS
from ..sources.sinks import create_view, read_table, save_table, table_descriptions, write_table
from .build import MODELS, build, catalog, read_models

AS_OF = dt.date(2026, 3, 10)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Callable[[dict], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(sources_from_driver(tune(spark), sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# ---- S1: the 13 declared sources
for _name in SOURCE_NAMES:
    register(f"src_{_name}")(lambda T, _n=_name: T[_n])


# ---- L
@register("loc_components")
def _loc_components(T):
    return L.location_components(T)


@register("loc_ambiguous")
def _loc_ambiguous(T):
    return L.ambiguous_locations(L.location_components(T))


def _shown(found: DataFrame) -> DataFrame:
    """Distances on the reporting grid; the operators work on the raw ones."""
    return found.withColumn("distance_from_origin", on_grid(F.col("distance_from_origin")))


@register("loc_city_candidates")
def _loc_city_candidates(T):
    comps = L.location_components(T)
    return _shown(L.city_candidates(T, comps, L.ambiguous_locations(comps)))


@register("loc_nearest_city")
def _loc_nearest_city(T):
    comps = L.location_components(T)
    return _shown(L.nearest_city(L.city_candidates(T, comps, L.ambiguous_locations(comps))))


@register("loc_address_like")
def _loc_address_like(T):
    return T["location_core"].select("id", "display_name", is_address_like("display_name").alias("is_address_like"))


@register("loc_city_override")
def _loc_city_override(T):
    return _shown(L.overrides(T, L.location_components(T)))


for _level in ("country", "state", "county", "city"):
    register(f"loc_best_{_level}")(lambda T, _lv=_level: L.best_parent(L.location_components(T), _lv))


@register("loc_flat")
def _loc_flat(T):
    return L.flat_locations(T)


@register("loc_scored")
def _loc_scored(T):
    return L.scored_locations(L.flat_locations(T))


@register("loc_clean")
def _loc_clean(T):
    return L.locations_clean(T)


# ---- A
@register("attr_context")
def _attr_context(T):
    return A.classroom_context(T)


@register("attr_learner")
def _attr_learner(T):
    return A.route_learner(T)


@register("attr_educator")
def _attr_educator(T):
    return A.route_educator(T)


@register("attr_invited")
def _attr_invited(T):
    return A.route_invited(T)


@register("attr_sponsor_join")
def _attr_sponsor_join(T):
    return A.route_sponsor_join(T).select(*ATTRIBUTION_COLUMNS)


@register("attr_unified")
def _attr_unified(T):
    return A.user_attributions(T)


# ---- D
def _people(T):
    return T["user_core"].withColumnRenamed("id", "user_id")


@register("user_type_name")
def _user_type_name(T):
    return _people(T).select("user_id", "uuid", F.col("type").alias("user_type"),
                             user_type_name("type").alias("user_type_name"))


@register("user_test_flag")
def _user_test_flag(T):
    return _people(T).select("user_id", "uuid", "first_name", "last_name", "email",
                             is_test_user("first_name", "last_name", "email").alias("is_test_user"))


@register("user_race")
def _user_race(T):
    return _people(T).select("user_id", "uuid", "race_ethnicity", race_category("race_ethnicity").alias("race"))


@register("user_gender")
def _user_gender(T):
    return _people(T).select("user_id", "uuid", "gender", "self_describe_gender",
                             gender_category("gender").alias("gender_sum"))


@register("user_status")
def _user_status(T):
    return _people(T).select("user_id", "uuid", "is_active", account_status("is_active").alias("account_status"))


@register("user_age")
def _user_age(T):
    return _people(T).select("user_id", "uuid", "birthday", age_years("birthday", AS_OF).alias("age"),
                             age_years("birthday", AS_OF, "completed").alias("age_completed"))


@register("user_profile")
def _user_profile(T):
    return U.user_profile(T, AS_OF)


@register("user_enriched")
def _user_enriched(T):
    return U.enriched_users(T, AS_OF)


@register("dim_users")
def _dim_users(T):
    return U.dim_users(T, AS_OF)


# ---- Q
_BUILT: dict[tuple[str, str], str] = {}


def _models(T) -> Mapping[str, DataFrame]:
    """The sources and the built models: each model is written once as Parquet into the shared
    folder for the staged sources it was built from, and the checks scan the columns they need."""
    spark = T["user_core"].sparkSession
    staged = T["user_core"].inputFiles()[:1]
    key = (spark.sparkContext.applicationId, staged[0] if staged else uuid.uuid4().hex)
    if key not in _BUILT:
        out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/dimloom-models/{uuid.uuid4().hex}"
        build(spark, T, out, AS_OF)
        _BUILT[key] = out
    return ChainMap(read_models(spark, _BUILT[key]), T)


@register("dq_not_null")
def _dq_not_null(T):
    return Q.run_checks(T, Q.source_not_null_checks())


@register("dq_unique")
def _dq_unique(T):
    return Q.run_checks(T, Q.source_unique_checks())


@register("dq_unique_combination")
def _dq_unique_combination(T):
    return Q.run_checks(_models(T), Q.combination_checks())


@register("dq_expression")
def _dq_expression(T):
    return Q.run_checks(_models(T), Q.expression_checks())


@register("dq_suite")
def _dq_suite(T):
    return Q.run_checks(_models(T), Q.full_suite())


# ---- P, X19
@register("table_profile")
def _table_profile(T):
    return catalog({name: T[name] for name in SOURCE_NAMES}, {})


@register("model_profile")
def _model_profile(T):
    """Type, description, rows and nulls of every column of the three built models."""
    models = _models(T)
    return catalog({}, {name: models[name] for name in MODELS})


@register("sink_round_trip")
def _sink_round_trip(T):
    """The place table written twice (a full rebuild replaces it), read back and seen through a view."""
    spark = T["location_core"].sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/dimloom-sink/{uuid.uuid4().hex}"
    for _ in range(2):
        write_table(L.locations_clean(T), path, OUTPUT_COMMENTS)
    create_view(read_table(spark, path), "dimloom_sink_round_trip")
    return spark.sql("SELECT * FROM dimloom_sink_round_trip")


@register("catalog_descriptions")
def _catalog_descriptions(T):
    """Each model saved as a catalog table: its description, its columns' and its rows, as the catalog gives them back."""
    spark = T["location_core"].sparkSession
    models, parts = _models(T), []
    for name in MODELS:
        saved = f"dimloom_{uuid.uuid4().hex}_{name}"
        save_table(models[name], saved, OUTPUT_COMMENTS, TABLE_COMMENTS[name])
        table, columns = table_descriptions(spark, saved)
        rows = [(name, table, c, text) for c, text in columns.items()]
        described = spark.createDataFrame(rows, "table_name string, table_description string, column_name string, column_description string")
        counted = spark.table(saved).agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(name).alias("table_name"), "num_rows")
        parts.append(described.join(counted, "table_name"))
    return reduce(DataFrame.unionByName, parts)


@register("coalesce_trim")
def _coalesce_trim(T):
    inv = T["educator_invitation_record"]
    return inv.select("email", "classroom_id", coalesce_trim("email", "(none)").alias("email_clean"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
