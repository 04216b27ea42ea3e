"""D — one profile row per person, with place and attribution.

``dim_users`` chooses the person row and the attribution *before* joining: ranking the
fan-out of (person rows x attributions) and keeping the first gives the same row as
keeping the first person row and then the first attribution, because the order compares
all person columns before any attribution column and the place join cannot fan out.
The literal form (``enriched_users`` + rank) is kept for tests and as the D8 query.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.profile import (
    account_status,
    age_years,
    gender_category,
    is_test_user,
    race_category,
    user_type_name,
)
from ..session import ensure_checkpoint_dir
from ..sources.schemas import DIM_USERS_COLUMNS, ENRICHED_COLUMNS, USER_PROFILE_COLUMNS
from .attributions import ATTRIBUTION_ORDER, best_attribution, most_rows_of_a_key, stored_attribution_keys, user_attributions
from .joins import DEFAULT_HOT_ROWS, HOT_ROWS_CONF, left_join_fanout, skew_join
from .locations import locations_clean
from .topk import order_by, top1

Tables = Mapping[str, DataFrame]

# The source's ranking keys (latest join, active first, then email and first name,
# descending, nulls last) followed by every other output column of the person so that
# the choice is deterministic.
USER_ORDER = (
    ("date_joined", "desc"),
    ("is_active", "desc"),
    ("email", "desc"),
    ("first_name", "desc"),
    ("uuid", "asc"),
    ("last_name", "asc"),
    ("user_type", "asc"),
    ("race_ethnicity", "asc"),
    ("gender", "asc"),
    ("self_describe_gender", "asc"),
    ("is_staff", "asc"),
    ("age", "asc"),
    ("location_id", "asc"),
)

LOCATION_FIELDS = ("country", "state", "county", "city", "city_latitude", "city_longitude")


def user_profile(T: Tables, as_of: dt.date | None = None, age_mode: str = "as_coded") -> DataFrame:
    """D6: derived fields on every person row (no de-duplication)."""
    u = T["user_core"]
    return u.select(
        F.col("id").alias("user_id"), "uuid", "first_name", "last_name", "email",
        F.col("type").alias("user_type"),
        user_type_name("type").alias("user_type_name"),
        is_test_user("first_name", "last_name", "email").alias("is_test_user"),
        "race_ethnicity",
        race_category("race_ethnicity").alias("race"),
        "gender", "self_describe_gender",
        gender_category("gender").alias("gender_sum"),
        "date_joined", "is_active",
        account_status("is_active").alias("account_status"),
        "is_staff",
        age_years("birthday", as_of, age_mode).alias("age"),
        "location_id",
    ).select(*USER_PROFILE_COLUMNS)


def _with_location(people: DataFrame, locations: DataFrame, keys_from: DataFrame | None = None) -> DataFrame:
    loc = locations.select(F.col("from_location_id").alias("loc_key"), *LOCATION_FIELDS)
    src = (keys_from, "location_id") if keys_from is not None else None
    return skew_join(people, loc, "location_id", "loc_key", "left", keys_from=src).drop("loc_key")


def _mask_sponsor(df: DataFrame) -> DataFrame:
    """D9: independent learners never show a sponsor name (the id and codes stay)."""
    return df.withColumn("sponsor_name", F.when(F.col("user_type") == "IL", F.lit(None).cast("string"))
                         .otherwise(F.col("sponsor_name")))


def enriched_users(T: Tables, as_of: dt.date | None = None, locations: DataFrame | None = None,
                   attributions: DataFrame | None = None) -> DataFrame:
    """D8 + D9: every person row x every attribution row (literal form, fans out).

    Without given attributions their narrow keys are stored: hot persons are counted on those, and the
    wide rows are made once.
    """
    locs = locations if locations is not None else locations_clean(T)
    attrs, keys_from, hot_rows = attributions, None, None
    if attrs is None:
        spark = T["user_core"].sparkSession
        keys = stored_attribution_keys(T, f"{ensure_checkpoint_dir(spark).rstrip('/')}/dimloom-keys/{uuid.uuid4().hex}")
        attrs, keys_from = user_attributions(T, keys), (keys, "user_id")
        hot_rows = -(-int(spark.conf.get(HOT_ROWS_CONF, None) or DEFAULT_HOT_ROWS) // most_rows_of_a_key(T))
    people = _with_location(user_profile(T, as_of), locs)
    a = attrs.withColumnRenamed("user_id", "a_user_id")
    joined = left_join_fanout(people, a, "user_id", "a_user_id", hot_rows, keys_from=keys_from).drop("a_user_id")
    return _mask_sponsor(joined).select(*ENRICHED_COLUMNS)


def dim_users_literal(T: Tables, as_of: dt.date | None = None) -> DataFrame:
    """D10 literal: rank the enriched fan-out and keep the first row (test oracle)."""
    enriched = enriched_users(T, as_of)
    return (top1(enriched, ["user_id"], order_by(USER_ORDER + ATTRIBUTION_ORDER))
            .withColumn("rn", F.lit(1).cast("long")).select(*DIM_USERS_COLUMNS))


def dim_users(T: Tables, as_of: dt.date | None = None, locations: DataFrame | None = None,
              attribution: DataFrame | None = None) -> DataFrame:
    """D11: one row per person id, 34 columns."""
    locs = locations if locations is not None else locations_clean(T)
    best = attribution if attribution is not None else best_attribution(T)
    person = top1(user_profile(T, as_of), ["user_id"], order_by(USER_ORDER))
    # one row a person on both sides; people, and stored attributions, lie by user id out of their window
    a = best.withColumnRenamed("user_id", "a_user_id")
    out = person.join(a, F.col("user_id") == F.col("a_user_id"), "left").drop("a_user_id")
    out = _with_location(out, locs, keys_from=T["user_core"])
    return _mask_sponsor(out).withColumn("rn", F.lit(1).cast("long")).select(*DIM_USERS_COLUMNS)
