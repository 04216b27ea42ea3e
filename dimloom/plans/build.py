"""Build the three tables, then check and profile them (the source project's run / test /
catalog cycle).

Intermediate tables are written first and read back, so ``dim_users`` scans the stored
location and attribution tables instead of recomputing them.  Every write publishes a new version
of its target (full rebuild; see ``sinks``); descriptions are persisted as column metadata.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality as Q
from ..operators.attributions import first_attribution, most_rows_of_a_key, stored_attribution_keys, user_attributions
from ..operators.joins import DEFAULT_HOT_ROWS, HOT_ROWS_CONF, has_hot_key
from ..operators.locations import locations_clean
from ..operators.profile import parquet_folder, table_profile
from ..operators.users import dim_users
from ..sources.layout import file_at
from ..sources.schemas import OUTPUT_COMMENTS
from ..sources.sinks import read_table, write_table

#: The key that each model is laid out by, and whether it has one row for each value.
KEYS = {"locations_clean": ("from_location_id", True), "user_attributions": ("user_id", False), "dim_users": ("user_id", True)}
MODELS = ("locations_clean", "user_attributions", "dim_users")


def build(spark: SparkSession, T: Mapping[str, DataFrame], out_dir: str,
          as_of: dt.date | None = None, buckets: int | None = None) -> dict[str, DataFrame]:
    """Write ``locations_clean``, ``user_attributions`` and ``dim_users`` under ``out_dir``, each laid out
    by its key in ``buckets`` (default: the session's shuffle partitions).

    The narrow rows of ``user_attributions`` are stored while it is made: they tell whether a person can have so
    many rows that the table may not be laid out, so the wide rows are written once.  Only where one may,
    the written table decides (see ``sinks``).
    """
    out = out_dir.rstrip("/")

    def publish(df: DataFrame, name: str, cold: bool = False) -> DataFrame:
        key, unique = KEYS[name]
        write_table(df, f"{out}/{name}", OUTPUT_COMMENTS, cluster_by=key, buckets=buckets, unique=unique or cold)
        return read_table(spark, f"{out}/{name}")

    locs = publish(locations_clean(T), "locations_clean")
    place = f"{out}/_attribution_keys/{uuid.uuid4().hex}"
    keys = stored_attribution_keys(T, place)
    hot_rows = int(spark.conf.get(HOT_ROWS_CONF, None) or DEFAULT_HOT_ROWS)
    cold = not has_hot_key(keys, KEYS["user_attributions"][0], -(-hot_rows // most_rows_of_a_key(T)))
    attrs = publish(user_attributions(T, keys), "user_attributions", cold)
    fs, folder = file_at(spark, place)
    fs.delete(folder, True)
    publish(dim_users(T, as_of, locations=locs, attribution=first_attribution(attrs)), "dim_users")
    return read_models(spark, out)


def read_models(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The published versions of the models under ``out_dir``."""
    return {name: read_table(spark, f"{out_dir.rstrip('/')}/{name}") for name in MODELS}


def check(T: Mapping[str, DataFrame], models: Mapping[str, DataFrame]) -> DataFrame:
    """The 21 declared checks over the sources and the built tables."""
    return Q.run_checks(ChainMap(dict(models), T), Q.full_suite())


def catalog(T: Mapping[str, DataFrame], models: Mapping[str, DataFrame]) -> DataFrame:
    """Column profile of the sources and the built tables; stored tables answer from their footers."""
    tables = {**T, **models}
    return table_profile(tables, {name: folder for name, df in tables.items() if (folder := parquet_folder(df))})
