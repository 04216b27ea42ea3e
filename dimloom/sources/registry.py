"""Table registry: name -> DataFrame for the 13 declared sources.

A registry is a plain mapping, so callers can build it from parquet folders, catalog
tables, the adapter over the benchmark tables, or in-memory fixtures.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .layout import read_stored
from .schemas import SOURCE_NAMES, SOURCE_SCHEMAS

Tables = Mapping[str, DataFrame]


def conform(df: DataFrame, name: str) -> DataFrame:
    """Project ``df`` onto the declared schema of source ``name`` (order, types, comments).

    Missing columns are an error; extra columns are dropped so the scan reads only what
    the declared schema names (column pruning reaches the file reader).
    """
    schema = SOURCE_SCHEMAS[name]
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"source {name!r} lacks columns {missing}")
    return df.select([
        F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields
    ])


def load_parquet(spark: SparkSession, folder: str, names: tuple[str, ...] = SOURCE_NAMES) -> dict[str, DataFrame]:
    """Read ``{folder}/{name}`` (parquet) for each source and conform it to its declared schema.

    A folder that is laid out by a key (see ``layout``) is read with its layout.
    The files' own schema is read first, so a missing column is an error, not a column of nulls.
    """
    return {name: conform(read_stored(spark, f"{folder}/{name}"), name) for name in names}


def load_catalog(spark: SparkSession, database: str, names: tuple[str, ...] = SOURCE_NAMES) -> dict[str, DataFrame]:
    """Read the sources from catalog tables ``database.name``."""
    return {name: conform(spark.table(f"{database}.{name}"), name) for name in names}


def from_rows(spark: SparkSession, rows: Mapping[str, list[tuple]]) -> dict[str, DataFrame]:
    """Build a registry from literal rows (test fixtures); absent tables are empty."""
    return {
        name: spark.createDataFrame(list(rows.get(name, [])), SOURCE_SCHEMAS[name])
        for name in SOURCE_NAMES
    }
