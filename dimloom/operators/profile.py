"""P — table profile: one row per column with its type, description, row and null counts.

Three small relations make the catalog: the tables, their columns (from the schema: driver-side metadata,
no data) and their statistics, joined on catalog, schema and table name, columns and statistics from the
left, so that a table without columns keeps its row.  Row and null counts of stored tables come from the
footers of their Parquet files: the files are read through the second version of the data source
interface, which answers ``count(*)`` and ``count(column)`` from footers, and no data page is read.  Only
tables that are not stored, or whose files lack the statistics, are scanned: one aggregate a table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.schemas import warehouse_type

PROFILE_COLUMNS = ("table_name", "column_name", "column_index", "column_type", "column_comment",
                   "num_rows", "null_count")
KEYS = ("table_catalog", "table_schema", "table_name")
CATALOG, SCHEMA = "spark_catalog", "default"

_READERS: dict[str, SparkSession] = {}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session over the same context that answers counts over Parquet files from their footers."""
    app = spark.sparkContext.applicationId
    if app not in _READERS:
        reader = spark.newSession()
        listed = (spark.conf.get("spark.sql.sources.useV1SourceList", "") or "").split(",")
        reader.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in listed if x != "parquet"))
        reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        reader.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
        _READERS[app] = reader
    return _READERS[app]


def column_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_index, num_rows, non_null): a row for each of ``columns``, from one aggregate."""
    counts = df.agg(F.count(F.lit(1)).alias("num_rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(columns)])
    entries = [F.struct(F.lit(i + 1).cast("long").alias("column_index"), F.col(f"n{i}").alias("non_null")) for i in range(len(columns))]
    return counts.select("num_rows", F.explode(F.array(*entries)).alias("e")).select("e.column_index", "num_rows", "e.non_null")


def _stored_counts(reader: SparkSession, folders: str | Sequence[str], columns: list[str]) -> DataFrame | None:
    """``column_counts`` from the footers of the files in the folder or folders; None where they lack a statistic or have no rows."""
    counts = column_counts(reader.read.parquet(*([folders] if isinstance(folders, str) else folders)), columns)
    try:
        found = counts.first()  # reads footers only
    except (PySparkException, Py4JJavaError):
        return None
    return None if found is None or found["num_rows"] is None else counts


def table_profile(tables: Mapping[str, DataFrame], folders: Mapping[str, str | Sequence[str]] | None = None) -> DataFrame:
    """The profile of ``tables``; ``folders`` names the Parquet folders (one, or several together) of those that are stored as they are."""
    spark = footer_session(next(iter(tables.values())).sparkSession)
    stats, columns = [], []
    for name, df in tables.items():
        names = df.columns
        folder = (folders or {}).get(name)
        counts = _stored_counts(spark, folder, names) if folder and names else None
        if names:
            counts = counts if counts is not None else column_counts(df, names)
            stats.append(counts.select(F.lit(CATALOG).alias("table_catalog"), F.lit(SCHEMA).alias("table_schema"),
                                       F.lit(name).alias("table_name"), "column_index", "num_rows", "non_null"))
        columns += [(CATALOG, SCHEMA, name, i, f.name, warehouse_type(f.dataType), f.metadata.get("comment", ""))
                    for i, f in enumerate(df.schema.fields, 1)]
    key = "table_catalog string, table_schema string, table_name string"
    listed = spark.createDataFrame([(CATALOG, SCHEMA, name) for name in tables], key)
    described = spark.createDataFrame(columns, f"{key}, column_index long, column_name string, column_type string, column_comment string")
    counted = stats[0] if stats else spark.createDataFrame([], f"{key}, column_index long, num_rows long, non_null long")
    for s in stats[1:]:
        counted = counted.unionByName(s)
    joined = listed.join(described, list(KEYS), "left").join(counted, [*KEYS, "column_index"], "left")
    return joined.select(
        "table_name", F.coalesce("column_name", F.lit(" ")).alias("column_name"), F.coalesce("column_index", F.lit(1)).cast("long").alias("column_index"),
        F.coalesce("column_type", F.lit(" ")).alias("column_type"), F.coalesce("column_comment", F.lit("")).alias("column_comment"),
        F.col("num_rows").cast("long").alias("num_rows"), (F.col("num_rows") - F.col("non_null")).cast("long").alias("null_count")).select(*PROFILE_COLUMNS)


def parquet_folder(df: DataFrame) -> str | list[str] | None:
    """The folder of the files that ``df`` reads, if it reads one folder of Parquet files without more,
    or its folders, if they are parts (``part=...``) of one table."""
    files = df.inputFiles()
    folders = sorted({f.rsplit("/", 1)[0] for f in files})
    if not folders or not all(f.endswith(".parquet") for f in files):
        return None
    if len(folders) == 1:
        return folders[0]
    tables = {f.rsplit("/", 1)[0] for f in folders}
    return folders if len(tables) == 1 and all(f.rsplit("/", 1)[1].startswith("part=") for f in folders) else None
