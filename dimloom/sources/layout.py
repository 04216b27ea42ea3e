"""Stored tables laid out by a join key: Parquet files in buckets by a hash of the key, sorted within.

Joins, aggregates and top-1 windows on the key of tables with equally many buckets need no exchange.
A layout is described by a file ``_layout`` in the table's folder, so any application finds it: a reader
declares the folder as a bucketed catalog table under a name made from the folder and reads that.  The
description holds the schema too, since a table without rows has no file.

A bucket is written and read by one task, so a key that holds very many rows would make a task that
nothing can split.  ``lay_out`` therefore refuses tables with a hot key (see ``operators.joins``);
they stay plain, and their joins are salted as always.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

LAYOUT = "_layout"
#: Spark's own bound on buckets (``spark.sql.sources.bucketing.maxBuckets``).
MAX_BUCKETS = 100_000


def file_at(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``: whatever store Spark itself reads."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def quoted(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def default_buckets(spark: SparkSession) -> int:
    """As many buckets as shuffle partitions, so that shuffled rows meet a laid-out side where it lies."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)


def table_name(folder: str) -> str:
    return f"dimloom_layout_{hashlib.sha1(folder.rstrip('/').encode()).hexdigest()[:24]}"


def write_laid_out(df: DataFrame, folder: str, key: str, buckets: int | None = None) -> None:
    """Write ``df`` to ``folder`` in buckets by ``key``: one file a bucket, sorted by the key."""
    spark = df.sparkSession
    n = buckets or default_buckets(spark)
    name = table_name(folder)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(n, key).write.mode("overwrite").format("parquet").option("path", folder)
     .bucketBy(n, key).sortBy(key).saveAsTable(name))
    fs, place = file_at(spark, f"{folder.rstrip('/')}/{LAYOUT}")
    out = fs.create(place, True)
    out.writeBytes(json.dumps({"key": key, "buckets": n, "schema": spark.table(name).schema.jsonValue()}) + "\n")
    out.close()


def _described(spark: SparkSession, folder: str) -> dict | None:
    fs, place = file_at(spark, f"{folder.rstrip('/')}/{LAYOUT}")
    if not fs.exists(place):
        return None
    opened = fs.open(place)
    try:
        return json.loads(opened.readLine())
    finally:
        opened.close()


def layout_of(spark: SparkSession, folder: str) -> tuple[str, int] | None:
    """(key, buckets) of the table in ``folder``; None for a plain one."""
    found = _described(spark, folder)
    return found and (found["key"], found["buckets"])


def read_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The Parquet table in ``folder``, with its layout if it has one."""
    found = _described(spark, folder)
    if found is None:
        return spark.read.parquet(folder)
    key, buckets = found["key"], found["buckets"]
    name = table_name(folder)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {quoted(f.metadata['comment'])}" if f.metadata.get("comment") else "")
                            for f in StructType.fromJson(found["schema"]).fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                  f"INTO {buckets} BUCKETS LOCATION {quoted(folder)}")
    return spark.table(name)


def forget(spark: SparkSession, folder: str) -> None:
    """Take back the declaration of a folder that is about to go; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {table_name(folder)}")


def lay_out(df: DataFrame, folder: str, key: str, buckets: int | None = None, rows: DataFrame | None = None) -> bool:
    """Write ``df`` in buckets by ``key`` unless a key is hot; says whether it did.

    ``rows`` is a cheaper relation with the same keys to look for hot ones in (default: ``df``).
    """
    from ..operators.joins import has_hot_key

    if has_hot_key(df if rows is None else rows, key):
        return False
    write_laid_out(df, folder, key, buckets)
    return True
