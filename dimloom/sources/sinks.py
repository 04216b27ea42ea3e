"""Sinks: full-rebuild table writes and views, with column descriptions persisted.

A rebuild never touches the rows that readers see.  Each write makes a new version folder under
``<path>/_versions``; when it is complete and reads back as many rows as were written, the file
``<path>/_current``, which names the version, is replaced in one step.  A job that fails in between
leaves the old version current; readers that opened the old version go on reading it, for it stays
until ``remove_old_versions`` is called.  Catalog tables are the same versions behind a table whose location
is moved.

A table can be laid out by a join key (``cluster_by``; see ``layout``), so that joins on it need no exchange.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .layout import file_at, forget, lay_out, quoted, read_stored, write_laid_out
from .schemas import TABLE_COMMENTS

VERSIONS, CURRENT = "_versions", "_current"


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach ``comments[col]`` as the column's ``comment`` metadata (kept by parquet and the catalog)."""
    return df.select([
        F.col(c).alias(c, metadata={**df.schema[c].metadata, "comment": comments[c]}) if c in comments else F.col(c)
        for c in df.columns
    ])


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the published version of the table at ``path``; None if nothing was published."""
    fs, pointer = file_at(spark, f"{path.rstrip('/')}/{CURRENT}")
    if not fs.exists(pointer):
        return None
    opened = fs.open(pointer)
    try:
        return f"{path.rstrip('/')}/{VERSIONS}/{opened.readLine()}"
    finally:
        opened.close()


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    """Replace the pointer in one step: a rename over the old file."""
    jvm = spark.sparkContext._jvm
    root = path.rstrip("/")
    fs, fresh = file_at(spark, f"{root}/{CURRENT}-{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.writeBytes(version + "\n")
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{root}/{CURRENT}"), options)


def _write_version(df: DataFrame, path: str, comments: Mapping[str, str], partition_by: tuple[str, ...],
                   cluster_by: str | None = None, buckets: int | None = None) -> str:
    """Write a new version of the table and verify it; returns its name."""
    spark, written = df.sparkSession, Observation()
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    folder = f"{path.rstrip('/')}/{VERSIONS}/{version}"
    watched = with_comments(df, comments).observe(written, F.count(F.lit(1)).alias("rows"))
    if cluster_by:
        write_laid_out(watched, folder, cluster_by, buckets)
    else:
        (watched.write.partitionBy(*partition_by) if partition_by else watched.write).parquet(folder)
    found = read_stored(spark, folder).count()  # no column is read
    if found != written.get["rows"]:
        raise RuntimeError(f"{folder} has {found} rows, {written.get['rows']} were written; the published version stays")
    return version


def _clustered_version(df: DataFrame, path: str, comments: Mapping[str, str], key: str, buckets: int | None) -> str:
    """A version laid out by ``key``; a plain one if a key is hot.

    The rows are written plainly first, so that looking for hot keys reads one column of stored rows and
    nothing is computed twice; the plain copy goes when the other is complete.
    """
    spark, versions = df.sparkSession, f"{path.rstrip('/')}/{VERSIONS}"
    plain = _write_version(df, path, comments, ())
    stored = spark.read.parquet(f"{versions}/{plain}")
    version = f"{plain}-by-key"
    if not lay_out(stored, f"{versions}/{version}", key, buckets):
        return plain
    found, wanted = read_stored(spark, f"{versions}/{version}").count(), stored.count()  # no column is read
    if found != wanted:
        raise RuntimeError(f"{versions}/{version} has {found} rows, {wanted} were written; the published version stays")
    fs, place = file_at(spark, f"{versions}/{plain}")
    fs.delete(place, True)
    return version


def write_table(df: DataFrame, path: str, comments: Mapping[str, str] | None = None,
                partition_by: tuple[str, ...] = (), cluster_by: str | None = None, buckets: int | None = None,
                unique: bool = False) -> None:
    """Materialise ``df`` as the published version of the parquet table at ``path`` (type-1 full rebuild).

    ``cluster_by`` names a key to lay the table out by, in ``buckets`` (default: the session's shuffle
    partitions); with ``unique`` the key is known to have one row, or few, for each value, so none can be hot.
    """
    if cluster_by and partition_by:
        raise ValueError("a table is partitioned by folders or laid out by a key, not both")
    if cluster_by and not unique:
        version = _clustered_version(df, path, comments or {}, cluster_by, buckets)
    else:
        version = _write_version(df, path, comments or {}, partition_by, cluster_by, buckets)
    _point_to(df.sparkSession, path, version)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The published version of the table at ``path``; a folder without versions is read as it is."""
    return read_stored(spark, current_version(spark, path) or path)


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the ``keep`` newest versions and the published one; returns what went."""
    published = current_version(spark, path)
    fs, folder = file_at(spark, f"{path.rstrip('/')}/{VERSIONS}")
    if published is None or not fs.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    gone = [n for n in names[: max(0, len(names) - keep)] if n != published.rsplit("/", 1)[1]]
    for name in gone:
        forget(spark, f"{path.rstrip('/')}/{VERSIONS}/{name}")
        fs.delete(file_at(spark, f"{path.rstrip('/')}/{VERSIONS}/{name}")[1], True)
    return gone


def _database_folder(spark: SparkSession, name: str) -> str:
    database = name.rsplit(".", 1)[0] if "." in name else spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def save_table(df: DataFrame, name: str, comments: Mapping[str, str] | None = None,
               table_comment: str | None = None) -> None:
    """Materialise ``df`` as a catalog table ``name`` (full replace), with an optional
    table description (defaults to ``TABLE_COMMENTS`` for the known table names).

    The rows are a new version in the database's folder; the table then moves to it.  Only where its
    columns or their descriptions change is it declared anew.
    """
    spark, short = df.sparkSession, name.split(".")[-1]
    path = f"{_database_folder(spark, name)}/{short}"
    version = _write_version(df, path, comments or {}, ())
    location = f"{path}/{VERSIONS}/{version}"
    schema = spark.read.parquet(location).schema
    shape = [(f.name, f.dataType, f.metadata.get("comment")) for f in schema.fields]
    if spark.catalog.tableExists(name) and shape == [(f.name, f.dataType, f.metadata.get("comment")) for f in spark.table(name).schema.fields]:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted(location)}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=location, source="parquet", schema=schema)
    _point_to(spark, path, version)
    spark.catalog.refreshTable(name)
    text = table_comment if table_comment is not None else TABLE_COMMENTS.get(short)
    if text:
        spark.sql(f"COMMENT ON TABLE {name} IS {quoted(text)}")


def table_descriptions(spark: SparkSession, name: str) -> tuple[str | None, dict[str, str | None]]:
    """(description of the table, descriptions of its columns) as the catalog has them."""
    return spark.catalog.getTable(name).description, {c.name: c.description for c in spark.catalog.listColumns(name)}


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Expose ``df`` as a session view (the 'view' materialisation)."""
    df.createOrReplaceTempView(name)
    return df
