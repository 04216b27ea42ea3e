"""Helpers shared by the operators: stored intermediate tables and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


#: Bytes of a batch that Spark hands to Python functions, unless the session says otherwise.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes: by rows alone, a batch of long texts would be of any size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if (spark.conf.get(key, None) or "").rstrip("bB") in ("", "-1", str((1 << 31) - 1)):  # Spark's default: no bound
        spark.conf.set(key, str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of ``spark.checkpoint.dir`` and read it back.

    This cuts lineage: whatever executor is lost later, the rows are read again from the
    shared folder.  Each call takes a new sub-folder.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, *needed: str | Column, without: tuple[str, ...] = ()) -> DataFrame:
    """The ``needed`` columns, and all columns but ``without`` as one struct ``row``, so that no name
    of the input can clash with a working column.  ``select("row.*")`` gives them back."""
    return docs.select(*needed, F.struct(*[docs[c] for c in docs.columns if c not in without]).alias("row"))


def ascii_lower(col):
    """Lower-case A-Z only; every other code point stays."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)``: (node, root), root = the smallest node id reachable.

    Only nodes with an edge to another node are listed.  Alternating large-star and
    small-star rounds: each round hangs a node's neighbours under its smallest neighbour.
    Minima come from aggregates with map-side combine and the joins back to the edges have
    plain shuffles on both sides, so a node with very many edges is split by AQE.  Each
    round's edges are a stored table; the driver sees only a row count and a checksum.
    """
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    current = stored(edges.where("a <> b").select(hi.alias("hi"), lo.alias("lo")).distinct(), name)
    seen = None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == seen:
            return current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = mark
        both = current.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            current.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), name)
        large = stored(both.join(low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
                       .distinct(), name)
        low = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), name)
        small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        current = stored(small.union(low.select("hi", F.col("m").alias("lo"))).distinct(), name)
