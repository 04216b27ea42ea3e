"""Top-1 per group.

``top1`` uses ``row_number`` filtered to 1, which Spark plans as a partial
``WindowGroupLimit`` before the shuffle and a final one after it: each map task keeps
one row per key, so even a hot key sends at most one row per map task to its reducer.
``min_struct`` is the aggregate form for single-direction orders (partial aggregation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_by(spec: Sequence[tuple[str, str]]) -> list[Column]:
    """``[("a", "desc"), ("b", "asc")]`` -> Columns with nulls last in both directions."""
    return [F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_last() for c, d in spec]


def top1(df: DataFrame, partition_by: Sequence[str | Column], order_by: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.select("*", F.row_number().over(w).alias("__rn")).where("__rn = 1").drop("__rn")


def min_struct(cond: Column | None, *fields: str) -> Column:
    """``min(struct(fields))`` over the rows where ``cond`` holds (others are ignored as null)."""
    s = F.struct(*[F.col(f) for f in fields])
    return F.min(s if cond is None else F.when(cond, s))
