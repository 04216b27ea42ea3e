"""Exact de-duplication by a tree-merge of sorted digest runs.

Two texts are equal when they are identical after lower-casing A-Z only; a null text counts as empty.
Each input partition makes a run: its different texts in the order of a 64-bit digest, each with the
identifier that stays and the number of rows.  Runs then meet in rounds.  The digests are divided
into as many ranges as there are runs; in a round, groups of ``FAN`` partitions whose numbers differ
in one digit exchange the parts of their runs, each keeping the ranges whose number has its own
digit there, and merge what arrives (sort and aggregate of sorted runs, with the runs of a partition
merged before they are sent).  After log_FAN(runs) rounds each partition owns one range, and every
text has one row.  A digest is verified at every level: rows merge only where the SHA-256 of the
whole normalised text is the same too, so texts that share a 64-bit digest stay apart.

Of the copies the row with the smallest or the largest identifier stays (``largest``).  A text that a
third of all rows share is one row of a run after the first level, and its answer goes back run by
run: rows are joined on (run, digest), so no key gathers more rows than one input partition has.

Nulls and edge cases: rows without a doc_id stay only if no copy has one; rows that repeat a doc_id
and text are told apart by their place in the input and one of them stays; texts of any length are
reduced to digests within their row; an empty table gives an empty result; other columns, whatever
their names, are ignored by ``classify`` and kept by ``remove_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, packed, stored

#: Partitions that exchange runs in a round; a power of two.
FAN = 16


def normalised(text: str = "text") -> Column:
    return ascii_lower(F.coalesce(F.col(text), F.lit("")))


def _runs(prints: DataFrame, largest: bool) -> DataFrame:
    """(place, digest, sha, keep, n): one run per input partition; ``place`` is its number."""
    order = F.struct(F.col("id").isNotNull() if largest else F.col("id").isNull(), F.col("id"), F.col("row"))
    best = (F.max if largest else F.min)(order).alias("keep")
    return prints.groupBy(F.col("run").alias("place"), "digest", "sha").agg(best, F.count(F.lit(1)).alias("n"))


def merge_runs(runs: DataFrame, count: int, largest: bool = True, fan: int = FAN) -> DataFrame:
    """(digest, sha, keep, n) of ``count`` runs (place, digest, sha, keep, n), merged in log_fan(count) rounds.

    A partition's number has one digit for each round.  Round k puts the digest's k-th digit in the
    place of the run's, so that the runs of the ``fan`` partitions that share the other digits meet.
    """
    bits = fan.bit_length() - 1
    rounds = 1
    while fan ** rounds < count:
        rounds += 1
    best = F.max("keep") if largest else F.min("keep")
    for k in range(1, rounds + 1):
        left = bits * (rounds - k)
        place = F.expr(f"shiftleft(shiftrightunsigned(digest, {64 - bits * k}), {left}) | (place & {(1 << left) - 1}L)")
        runs = (runs.groupBy(place.alias("place"), "digest", "sha")
                .agg(best.alias("keep"), F.sum("n").alias("n")))
    return runs.drop("place")


def classify(docs: DataFrame, largest: bool = True, fan: int = FAN) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, keep_id, group_size, kept, sha (of the normalised text)."""
    if fan < 2 or fan & (fan - 1):
        raise ValueError("fan must be a power of two")
    return _classified(docs.select(F.col("doc_id").alias("id"), normalised().alias("norm")), largest, fan).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "sha")


def _classified(docs: DataFrame, largest: bool, fan: int, *more: str) -> DataFrame:
    """(id, keep_id, group_size, kept, sha, row, more...) of docs (id, norm, more...)."""
    prints = stored(docs.select(
        "id", F.spark_partition_id().cast("long").alias("run"), F.monotonically_increasing_id().alias("row"),
        F.xxhash64("norm").alias("digest"), F.unhex(F.sha2("norm", 256)).alias("sha"), *more), "copies-digests")
    runs = stored(_runs(prints, largest), "copies-runs")
    count = runs.agg(F.max("place")).first()[0]
    merged = merge_runs(runs, 1 if count is None else count + 1, largest, fan)
    # the answers go back to the runs, and from there to the rows of each run
    answers = (runs.select(F.col("place").alias("run"), "digest", "sha")
               .join(merged.select("digest", "sha", "keep", F.col("n").alias("group_size")), ["digest", "sha"]))
    return prints.join(answers, ["run", "digest", "sha"]).select(
        "id", F.col("keep.id").alias("keep_id"), "group_size", (F.col("keep.row") == F.col("row")).alias("kept"),
        "sha", "row", *more)


def remove_copies(docs: DataFrame, largest: bool = True, fan: int = FAN) -> DataFrame:
    """``docs`` with one row of each class of equal texts; all columns stay."""
    rows = packed(docs, F.col("doc_id").alias("id"), normalised().alias("norm")).withColumnRenamed("row", "whole")
    return _classified(rows, largest, fan, "whole").where("kept").select("whole.*")
