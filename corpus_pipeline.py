"""Corpus pipeline: documents through the stages below, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``documents``;
the last one adds each document's place in the mix.  Each stage works on all that its
predecessor kept:

1. ``language``: documents without a letter, or that are familiar to none of the learned languages
   (too few of their n-grams occur in its training rows, see ``language``), go; a document in any
   learned language stays.
2. ``line_dedup``: of lines of 20 characters or more that are equal, or apart by at most one edit for
   every 15 characters and four in all, the first in the corpus stays; documents that lose all their
   lines go.
3. ``near_duplicates``: one document of each SimHash class stays (3-word shingles, 3 bits).
4. ``decontaminate``: documents with at least one word in twenty inside benchmark windows go.
5. ``mix``: every document gets its place in the mix of the sources.

Nulls, empty and very long texts, ties and repeated rows are treated as the operators state.  An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.llm import decontaminate, language, line_dedup, mixing, simhash
from dimloom.llm.common import packed, read_table, stored


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs.where(language.fold() != 0))
    if not model.languages:  # nothing to learn from: nothing to judge by but letters
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return language.identify(packed(docs, "text"), model).where("familiar").select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.remove_repeats(docs, max_edits=4, min_chars=20, per_chars=15)
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, block_size=1 << 18)


STAGES = [
    ("language", language_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", duplicate_stage),
    ("decontaminate", benchmark_stage),
    ("mix", mix_stage),
]

#: The stages fit a model and follow links through many rounds; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
