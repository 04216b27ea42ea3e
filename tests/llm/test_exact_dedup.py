"""Exact de-duplication against a plain version."""

import hashlib
import random

import pytest
from helpers_llm import FOLD, docs_of
from pyspark.sql import functions as F

from dimloom.llm import exact_dedup as X


def plain(rows, largest):
    groups = {}
    for place, (d, t) in enumerate(rows):
        groups.setdefault((t or "").translate(FOLD), []).append((d, place))
    out = []
    for norm, members in groups.items():
        known = [d for d, _ in members if d is not None]
        keep = (max(known) if largest else min(known)) if known else None
        sha = hashlib.sha256(norm.encode()).hexdigest()
        stays = sum(d == keep for d, _ in members)
        out += [(d, keep, len(members), sha, d == keep, stays) for d, _ in members]
    return out


ROWS = [(1, "Same"), (2, "same"), (3, "SAME"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "x" * 200_000), (9, "X" * 200_000),
        (None, "same"), (None, "no id"), (None, "no id"), (10, "twice"), (10, "twice"), (11, " same"), (12, "Same ")]


@pytest.mark.parametrize(("largest", "fan", "parts"), [(True, 16, 1), (True, 2, 7), (False, 4, 40), (True, 16, 40)])
def test_classes_equal_plain(spark, largest, fan, parts):
    rng = random.Random(parts)
    rows = ROWS + [(100 + i, rng.choice("aAbBcCdD") * rng.randint(0, 3)) for i in range(300)] + [(1000 + i, "hot") for i in range(200)]
    rng.shuffle(rows)
    docs = docs_of(spark, rows, ["digest", "run", "keep", "n", "place"]).repartition(parts)
    got = X.classify(docs, largest, fan).collect()
    want = plain(rows, largest)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.sha.hex()) for r in got), key=str) == sorted((w[:4] for w in want), key=str)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.sha for r in got}) and all(r.doc_id == r.keep_id for r in kept)


def test_equal_short_digests_stay_apart(spark):
    """Rows that share the 64-bit digest but not the text are two classes at every level."""
    runs = spark.createDataFrame([(p, 5, bytes([p % 2]), (True, p, p), 1) for p in range(40)],
                                 "place long, digest long, sha binary, keep struct<known:boolean,id:long,row:long>, n long")
    got = {bytes(r.sha): (r.keep.id, r.n) for r in X.merge_runs(runs, 40, fan=4).collect()}
    assert got == {b"\0": (38, 20), b"\1": (39, 20)}


def test_rounds_send_a_copy_once_per_run(spark):
    """The plan merges sorted runs, a partial merge before each exchange, and uses no Python."""
    runs = X._runs(docs_of(spark, ROWS).select(F.col("doc_id").alias("id"), F.lit(0).alias("run"), F.lit(0).alias("row"),
                                               F.xxhash64("text").alias("digest"), F.unhex(F.sha2("text", 256)).alias("sha")), True)
    plan = X.merge_runs(runs, 200, fan=16)._jdf.queryExecution().toString().split("Physical Plan")[1]
    assert plan.count("Exchange hashpartitioning(") == 3 and plan.count("partial_max") == 3 and "Python" not in plan
    assert plan.count("SortAggregate") == 6


def test_remove_copies(spark):
    out = X.remove_copies(docs_of(spark, ROWS, ["sha", "whole", "id"]))
    assert {"sha", "whole", "id"} <= set(out.columns)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(3, "SAME"), (5, ""), (6, "É"), (7, "é"), (9, "X" * 200_000), (None, "no id"), (10, "twice"), (11, " same"), (12, "Same ")], key=str)


def test_empty_table(spark):
    assert X.classify(docs_of(spark, ROWS).limit(0)).count() == 0
    assert X.remove_copies(docs_of(spark, ROWS).limit(0)).count() == 0
