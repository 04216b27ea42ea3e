"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of about ``block_size`` (rows, or a size column's sum), in an order
given by a hash.  Block j (from 0) of a source with share w is released at slot floor(j / w) and
due at slot ceil((j + 1) / w); every slot goes to the released block that is due first.  After any
number of slots, every source then differs from its target by less than one block.

Shares are the weights as given, in exact whole-number arithmetic; a phase has one slot for each of
its blocks.  The driver makes the slots in pieces of ``SLOTS`` rows, which are stored and joined to the
blocks by source and number: a row for each block, not for each document.  With a ``resolution``,
shares are rounded to its multiples, one at least each, and the table is one period that repeats.
No row is dropped or repeated: when a source runs dry, the rest go on in a new phase with their own
shares.

Nulls and edge cases: a source that is null or has no positive weight comes after all others, in
one last phase with equal shares (null counts as a source of its own); rows with equal hashes are
ordered by doc_id and text; repeated rows are each placed; an empty table gives an empty result; input columns
named like an output column are replaced.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import packed, stored

RESOLUTION = 1000
#: Sources that a mix may name: their plans are made on the driver.
MAX_SOURCES = 1000
#: Slots that the driver holds at once.
SLOTS = 200_000
#: Slots up to which their table is broadcast.
SMALL = 1_000_000
#: Rows of a source that are numbered by one task.
RANGE_ROWS = 4096


def _name(source: str | None) -> tuple[bool, str]:
    return source is None, source or ""


def quotas(weights: dict[str, float], resolution: int = RESOLUTION) -> dict[str, int]:
    """Whole numbers in proportion to the weights, one at least each, that sum to max(resolution, sources)."""
    total = sum(weights.values())
    slots = max(resolution, len(weights))
    exact = {s: w / total * slots for s, w in weights.items()}
    out = {s: max(1, math.floor(x)) for s, x in exact.items()}
    names = sorted(out, key=_name)
    while (short := slots - sum(out.values())) != 0:
        if short > 0:
            out[max(names, key=lambda s: exact[s] - out[s])] += 1
        else:
            out[max((s for s in names if out[s] > 1), key=lambda s: out[s] - exact[s])] -= 1
    return out


def whole(weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportions of the weights."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    return {s: int(x * scale) for s, x in exact.items()}


def slots_of(parts: dict[str, int]) -> Iterator[tuple[str, int]]:
    """(source, block) of each slot, without end, at shares in proportion to ``parts``: earliest deadline
    first among released blocks."""
    total = sum(parts.values())
    waiting = [(0, -(-total // n), _name(s), s, 0) for s, n in parts.items()]
    heapq.heapify(waiting)
    ready: list[tuple] = []
    slot = 0
    while True:
        while waiting and waiting[0][0] <= slot:
            heapq.heappush(ready, heapq.heappop(waiting)[1:])
        _, name, source, j = heapq.heappop(ready)
        yield source, j
        heapq.heappush(waiting, ((j + 1) * total // parts[source], -(-(j + 2) * total // parts[source]), name, source, j + 1))
        slot += 1


def period(parts: dict[str, int]) -> list[str]:
    """The source of each slot of one period."""
    return [s for s, _ in islice(slots_of(parts), sum(parts.values()))]


def first_dry(left: dict[str, int], parts: dict[str, int]) -> dict[str, int]:
    """Blocks of each source in the slots up to the one that takes the last block of a source."""
    counts = dict.fromkeys(left, 0)
    for source, j in slots_of(parts):
        counts[source] = j + 1
        if j + 1 == left[source]:
            return counts
    raise AssertionError


def phases(blocks: dict[str, int], weights: dict[str, float], resolution: int | None = None):
    """(first slot, blocks taken before, quotas, parts) of each phase; a phase ends when a source runs dry."""
    left, done, at = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0
    while left:
        if resolution is None:
            parts = whole({s: weights[s] for s in left})
            counts = first_dry(left, parts)
            yield at, {s: done[s] for s in left}, counts, parts
        else:
            parts = quotas({s: weights[s] for s in left}, resolution)
            yield at, {s: done[s] for s in left}, parts, parts
            rounds = min(n // parts[s] for s, n in left.items())
            counts = {s: rounds * parts[s] for s in left}
            if all(counts[s] < n for s, n in left.items()):
                # the round in which the first source runs dry
                for s, n in first_dry({s: n - counts[s] for s, n in left.items()}, parts).items():
                    counts[s] += n
        at += sum(counts.values())
        for s, n in counts.items():
            done[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n}


def _plans(blocks: dict[str, int], weights: dict[str, float], resolution: int | None) -> tuple[list, list]:
    """The rows of (source, plan), and the (phase, parts, slots) whose slots are to be made."""
    listed = {s: weights[s] for s in blocks if weights.get(s, 0) > 0}
    others = {s: 1.0 for s in blocks if s not in listed}
    plans: dict[str, list] = {s: [] for s in blocks}
    orders = []
    base = 0
    for group in (listed, others):
        for at, done, quota, parts in phases({s: blocks[s] for s in group}, group, resolution):
            length = sum(quota.values())
            for s, before in done.items():
                # a source without a block in the phase goes on in the next, from the same number
                plans[s].append((len(orders), before, base + at, max(1, quota[s]), length))
            orders.append((len(orders), parts, length))
        base += sum(blocks[s] for s in group)
    return [(s, p) for s, p in plans.items() if p], orders


def _offsets(orders: list) -> Iterator[tuple]:
    for number, parts, length in orders:
        for k, (s, j) in enumerate(islice(slots_of(parts), length)):
            yield number, s, j, k


def schedule(blocks: dict[str, int], weights: dict[str, float], resolution: int | None = None) -> tuple[list, list]:
    """Two tables: (source, starts, firsts, quotas, slots) with one array entry for each phase of
    the source, as (phase, blocks before, first slot, quota, slots of a period); and
    (phase, source, nth, offset) of the slots of every period."""
    plans, orders = _plans(blocks, weights, resolution)
    return plans, list(_offsets(orders))


def _slot_table(spark: SparkSession, orders: list) -> DataFrame:
    """``_offsets`` as a stored table, broadcast while it is small."""
    rest, parts = _offsets(orders), []
    while piece := list(islice(rest, SLOTS)):
        parts.append(stored(spark.createDataFrame(piece, "_ph int, _p string, _nth bigint, _offset bigint"), "mix-slots"))
    out = parts[0] if parts else spark.createDataFrame([], "_ph int, _p string, _nth bigint, _offset bigint")
    for part in parts[1:]:
        out = out.union(part)
    return F.broadcast(out) if sum(length for *_, length in orders) <= SMALL else out


def _numbered(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with mix_rank, the size of its source's rows that come before in order of a hash.

    A source is cut into ranges of the hash, one for every RANGE_ROWS of its rows, so no task
    orders a whole source; ranges are chained by their sums.
    """
    ranged = rows.join(F.broadcast(counts), F.col("_source").eqNullSafe(F.col("_s"))).withColumn(
        "_range", F.floor((F.col("_hash") / F.lit(2.0 ** 64) + 0.5) * F.ceil(F.col("_rows") / RANGE_ROWS))).drop("_s", "_rows", "_total")
    sums = ranged.groupBy("_source", "_range").agg(F.sum("_size").alias("_sum"))
    chain = Window.partitionBy("_source").orderBy("_range")
    base = stored(sums.select(F.col("_source").alias("_s"), F.col("_range").alias("_r"),
                              (F.sum("_sum").over(chain) - F.col("_sum")).alias("_base")), "mix-ranges")
    order = Window.partitionBy("_source", "_range").orderBy("_hash", "doc_id", "text").rowsBetween(Window.unboundedPreceding, -1)
    within = ranged.withColumn("_within", F.coalesce(F.sum("_size").over(order), F.lit(0)))
    joined = within.join(base, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    return joined.withColumn("mix_rank", F.col("_base") + F.col("_within")).drop("_s", "_r", "_base", "_within", "_range")


OUT = ("mix_phase", "mix_slot", "mix_block", "mix_rank")


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, block_size: int = 1 << 18,
        power: float = 0.5, resolution: int | None = None) -> DataFrame:
    """``docs(doc_id, text, source, ...)`` with mix_phase, mix_slot, mix_block and mix_rank.

    ``mix_block`` is the number of the row's block in its source (blocks are ``block_size`` UTF-8
    bytes; a row lies in the block in which it begins), ``mix_slot`` the block's place in the mix and
    ``mix_rank`` the bytes before the row in its source.  Ordering by (mix_slot, mix_rank) gives the
    mixed corpus.  Without ``weights``, a source weighs its size to the ``power``.
    """
    rows = (packed(docs, "doc_id", "text", "source", without=OUT).withColumn("_source", F.col("source").cast("string"))
            .withColumn("_hash", F.xxhash64(F.lit("mix"), "doc_id", "text"))
            .withColumn("_size", F.greatest(F.lit(1), F.coalesce(F.octet_length("text"), F.lit(0))).cast("long")))
    counts = stored(rows.groupBy(F.col("_source").alias("_s")).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("_size").alias("_total")), "mix-counts")
    totals = {r["_s"]: r["_total"] for r in counts.limit(MAX_SOURCES + 1).collect()}
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"a mix of more than {MAX_SOURCES} sources")
    if weights is None:
        weights = {s: float(n) ** power for s, n in totals.items()}
    blocks = {s: (n - 1) // block_size + 1 for s, n in totals.items()}
    plans, orders = _plans(blocks, weights, resolution)
    spark = docs.sparkSession
    plan = spark.createDataFrame(plans, "_p string, _plan array<struct<phase:int,before:bigint,first:bigint,quota:bigint,slots:bigint>>")
    slots = _slot_table(spark, orders)
    placed = _numbered(rows, counts).withColumn("mix_block", F.floor(F.col("mix_rank") / block_size))
    phased = (placed.join(F.broadcast(plan), F.col("_source").eqNullSafe(F.col("_p"))).drop("_p")
              .withColumn("_in", F.expr("get(_plan, size(filter(_plan, p -> p.before <= mix_block)) - 1)")).drop("_plan")
              .withColumn("mix_phase", F.col("_in.phase"))
              .withColumn("_k", F.expr("mix_block - _in.before")))
    at = (F.col("mix_phase") == F.col("_ph")) & F.col("_source").eqNullSafe(F.col("_p")) & (F.expr("_k % _in.quota") == F.col("_nth"))
    found = phased.join(slots, at)
    return found.withColumn("mix_slot", F.expr("_in.first + div(_k, _in.quota) * _in.slots + _offset")).select("row.*", *OUT)
