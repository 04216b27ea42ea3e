"""Pfair mixing: less than one block of deviation, every block and row once."""

import random
from fractions import Fraction

import pytest
from helpers_llm import docs_of
from pyspark.sql import functions as F

from dimloom.llm import mixing as M


def test_every_prefix_is_within_one_block():
    rng = random.Random(2)
    for _ in range(60):
        weights = {f"s{i}": rng.random() ** 3 + 1e-3 for i in range(rng.randint(1, 12))} | ({None: 0.3} if rng.random() < 0.3 else {})
        parts = M.quotas(weights, rng.choice([5, 50, 200]))
        order, seen = M.period(parts), dict.fromkeys(parts, 0)
        for t, s in enumerate(order, 1):
            seen[s] += 1
            assert all(abs(Fraction(n * t, len(order)) - seen[x]) < 1 for x, n in parts.items())
        assert seen == parts


def test_schedule_fills_every_slot_once():
    rng = random.Random(3)
    for _ in range(30):
        blocks = {f"s{i}": rng.randint(0, 200) for i in range(rng.randint(1, 8))}
        plans, offsets = M.schedule(blocks, {s: rng.random() for s in blocks if rng.random() < 0.8}, 20)
        at = {(p, s, k): x for p, s, k, x in offsets}
        slots = []
        for s, plan in plans:
            for b in range(blocks[s]):
                phase, before, first, quota, length = [p for p in plan if p[1] <= b][-1]
                slots.append(first + (b - before) // quota * length + at[phase, s, (b - before) % quota])
        assert sorted(slots) == list(range(sum(blocks.values())))


def test_rows_are_numbered_within_sources(spark, monkeypatch):
    monkeypatch.setattr(M, "RANGE_ROWS", 7)
    rng = random.Random(4)
    rows = [(i, "x" * rng.randint(0, 50)) for i in range(200)] + [(None, "a"), (300, None), (5, "y"), (5, "y")]
    docs = docs_of(spark, rows, ["mix_slot", "_extra"]).withColumn("source", F.expr("IF(doc_id % 4 = 3, NULL, source)"))
    out = M.mix(docs, block_size=64).collect()
    assert len(out) == len(rows) and "_extra" in out[0].asDict()
    by = {}
    for r in out:
        by.setdefault(r.source, []).append((r.mix_rank, max(1, len(r.text or "")), r.mix_block, r.mix_slot))
    slots = {}
    for source, own in by.items():
        own.sort()
        assert [x[0] for x in own] == [sum(y[1] for y in own[:k]) for k in range(len(own))]
        for rank, _, block, slot in own:
            assert block == rank // 64 and slots.setdefault(slot, (source, block)) == (source, block)
    assert M.mix(docs.limit(0)).count() == 0


def test_too_many_sources(spark, monkeypatch):
    monkeypatch.setattr(M, "MAX_SOURCES", 2)
    with pytest.raises(ValueError, match="sources"):
        M.mix(docs_of(spark, [(1, "a"), (2, "b"), (3, "c")]))


def test_every_prefix_is_within_one_block_of_the_given_weights():
    """Against the weights themselves, tiny ones too, up to the slot at which the first source runs dry."""
    weights = {f"s{i}": 1.0 + i / 7 for i in range(20)} | {"large": 40.0, "tiny": 1e-4}
    total = sum(map(Fraction, weights.values()))
    plans, offsets = M.schedule({s: max(1, int(w * 80)) for s, w in weights.items()}, weights)
    seen, worst = dict.fromkeys(weights, 0), Fraction(0)
    first = [(k, s) for p, s, _, k in offsets if p == 0]
    assert len(first) > 3000
    for t, s in first:
        seen[s] += 1
        worst = max(worst, *(abs(Fraction(w) * (t + 1) / total - seen[x]) for x, w in weights.items()))
    assert worst < 1


def test_slots_in_pieces_cover_every_block(spark, monkeypatch):
    monkeypatch.setattr(M, "SLOTS", 5)
    monkeypatch.setattr(M, "SMALL", 3)
    docs = docs_of(spark, [(i, "x" * (i % 40)) for i in range(120)])
    out = M.mix(docs, block_size=64).collect()
    assert len(out) == 120
    assert {r.mix_slot for r in out} == set(range(len({(r.source, r.mix_block) for r in out})))
