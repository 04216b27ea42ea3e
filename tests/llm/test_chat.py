"""Chat formatting: ranges chained like whole conversations, markers, held-out accuracy, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimloom.llm import chat as C
from dimloom.llm.language import fold

SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture()
def turns(spark):
    rng = random.Random(4)
    rows = []
    for c, n in ((1, 120), (2, 3), (None, 40), (3, 1), (4, 200)):
        for t in range(n):
            text = "\n".join(rng.choice(["hi", "x" * rng.randint(1, 300), "why?", "User: a", "Assistant: b", "Bob: c"]) for _ in range(rng.randint(1, 3)))
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    return spark.createDataFrame([*rows, (5, None, None, None), (5, 0, "user", ""), (5, 0, "user", "")], SCHEMA)


def test_many_ranges_equal_one_range(spark, turns):
    out = []
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for parts in ("7", "1"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            lines, model = C.recover(turns.withColumn("state", F.lit("clash")), F.expr("conv_id IS NULL OR conv_id <> 2"))
            rows = lines.orderBy("part", "pos").select("part", "conv_id", "turn", "line_no", "state").collect()
            done = sorted(map(tuple, C.render(lines, model).collect()), key=str)
            out.append((len({r.part for r in rows}), [tuple(r)[1:] for r in rows], done, model.step))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert out[0][0] > 1 and out[1][0] == 1
    assert out[0][1] == out[1][1] and out[0][2] == out[1][2] and np.allclose(out[0][3], out[1][3])


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    scores, step, start = rng.normal(size=(6, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    best = max(np.ndindex(*[3] * 6), key=lambda p: start[p[0]] + sum(scores[k, s] for k, s in enumerate(p)) + sum(step[a, b] for a, b in zip(p, p[1:], strict=False)))
    assert list(C.viterbi(scores, step, start)) == list(best)
    whole = (start[:, None] + C.best_paths(scores, step)).max()
    assert np.isclose(whole, start[best[0]] + sum(scores[k, s] for k, s in enumerate(best)) + sum(step[a, b] for a, b in zip(best, best[1:], strict=False)))


def test_held_out_roles_and_markers(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    plain = [(10**9, 0, None, "System: be nice\nUser: hello\nhow are you?\nAssistant: fine\nthanks\nHuman: ok")]
    both = turns.unionByName(spark.createDataFrame(plain, SCHEMA))
    found = C.format_chats(both, (fold("conv_id") != 0) & (F.col("conv_id") < 10**9)).cache()
    joined = found.where("line_no = 0").select("conv_id", "turn", F.col("role").alias("found")).join(turns, ["conv_id", "turn"]).where(fold("conv_id") == 0)
    assert joined.where("found = role").count() >= 0.9 * joined.count() > 0
    assert [r.rendered for r in found.where("conv_id = 1000000000").orderBy("line_no").collect()] == [
        "<|system|>\nbe nice", "<|user|>\nhello\nhow are you?", "<|assistant|>\nfine\nthanks", "<|user|>\nok"]


def test_nothing_labelled_and_empty_table(spark, turns):
    out = C.format_chats(turns.where("conv_id = 5"), F.lit(False)).collect()
    assert len(out) == 3 and {r.role for r in out} <= {"assistant", "user"}
    assert C.format_chats(turns.limit(0), F.lit(True)).count() == 0


def test_a_marker_inside_a_turn_stays(spark, turns):
    """'Answer: 42' names the assistant, but the turn goes on: its words are text; so is the name of another role."""
    rows = [(7, 0, "user", "User: what is it"), (7, 1, "assistant", "Assistant: let me see\nAnswer: 42\nUser: is what you are")]
    lines, model = C.recover(turns.where("conv_id <= 4").unionByName(spark.createDataFrame(rows, SCHEMA)), F.col("conv_id") <= 4)
    assert model.roles == ["assistant", "user"]
    state = F.expr("CASE WHEN conv_id <> 7 THEN state WHEN turn = 0 THEN 2 WHEN line_no = 0 THEN 0 ELSE 1 END")
    got = C.render(lines.withColumn("state", state.cast(lines.schema["state"].dataType)), model).where("conv_id = 7").orderBy("turn").collect()
    assert [r.rendered for r in got] == ["<|user|>\nwhat is it", "<|assistant|>\nlet me see\nAnswer: 42\nUser: is what you are"]


def test_all_roles_are_learned(spark, monkeypatch):
    rows = [(c, t, f"role{(c + t) % 20}", "x" * (1 + (c + t) % 20 * 40)) for c in range(40) for t in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    _, model = C.recover(df, F.lit(True))
    assert len(model.roles) == 20
    monkeypatch.setattr(C, "MAX_ROLES", 19)
    with pytest.raises(ValueError, match="different roles"):
        C.recover(df, F.lit(True))
