"""Decontamination against a plain version, for both sizes of benchmark, and both removals."""

import random
import re

import pytest
from helpers_llm import FOLD, docs_of

from dimloom.llm import decontaminate as D

W = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(docs, bench, window=13):
    grams = {}
    for i, t in bench:
        w = W.findall((t or "").translate(FOLD))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            grams.setdefault(tuple(w[k:k + window]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, items = W.findall((t or "").translate(FOLD)), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if (own := grams.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    items |= {str(i) for i in own if i is not None}
        out.append((d, len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture()
def case(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("Aa Bb c9 dé e f g h".split())
    bench = [(i, " ".join(word() for _ in range(rng.randint(0, 20)))) for i in range(12)] + [(50, None), (51, "Zed zed"), (None, "null item"), (52, "zed ZED")]
    docs = [(i, ", ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(25)]
    docs += [(100 + k, "pre " + t + " post " * 40) for k, (_, t) in enumerate(bench) if t]
    docs += [(200, None), (201, ""), (202, "zed, ZED!"), (None, "a null item here"), (203, "x"), (203, "x")]
    b = spark.createDataFrame(bench, "item_id long, text string")
    return docs, bench, docs_of(spark, docs, ["words", "h"]), b


@pytest.mark.parametrize(("most", "words"), [(D.MAX_WINDOWS, D.MAX_WORDS), (D.MAX_WINDOWS, 0), (0, 0)])
def test_scan_equals_plain_version(case, monkeypatch, most, words):
    docs, bench, df, b = case
    monkeypatch.setattr(D, "MAX_WINDOWS", most)
    monkeypatch.setattr(D, "MAX_WORDS", words)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in D.scan(df, b).collect()), key=str)
    assert got == plain(docs, bench)


def test_removals(case, spark):
    docs, bench, df, b = case
    kept = D.remove_documents(df, b)
    assert kept.count() == sum(1 for r in plain(docs, bench) if not r[4]) and kept.columns == df.columns
    small = docs_of(spark, [(1, "keep this Zed, zed. and this"), (2, None), (3, "nothing")])
    cut = {r.doc_id: r.text for r in D.remove_spans(small, spark.createDataFrame([(1, "zed ZED")], "item_id long, text string")).collect()}
    assert cut == {1: "keep this and this", 2: None, 3: "nothing"}


def test_empty_tables(spark):
    b = spark.createDataFrame([(1, None)], "item_id long, text string")
    rows = D.scan(docs_of(spark, [(1, "a b"), (2, None)]), b).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in rows) == [(1, 2, 0, False), (2, 0, 0, False)]
    assert D.scan(docs_of(spark, [(1, "a")]).limit(0), b).count() == 0


def test_hash_set_is_neither_in_the_plan_nor_in_python(spark):
    """However many windows, the plan stays the same size: a broadcast join looks their hashes up."""
    docs = docs_of(spark, [(1, "a b c")])
    sizes = []
    for items in (3, 300):
        b = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(items)], "item_id long, text string")
        plan = D.scan(docs, b)._jdf.queryExecution().toString()
        assert "BroadcastHashJoin [h" in plan and "Python" not in plan
        sizes.append(len(plan))
    assert abs(sizes[0] - sizes[1]) < 200
