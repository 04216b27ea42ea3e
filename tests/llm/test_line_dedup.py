"""Line de-duplication against a plain version; banded distance against the textbook one."""

import random

import numpy as np
import pandas as pd
import pytest
from helpers_llm import FOLD, docs_of, find, unite

from dimloom.llm import line_dedup as L


def edited(rng, text, edits, letters="abcX"):
    text = list(text)
    for _ in range(edits):
        k, p = rng.randrange(3), rng.randrange(len(text) + 1)
        if k == 0 and p < len(text):
            text[p] = rng.choice(letters)
        elif k == 1 and p < len(text):
            del text[p]
        else:
            text.insert(p, rng.choice(letters))
    return "".join(text)


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_banded_distance(most):
    rng = random.Random(most)
    a = ["".join(rng.choices("ab", k=rng.randint(0, 14))) for _ in range(1500)]
    b = [edited(rng, x, rng.randint(0, 4), "ab") for x in a]
    assert (L.within(a, b, most) == np.array([L._distance(x, y) <= most for x, y in zip(a, b, strict=True)])).all()


def plain(rows, most, least):
    lines = [(d, i, x.translate(FOLD).strip(" \t\r\x0b\x0c")) for d, t in rows if t is not None for i, x in enumerate(t.split("\n"))]
    kinds = sorted({x for *_, x in lines if len(x) >= max(least, most + 1)})
    parent = {x: x for x in kinds}
    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if abs(len(a) - len(b)) <= most and L._distance(a, b) <= most:
                unite(parent, a, b)
    first = {}
    for d, i, x in lines:
        if x in parent:
            place = (d is None, d or 0, i)
            first[find(parent, x)] = min(first.get(find(parent, x), place), place)
    out = []
    for d, i, x in lines:
        f = first[find(parent, x)] if x in parent else None
        out.append((d, i, None if f is None or f[0] else f[1], f and f[2], f is None or (d is None, d or 0, i) == f))
    return sorted(out, key=str)


@pytest.mark.parametrize(("most", "bucket"), [(1, 128), (1, 1), (2, 128), (2, 1), (3, 2)])
def test_classes_equal_all_pairs(spark, most, bucket):
    """With a bucket of one, every shared key is linked through pivots and blocks."""
    rng = random.Random(most + bucket)
    base = ["".join(rng.choices("abcd ", k=rng.randint(4, 12))) for _ in range(10)]
    rows = [(d, "\n".join(edited(rng, rng.choice(base), rng.randint(0, 3)) for _ in range(rng.randint(1, 4)))) for d in range(40)]
    rows += [(100, None), (101, ""), (None, "hello null id\nabcdabcd"), (102, "É" * 3000)]
    got = sorted(((r.doc_id, r.line_no, r.first_doc_id, r.first_line_no, r.kept) for r in L.classify(docs_of(spark, rows, ["h", "line"]), most, 4, bucket).collect()), key=str)
    assert got == plain(rows, most, 4)


@pytest.mark.parametrize(("bucket", "block"), [(64, 512), (1, 512), (1, 3)])
def test_four_edits_by_length_equal_all_pairs(spark, monkeypatch, bucket, block):
    """Families of near copies of lines of all lengths: chains through a family, and lines that only share a beginning."""
    monkeypatch.setattr(L, "BLOCK", block)
    rng = random.Random(bucket + block)
    base = ["".join(rng.choices("abcdefgh ", k=k)).strip().ljust(k, "x") for k in (20, 25, 29, 30, 44, 45, 59, 60, 61, 75)]
    prefix = base[-1][:60]
    kinds = [edited(rng, rng.choice(base), rng.randint(0, 7), "abcdefgh") for _ in range(150)]
    kinds += [prefix + "".join(rng.choices("abcdefgh", k=15)) for _ in range(40)]
    rows = [(d, "\n".join(rng.choice(kinds) for _ in range(rng.randint(1, 4)))) for d in range(120)]
    lines = [(d, i, x.translate(FOLD).strip(" \t\r\x0b\x0c")) for d, t in rows for i, x in enumerate(t.split("\n"))]
    distinct = sorted({x for *_, x in lines if len(x) >= 20})
    parent = {x: x for x in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if abs(len(a) - len(b)) <= 4 and L._distance(a, b) <= min(4, min(len(a), len(b)) // 15):
                unite(parent, a, b)
    first = {}
    for d, i, x in lines:
        if x in parent:
            first[find(parent, x)] = min(first.get(find(parent, x), (d, i)), (d, i))
    want = sorted((d, i, *(first[find(parent, x)] if x in parent else (None, None))) for d, i, x in lines)
    got = sorted((r.doc_id, r.line_no, r.first_doc_id, r.first_line_no) for r in L.classify(docs_of(spark, rows), 4, 20, bucket, per_chars=15).collect())
    assert got == want
    assert 1 < len(set(first)) < len(distinct) - 20


def test_blocks_compare_what_pivots_leave():
    """A line beyond the edits of the pivot is linked to a linked line; no link comes out between linked lines."""
    pivot = "the quick brown fox jumps over the lazy dog and runs away from it again"
    texts = [pivot, pivot.replace("quick", "quack"), pivot.replace("quick", "quaaaack"), pivot.replace("quick", "quaaaackxxx"), "z" * len(pivot)]
    close = [L._distance(t, pivot) <= 4 for t in texts]
    cut = L._Cut([L._digest(t) for t in texts], texts)
    rows = pd.DataFrame({"h": cut.h, "own": 1, "n": cut.n, **dict(zip(("even", "odd"), cut.pair_parities(), strict=True)), "close": close, "ring": [L._distance(t, pivot) <= 8 for t in texts], "norm": texts})
    both = pd.concat([rows[~rows["close"]].assign(is_left=True), rows.assign(is_left=False)])
    a, b = L._block_links(both, 4, 0)
    name = {int(h): i for i, h in enumerate(cut.h)}
    assert close == [True, True, True, False, False]
    assert [{name[x], name[y]} for x, y in zip(a, b, strict=True)] == [{2, 3}]


def test_an_edit_changes_four_parities_at_most():
    rng = random.Random(5)
    for _ in range(300):
        a = "".join(rng.choices("abcd ", k=rng.randint(5, 80)))
        b = edited(rng, a, rng.randint(0, 4), "abcd")
        if b:
            flips = sum((int(x) ^ int(y)).bit_count() for x, y in (w.view(np.uint64) for w in L._Cut([1, 2], [a, b]).pair_parities()))
            assert flips <= 4 * L._distance(a, b)


def test_remove_repeats(spark):
    long, near = "a line of more than twenty characters", "a line of more than twenty characterz"
    rows = [(1, f"head\n{long}\nshort"), (2, f"{near}\nshort"), (3, long), (4, None), (5, ""), (6, f"{long}\n{long}\nx"), (1, f"head\n{long}\nshort")]
    out = L.remove_repeats(docs_of(spark, rows, ["line_no"]))
    assert "line_no" in out.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(1, f"head\n{long}\nshort")] * 2 + [(2, "short"), (4, None), (5, ""), (6, "x")], key=str)
    assert L.remove_repeats(docs_of(spark, rows).limit(0)).count() == 0


def test_edits_by_length(spark):
    """A changed word of a long line is a near copy; a short line may differ by one character only."""
    long = "the licence of this work and of all its parts is given to everyone who reads it"
    rows = [(1, long), (2, long.replace("work", "book")), (3, long.replace("everyone", "nobody at all")),
            (4, "a line of 25 characters.."), (5, "a line of 25 charactersxy"), (6, "a line of 25 characters.y")]
    got = {r.doc_id: r.first_doc_id for r in L.classify(docs_of(spark, rows[:5]), 4, 20, per_chars=15).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    got = {r.doc_id: r.first_doc_id for r in L.classify(docs_of(spark, rows), 4, 20, per_chars=15).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 4}


def test_production_runs_find_a_changed_word(spark, tmp_path):
    from corpus_pipeline import line_stage
    from dimloom.llm.queries import op7_line_dedup

    long = "the licence of this work and of all its parts is given to everyone who reads it"
    docs = docs_of(spark, [(1, long), (2, long.replace("work", "book"))])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert [r.kept for r in op7_line_dedup(spark, str(tmp_path)).orderBy("doc_id").collect()] == [True, False]
    assert [r.doc_id for r in line_stage(spark, docs, "").collect()] == [1]
