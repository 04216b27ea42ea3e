"""Quotient filters by exact round trips; collocations against a plain version."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers_llm import FOLD

from dimloom.llm import collocations as C
from dimloom.llm import quotient_filter as Q


@pytest.mark.parametrize(("n", "bits"), [(2, 8), (2, 32), (3, 17), (3, 22), (4, 16), (4, 17), (4, 32)])
def test_permutation_and_filters_are_lossless(n, bits):
    rng = np.random.default_rng(n * bits)
    shape = Q.Shape(n, bits)
    ids = rng.integers(0, 1 << bits, (3000, n), dtype=np.uint64)
    ids = np.concatenate([ids, ids[:200], np.tile(ids[:1], (700, 1))])
    top, rest = Q.permuted(list(ids.T), shape)
    assert (Q.restored(top, rest, shape) == ids).all()
    want = Counter(map(tuple, ids.tolist()))
    parts = [Q.counted(top[i::7], None if rest is None else rest[i::7]) for i in range(7)]
    for shard_bits in (0, 3, 5):
        got = Counter()
        bytes_of = [dict(Q.shards(p, shape, shard_bits)) for p in parts]
        for s in {s for b in bytes_of for s in b}:
            f = Q.merged([Q.from_bytes(b[s], shape, shard_bits, s) for b in bytes_of if s in b])
            assert (np.diff(f.top.astype(object)) >= 0).all()
            got.update(dict(zip(map(tuple, Q.restored(f.top, f.rest, shape).tolist()), f.count.tolist(), strict=True)))
        assert got == want


def test_filters_are_compact():
    rng = np.random.default_rng(1)
    shape = Q.Shape(2, 17)
    top, rest = Q.permuted(list(rng.integers(0, 1 << 17, (2, 100_000), dtype=np.uint64)), shape)
    f = Q.counted(top, rest)
    assert sum(len(b) for _, b in Q.shards(f, shape, 4)) < 4.6 * len(f.top)  # of 16 bytes a value and its count


def plain(rows, max_words, least, top, cover=80, scale=2_000_000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    often = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    out = []
    for (lang, p), a in often.items():
        if any(100 * b >= cover * a for (l2, q), b in often.items() if l2 == lang and len(q) > len(p)
               and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
            continue
        score, _, le, ri = min((scale * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), le, ri))
    got, place = [], Counter()
    for lang, score, a, p, le, ri in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            got.append((lang, place[lang], p.decode(), -a, le, ri, n[lang], -score))
    return sorted(got)


def texts(seed, n=400):
    rng = random.Random(seed)
    vocabulary = ["der", "Die", "das", "É", "é", "new", "York", "city", "of", "x\x01y", "日本", "\x85z", " "]
    rows = []
    for _ in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 12))]
        if rng.random() < 0.5:
            w[1:1] = ["new", "york", "city", "hall"]
        rows.append((rng.choice(["en", "de", None, "und", ""]), "".join(x + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r\n"]) for x in w)))
    return rows + [("en", None), (None, None), ("fr", ""), ("fr", "a b"), ("de", "long word " * 20_000)]


@pytest.mark.parametrize(("max_words", "least", "top", "head", "route"), [(4, 5, 2000, C.HEAD, 12), (4, 3, 7, 5, 2), (2, 5, 50, 0, 12), (3, 2, 9, 3, 1)])
def test_phrases_equal_plain(spark, monkeypatch, max_words, least, top, head, route):
    """A small broadcast table, shards in two rounds and small runs give the same phrases."""
    if route < 4:
        monkeypatch.setattr(C, "PRUNE_BITS", 6)
    rows = texts(max_words * least)
    docs = spark.createDataFrame([(x, t, 1, 2, "p", i) for i, (x, t) in enumerate(rows)],
                                 "lang string, text string, n long, rank int, phrase string, doc_id long").repartition(6)
    got = sorted(map(tuple, C.mine(docs, max_words, least, top, head=head, route=route).collect()))
    assert got == plain(rows, max_words, least, top)


def test_small_filters_are_sent_and_merged(spark, monkeypatch):
    """Tasks count in the workers, which see the module's own bounds: check the collector by itself."""
    monkeypatch.setattr(Q, "FLUSH", 50)
    shape, rng = Q.Shape(2, 10), np.random.default_rng(3)
    ids = rng.integers(0, 40, (2, 5000), dtype=np.uint64)
    mine, sent = Q.Collector(shape, 4), []
    for at in range(0, 5000, 100):
        sent += mine.add(Q.counted(*Q.permuted([ids[0, at:at + 100], ids[1, at:at + 100]], shape)))
    sent += mine.rows()
    assert len(sent) > 3
    got = Counter()
    for batch in sent:
        for s, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            f = Q.from_bytes(data, shape, 4, s)
            for p, c in zip(Q.restored(f.top, f.rest, shape).tolist(), f.count.tolist(), strict=True):
                got[tuple(p)] += c
    assert got == Counter(map(tuple, ids.T.tolist()))


def test_scores_beyond_64_bits(spark):
    often = spark.createDataFrame([([1], 9 * 10**17), ([2], 8 * 10**17), ([1, 2], 7 * 10**17)], "phrase array<long>, f long")
    assert C._scored(often, 2_000_000).first().score == 2_000_000 * 7 * 10**17 // (17 * 10**17)


def test_empty(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert C.mine(empty).count() == 0
    rare = spark.createDataFrame([("en", "one two three")], "lang string, text string")
    assert C.mine(rare).count() == 0
