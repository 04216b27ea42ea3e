"""SimHash against a plain version: fingerprints, links within three bits, classes."""

import random

import pytest
import xxhash
from helpers_llm import docs_of, find, unite, words

from dimloom.llm import simhash as S
from dimloom.llm.common import components


def plain(text):
    w = words(text)
    if not w:
        return 0
    grams = [" ".join(w)] if len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_equals_plain_version():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "A", "a b", "A b\x0bC", "É é x y z", *(" ".join(rng.choices(["the", "Of", "x9", "ñ"], k=k)) for k in range(3, 40))]
    for t in texts:
        assert S.simhash64(t) & (2**64 - 1) == plain(t), t
    assert S.simhash64("Ab c") == S.simhash64("aB  C")


def test_long_text_is_read_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 997}" for i in range(5000))
    whole = S.simhash64(text)
    monkeypatch.setattr(S, "BLOCK", 64)
    assert S.simhash64(text) == whole


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
@pytest.mark.parametrize("bucket", [4, 1000])
def test_components_equal_all_pairs(spark, max_bits, bucket):
    """Also when crowded segments are linked through Hamming balls instead of pairs."""
    rng = random.Random(max_bits)
    prints = set()
    for k in range(3):
        base = rng.getrandbits(64)
        for _ in range(60):
            x = base
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(12 if k else 64)
            prints.add(x)
    prints = sorted(x - 2**64 if x >> 63 else x for x in prints)
    parent = {p: p for p in prints}
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= max_bits:
                unite(parent, a, b)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = {r.node: r.root for r in components(S.hamming_edges(df, max_bits, bucket)).collect()}
    assert {p: got.get(p, p) for p in prints} == {p: find(parent, p) for p in prints}


def test_classes_of_copies_nulls_and_empties(spark):
    long = " ".join(f"word{i}" for i in range(300))
    rows = [(5, long), (3, long.upper()), (9, long + " tail"), (2, None), (7, ""), (8, "other text here now"), (None, long), (3, long)]
    got = sorted(((r.doc_id, r.component_id) for r in S.near_duplicates(docs_of(spark, rows, ["fp", "key"])).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (2, 2), (7, 2), (8, 8), (None, 3), (3, 3)], key=str)
    kept = S.keep_one(docs_of(spark, rows, ["fp"]))
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [2, 3, 8]
    assert kept.where("doc_id IS NULL").count() == 0 and "fp" in kept.columns
    assert S.near_duplicates(docs_of(spark, rows).limit(0)).count() == 0


def test_one_id_with_two_texts_is_two_documents(spark):
    one, two = "alpha beta gamma delta epsilon zeta", "one two three four five six"
    rows = [(1, one), (1, two), (1, one), (2, two.upper()), (None, "a text without id that stands alone"), (None, one)]
    kept = S.keep_one(docs_of(spark, rows, ["text_key"]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, one), (1, two), (None, "a text without id that stands alone")], key=str)
    assert S.keep_one(docs_of(spark, rows).limit(0)).count() == 0
