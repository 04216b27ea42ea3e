"""Order MinHash against a plain version: signatures, edited texts, next documents, likeness."""

import random
import re
import struct

import xxhash
from helpers_llm import docs_of

from dimloom.llm import order_minhash as O


def chained(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v, seed)
    return seed


def plain(text, functions, k=2, select=2):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    if not w:
        grams = []
    elif len(w) < k:
        grams = [(chained([x.encode() for x in w]) >> 25, 0)]
    else:
        grams = [(chained([x.encode() for x in w[i:i + k]]) >> 25, i) for i in range(len(w) - k + 1)]
    seen, own = {}, []
    for g, p in grams:
        seen[g] = seen.get(g, -1) + 1
        own.append((chained([struct.pack("<q", g), struct.pack("<i", seen[g])]) >> 25, p))
    out = []
    for j in range(functions):
        r = j << (39 - functions.bit_length() + 1)
        least = sorted((h ^ r, p) for h, p in own)[:select]
        out.append(chained([struct.pack("<q", h ^ r) for h, p in sorted(least, key=lambda x: (x[1], x[0] ^ r))]) & 0xFFFFFFFF)
    return out


def test_equals_plain_version(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocab, k=n))) for i, n in enumerate([1, 2, 3, 10, 60, 400, 900])]
    rows += [(20, None), (21, ""), (22, "a b " * 500), (-3, "x"), (None, "null id é\U0001F600 text"), (22, "second row of 22"), (3, rows[3][1])]
    got = O.fingerprints(docs_of(spark, rows, ["sig", "key"]), functions=8, keep_text=True).collect()
    texts = {}
    for d, t in rows:
        texts.setdefault(d, []).append(t or "")
    ids = [*sorted((d for d in texts if d is not None), reverse=True), None]
    follow = dict(zip(ids, [*ids[1:], ids[0]], strict=True))
    want = []
    for d, t in rows:
        t, after = t or "", min(texts[follow[d]])
        cut = len(t) // 3
        edited = t[:len(t) - cut] + after[:cut]
        a, b, c = plain(t, 8), plain(edited, 8), plain(after, 8)
        want.append((d, follow[d], len(t), edited, a, b, sum(x == y for x, y in zip(a, b, strict=True)) / 8, sum(x == y for x, y in zip(a, c, strict=True)) / 8))
    found = [(r.doc_id, r.next_id, r.n_chars, r.edited, list(r.sig), list(r.edited_sig), r.near_edited, r.near_next) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_order_matters_and_empty_table(spark):
    words = [f"u{i}" for i in range(300)]
    df = O.signature(O.signature(docs_of(spark, [(1, " ".join(words))]).selectExpr("text AS a", f"'{' '.join(words[150:] + words[:150])}' AS b"), "a", "sa"), "b", "sb")
    same = df.select(O.likeness("sa", "sb").alias("x"), O.likeness("sa", "sa").alias("y")).first()
    assert same.y == 1.0 and same.x < 0.9
    assert O.fingerprints(docs_of(spark, [(1, "a")]).limit(0)).count() == 0
