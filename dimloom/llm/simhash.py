"""SimHash near-duplicate classes by multi-index hashing.

A fingerprint has 64 bits over the word shingles of a text.  Two texts are linked when their
fingerprints differ in at most ``max_bits`` (3) bits; classes are the connected components.

Search: a fingerprint is cut into two 32-bit segments.  If two fingerprints differ in three
bits or fewer, they differ in at most one bit within one of the segments, so each fingerprint
probes a segment table with the Hamming ball of radius one around its own segment.  A pair
that differs in a segment bit is met once, because only 0 -> 1 flips are enumerated.  Every
match is verified on all 64 bits.

Equal fingerprints are one class before the search.  A table entry (segment value) shared by
more than ``bucket`` fingerprints is not expanded into pairs: its members are linked through
the Hamming balls of their other segment (radius one against radius two, which meet exactly
when the distance is three or less), each ball point keeping one link to its smallest owner.
That is linear in the members and gives the same components.

Nulls and edge cases: a null or empty text, or one of white space, has fingerprint zero and is
linked like any other; a text with fewer words than a shingle is one shingle; repeated rows are
each returned; a null ``doc_id`` is classed but never names a component unless no other id can;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, packed, stored

SEED = 42
#: Shingles hashed at once: 64 bytes of unpacked bits each.
BLOCK = 1 << 16
BUCKET = 64


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def simhash64(text: str | None, shingle: int = 3) -> int:
    """Fingerprint of one text as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)), len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    counts, left = np.zeros(64, np.int64), n
    while left:
        m = min(left, BLOCK)
        counts += _bit_counts(np.fromiter(map(digest, islice(grams, m), repeat(SEED)), np.uint64, m))
        left -= m
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` with the 64-bit fingerprint column ``out`` (an input column of that name is replaced)."""
    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash64(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn(out, fingerprint(F.col(text)))


def _keyed(fps: DataFrame) -> DataFrame:
    """(key, other, fp): both segments of each fingerprint; the key's bit 32 names the segment."""
    low, high = "fp & 4294967295L", "shiftrightunsigned(fp, 32)"
    return fps.selectExpr("fp", f"inline(array(struct({low} AS key, {high} AS other), "
                                f"struct({high} + 4294967296L AS key, {low} AS other)))")


def _flips(col: str, only_zero: bool) -> str:
    bits = "sequence(0, 31)"
    if only_zero:
        bits = f"filter({bits}, i -> ({col} & shiftleft(1L, i)) = 0)"
    return f"transform({bits}, i -> {col} ^ shiftleft(1L, i))"


def hamming_edges(fps: DataFrame, max_bits: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``fps(fp)``: same components as all pairs
    at ``max_bits`` (at most 3) differing bits or fewer."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments probed at radius one find at most three differing bits")
    table = stored(_keyed(fps), "simhash-segments")
    flipped = table.selectExpr("fp AS a", "other AS a_other", f"explode({_flips('key', True)}) AS key")
    probes = flipped.union(table.selectExpr("fp AS a", "other AS a_other", "key"))
    index = table.withColumnRenamed("fp", "b")
    hot = stored(table.groupBy("key").count().where(F.col("count") > bucket).select("key"), "simhash-hot")
    n_hot = hot.count()
    pairs = probes.join(index, "key")
    if n_hot:
        # bounded by 2 * fingerprints / bucket; broadcast only while it is small
        marks = F.broadcast(hot) if n_hot <= 1_000_000 else hot
        pairs = probes.join(marks, "key", "left_anti").join(index.join(marks, "key", "left_anti"), "key")
    near = (pairs.where(f"a <> b AND bit_count(a ^ b) <= {max_bits}").select("a", "b"))
    if not n_hot:
        return near
    return near.union(_hot_links(flipped, table, marks, max_bits))


def _hot_links(flipped: DataFrame, table: DataFrame, marks: DataFrame, max_bits: int) -> DataFrame:
    """Links within crowded segment values, linear in their members (see the module text)."""
    ball1 = f"array_append({_flips('other', False)}, other)"
    ball2 = ("flatten(transform(sequence(0, 30), i -> transform(sequence(i + 1, 31), "
             "j -> other ^ shiftleft(1L, i) ^ shiftleft(1L, j))))")
    members = stored(table.join(marks, "key", "left_semi"), "simhash-members")
    outside = flipped.join(marks, "key", "left_semi").selectExpr("a AS fp", "a_other AS other", "key")
    # radii of the members' hub balls, of the members that link to hubs, and of outside fingerprints,
    # which already differ in one bit of the segment
    hub_radius, radius, outside_radius = {0: (0, 0, 0), 1: (0, 1, 0), 2: (1, 1, 0), 3: (1, 2, 1)}[max_bits]

    def spread(df: DataFrame, radius: int) -> DataFrame:
        points = {0: "array(other)", 1: ball1, 2: f"concat({ball1}, {ball2})"}[radius]
        return df.selectExpr("key", "fp", f"explode({points}) AS point")

    hubs = stored(spread(members, hub_radius).groupBy("key", "point").agg(F.min("fp").alias("hub")), "simhash-hubs")
    links = spread(members, radius).union(spread(outside, outside_radius)).join(hubs, ["key", "point"])
    return (links.where(f"fp <> hub AND bit_count(fp ^ hub) <= {max_bits}")
            .select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct())


def _first_of_class(prints: DataFrame, first: Column, max_bits: int, bucket: int) -> DataFrame:
    """(fp, first): the least ``first`` of all rows of ``prints`` in the fingerprint's component."""
    classes = stored(prints.groupBy("fp").agg(F.min(first).alias("first")), "simhash-classes")
    linked = components(hamming_edges(classes.select("fp"), max_bits, bucket), "simhash-components")
    rooted = stored(classes.join(linked, classes.fp == linked.node, "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    names = stored(rooted.groupBy("root").agg(F.min("first").alias("class_first")), "simhash-names")
    return stored(rooted.join(names, "root").select("fp", F.col("class_first").alias("first")), "simhash-labels")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, fp, component_id."""
    prints = stored(fingerprints(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "simhash-docs")
    named = _first_of_class(prints, F.col("doc_id"), max_bits, bucket)
    return prints.join(named, "fp").select("doc_id", "fp", F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the one with the smallest doc_id, rows without
    one last, and of equal ids the one with the smallest digest of its text.

    Rows that repeat both doc_id and text are one document, of which one row stays; different texts
    with one doc_id are different documents, each judged in its own class.
    """
    digest = F.xxhash64("text").alias("text_key")
    prints = stored(fingerprints(docs.select("doc_id", "text", digest), shingle).select("doc_id", "text_key", "fp"), "simhash-docs")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = _first_of_class(prints, order, max_bits, BUCKET).select(
        F.col("first.doc_id").alias("_kept"), F.col("first.text_key").alias("_key")).distinct()
    rows = packed(docs, "doc_id", digest)
    same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.col("text_key") == F.col("_key"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text_key"]).select("row.*")
