"""Document fingerprints by order MinHash: signatures that are sensitive to edit distance.

A text is a sequence of words (runs without ASCII white space); its k-mers are ``k`` consecutive
words.  Each k-mer is numbered by its occurrence in the text, so repeats count.  For each of
``functions`` hash functions the ``select`` k-mers of least hash are taken, put back into text
order, and the tuple is hashed: one signature component.  The likeness of two signatures is the
share of equal components; it drops when k-mers differ, and also when their order does.

The hash functions are h(x) XOR r_j with r_j spread evenly over the top bits, so one hash per
k-mer serves all of them and the least k-mers of function j lie in bucket j of the hash range.
Only hashes in the low part of each bucket are kept for the selection; a text for which a bucket
then holds too few is selected from all its k-mers, so the result is always that of the full
selection.  All of it is built-in functions on arrays within the row: a text never leaves its row
and no k-mer is shuffled.

Nulls and edge cases: a null text is empty; a text with fewer words than ``k`` is one k-mer; a
text without words has a constant signature; equal texts have equal signatures; positions past
``MAX_POSITION`` words count as that position; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

K = 2
SELECT = 2
FUNCTIONS = 32
#: Bits of a packed value: 39 of hash above 24 of position.
POSITION_BITS, HASH_BITS = 24, 39
MAX_POSITION = (1 << POSITION_BITS) - 1
#: k-mers expected to be kept for each hash function before the selection.
KEPT = 10


def signature(df: DataFrame, text: str, out: str, k: int = K, select: int = SELECT,
              functions: int = FUNCTIONS) -> DataFrame:
    """``df`` with ``out``: array<int> of ``functions`` signature components of column ``text``.

    ``functions`` is a power of two.  Column names beginning with ``_om`` are taken.
    """
    bits = functions.bit_length() - 1
    if functions != 1 << bits:
        raise ValueError("functions must be a power of two")
    low = HASH_BITS - bits + POSITION_BITS  # bits of a packed value within a bucket
    others = [f"`{c}`" for c in df.columns if c != out]
    kmer = ", ".join(f"get(_om_words, i + {n})" for n in range(k))
    pos = f"least(i, {MAX_POSITION})"
    words = df.selectExpr(*others, f"array_remove(split(coalesce(`{text}`, ''), '[\\\\x20\\\\x09-\\\\x0D]+'), '') AS _om_words")
    # k-mers as (hash, position), in order of hash
    sorted_kmers = words.selectExpr(*others, f"""
        CASE WHEN size(_om_words) = 0 THEN cast(array() AS array<bigint>)
             WHEN size(_om_words) < {k} THEN array(shiftleft(shiftrightunsigned(xxhash64(_om_words), 25), {POSITION_BITS}))
             ELSE sort_array(transform(sequence(0, size(_om_words) - {k}), i ->
                  shiftleft(shiftrightunsigned(xxhash64({kmer}), 25), {POSITION_BITS}) + {pos})) END AS _om_s""")
    runs = sorted_kmers.selectExpr("*", f"""
        CASE WHEN size(_om_s) = 0 THEN cast(array() AS array<int>) ELSE
        filter(sequence(0, size(_om_s) - 1), i -> i = 0 OR
               shiftright(get(_om_s, i), {POSITION_BITS}) <> shiftright(get(_om_s, i - 1), {POSITION_BITS})) END AS _om_r""")

    def numbered(x: str, nth: str) -> str:
        return (f"shiftleft(shiftrightunsigned(xxhash64(shiftright({x}, {POSITION_BITS}), {nth}), 25), {POSITION_BITS})"
                f" + ({x} & {MAX_POSITION})")

    hashed = runs.selectExpr(*others, f"""
        CASE WHEN size(_om_r) = size(_om_s) THEN transform(_om_s, x -> {numbered('x', '0')})
        ELSE flatten(transform(_om_r, (s, n) -> transform(
             sequence(s, coalesce(get(_om_r, n + 1), size(_om_s)) - 1), i -> {numbered('get(_om_s, i)', 'i - s')}))) END AS _om_h""")
    # within its bucket a hash is kept below this bound; all are kept of short texts
    bound = f"cast({float(1 << low)} * least(1.0D, {float(KEPT * functions)} / greatest(size(_om_h), 1)) AS bigint)"
    kept = hashed.selectExpr("*", f"{bound} AS _om_t").selectExpr(
        "*", f"sort_array(filter(_om_h, x -> (x & {(1 << low) - 1}) < _om_t)) AS _om_k")
    starts = kept.selectExpr("*", f"""
        CASE WHEN size(_om_k) = 0 THEN cast(array() AS array<int>) ELSE
        filter(sequence(0, size(_om_k) - 1), i -> i = 0 OR
               shiftright(get(_om_k, i), {low}) <> shiftright(get(_om_k, i - 1), {low})) END AS _om_b""")

    buckets = starts.selectExpr("*", f"transform(_om_b, i -> shiftright(get(_om_k, i), {low})) AS _om_p",
                                "array_append(_om_b, size(_om_k)) AS _om_e")
    # a bucket that holds enough has the least values of its hash function first; else all values compete
    at = "cast(array_position(_om_p, j) AS int)"
    enough = f"{at} > 0 AND get(_om_e, {at}) - get(_om_e, {at} - 1) >= {select}"
    own = f"transform(sequence(0, {select - 1}), d -> get(_om_k, get(_om_e, {at} - 1) + d) ^ shiftleft(j, {low}))"
    least = f"slice(sort_array(transform(_om_h, x -> x ^ shiftleft(j, {low}))), 1, {select})"
    chosen = buckets.selectExpr(*others, f"transform(sequence(0L, {functions - 1}L), j -> "
                                f"CASE WHEN {enough} THEN {own} ELSE {least} END) AS _om_c")
    in_order = f"sort_array(transform(c, x -> shiftleft(x & {MAX_POSITION}, {HASH_BITS}) + (shiftright(x, {POSITION_BITS}) ^ shiftleft(j, {HASH_BITS - bits}))))"
    component = f"cast(xxhash64(transform({in_order}, y -> y & {(1 << HASH_BITS) - 1})) & 4294967295L AS bigint)"
    component = component.replace("shiftleft(j,", "shiftleft(cast(j AS bigint),")
    return chosen.selectExpr(*others, f"transform(_om_c, (c, j) -> {component}) AS `{out}`")


def likeness(a: str, b: str, functions: int = FUNCTIONS):
    """Share of equal components of two signature columns."""
    return F.expr(f"size(filter(sequence(0, {functions - 1}), j -> get(`{a}`, j) = get(`{b}`, j))) / cast({functions} AS double)")


def as_text(sig: str):
    """A signature column as text: eight hex digits for each component."""
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def _key(doc_id: str):
    """An id as text that is never null."""
    return F.coalesce(F.concat(F.lit("i"), F.col(doc_id).cast("string")), F.lit("null"))


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) of distinct ids in descending order, nulls last; the last is followed by the first.

    Ids are dealt by range; each range is ordered by itself and the ranges, of which there are as
    many as shuffle partitions, are chained by their first ids.
    """
    order = F.col("doc_id").desc_nulls_last()
    dealt = stored(ids.select("doc_id").distinct().repartitionByRange(order)
                   .withColumn("part", F.spark_partition_id()), "order-ids")
    within = Window.partitionBy("part").orderBy(order)
    chained = dealt.select("doc_id", "part", F.lead(F.struct("doc_id")).over(within).alias("next"))
    firsts = dealt.groupBy("part").agg(F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("f"))
    ranges = Window.orderBy("part")
    firsts = firsts.select(
        "part", F.lead(F.struct("f.doc_id")).over(ranges).alias("after"),
        F.first(F.struct("f.doc_id")).over(ranges).alias("start"))
    return (chained.join(F.broadcast(firsts), "part")
            .select("doc_id", F.coalesce("next", "after", "start")["doc_id"].alias("next_id")))


def fingerprints(docs: DataFrame, k: int = K, select: int = SELECT, functions: int = FUNCTIONS,
                 keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, next_id, n_chars, edited_sha256 (or, with
    ``keep_text``, edited), sig, edited_sig, near_edited, near_next.

    The edited text is the text whose last floor(n_chars / 3) code points are replaced by the first as
    many (or all) of the next document in descending order of doc_id (after the last: the first).
    Of rows that share a doc_id, the one with the least text stands for it as a next document.
    """
    ids = docs.select(_key("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    # texts are dealt once, by id; the two uses below share that exchange
    rows = ids.repartition("key")
    sizes = ids.groupBy("key").agg(F.max(F.floor(F.length("text") / 3)).alias("cut"))
    follow = next_ids(docs).select(_key("doc_id").alias("key"), "doc_id", "next_id", _key("next_id").alias("next_of"))
    wanted = stored(follow.join(sizes, "key"), "order-next")
    texts = rows.groupBy("key").agg(F.min("text").alias("next_text"))
    heads = wanted.join(texts.withColumnRenamed("key", "next_of"), "next_of").select(
        "key", "doc_id", "next_id", F.expr("substring(next_text, 1, cast(cut AS int))").alias("head"),
        F.xxhash64("next_text").alias("next_key"))
    paired = (rows.join(heads, "key")
              .withColumn("n_chars", F.length("text").cast("long"))
              .withColumn("cut", F.floor(F.col("n_chars") / 3).cast("int"))
              .withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars AS int) - cut), substring(head, 1, cut))"))
              .select("doc_id", "next_id", "next_key", "text", "n_chars", "edited"))
    signed = signature(signature(paired, "text", "sig", k, select, functions), "edited", "edited_sig", k, select, functions)
    table = stored(signed.select("doc_id", "next_id", "next_key", F.xxhash64("text").alias("text_key"), "n_chars",
                                 "edited", "sig", "edited_sig") if keep_text else
                   signed.select("doc_id", "next_id", "next_key", F.xxhash64("text").alias("text_key"), "n_chars",
                                 F.sha2("edited", 256).alias("edited_sha256"), "sig", "edited_sig"), "order-signatures")
    lookup = table.select(_key("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("sig").alias("next_sig")).dropDuplicates(["_id", "_key"])
    joined = table.join(lookup, (_key("next_id") == F.col("_id")) & (F.col("next_key") == F.col("_key")))
    return (joined.withColumn("near_edited", likeness("sig", "edited_sig", functions))
            .withColumn("near_next", likeness("sig", "next_sig", functions))
            .drop("_id", "_key", "text_key", "next_key", "next_sig"))
