"""Benchmark decontamination: remove training documents, or spans of them, that repeat test items.

Words are runs of ASCII digits, letters (A-Z lower-cased) and non-ASCII characters.  A window is
``window`` (13) consecutive words of an item; an item of fewer words, but not none, is one
window.  A document word inside any occurrence of a window is hit.  A document is contaminated
when hits make up at least one word in ``min_share`` (20).

The windows' 64-bit hashes form a broadcast hash set: a table that Spark joins, not a value of the
driver or of the plan.  Each document is scanned once: its positions, with the hash of the words
from there, are looked up in the set, and only those found go on; they are verified word for word
against the windows.  The set's size is checked: up to ``MAX_WINDOWS`` windows (16 bytes each) it is
broadcast, beyond that the hashes of all positions meet it by shuffle, without the words, which are
looked up again for positions that matched.  Everything is DataFrame functions.

Nulls and edge cases: a null or empty text has no words and no hits; a null ``item_id`` marks
hits but is not counted or listed as an item; an empty benchmark hits nothing; repeated rows are
each returned (or removed); other columns are ignored by ``scan`` and kept by the removers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, packed, stored

WINDOW = 13
MIN_SHARE = 20
#: Windows up to which their hashes, and up to which their words are broadcast: 16 MB and about 20 MB.
MAX_WINDOWS, MAX_WORDS = 1 << 20, 1 << 17
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_WORD, RAW_SEPARATOR = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def words_of(text: str) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS), "")


def _gram(length: int, call: str) -> str:
    """SQL call over the ``length`` words from position i of the array ``words``."""
    return f"{call}{', '.join(f'get(words, i + {k})' for k in range(length))})"


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (gram, len, items, h): windows of all items, with the ids of the items that have them."""
    items = benchmark.select("item_id", words_of("text").alias("words")).where("size(words) > 0")
    parts = [f"WHEN size(words) = {n} THEN array(struct({_gram(n, 'concat_ws(" ", ').replace('i + ', '')} AS gram, "
             f"{n} AS len, {_gram(n, 'xxhash64(').replace('i + ', '')} AS h))" for n in range(1, window)]
    full = (f"transform(sequence(0, size(words) - {window}), i -> struct({_gram(window, 'concat_ws(" ", ')} AS gram, "
            f"{window} AS len, {_gram(window, 'xxhash64(')} AS h))")
    each = items.selectExpr("item_id", f"inline(CASE {' '.join(parts)} ELSE {full} END)")
    return each.groupBy("gram", "len", "h").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))


def _positions(lengths: list[int]) -> Column:
    """Array of (pos, len, h): the hash of the words of every window of each of ``lengths`` words."""
    parts = [f"transform(CASE WHEN n_words >= {n} THEN sequence(0, n_words - {n}) ELSE array() END, "
             f"i -> struct(i AS pos, {n} AS len, {_gram(n, 'xxhash64(')} AS h))" for n in lengths]
    return F.expr(f"concat({', '.join(parts)})")


def _gram_at(pos: str, n: str) -> Column:
    return F.expr(f"CASE WHEN {n} > 0 THEN array_join(slice(words, {pos} + 1, {n}), ' ') END")


def _hits(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """(columns of docs but text, n_words, hit, items): a row per verified position, and one at least per document."""
    found = stored(windows(benchmark, window), "decontaminate-windows")
    lengths = {r["len"]: r["n"] for r in found.groupBy("len").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(lengths.values())
    if total > MAX_WINDOWS:
        docs = stored(docs, "decontaminate-rows")
    scanned = docs.withColumn("words", words_of("text")).withColumn("n_words", F.size("words")).drop("text")
    rest = [c for c in scanned.columns if c != "words"]
    if not total:
        return scanned.drop("words").selectExpr("*", "cast(null AS struct<pos:int,len:int>) AS hit",
                                                "cast(null AS array<string>) AS items")
    hashes = found.select(F.col("h").alias("taken")).distinct()
    if total <= MAX_WINDOWS:
        # one more position, which never matches, stands for the document itself
        itself = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(0).alias("len"), F.lit(None).cast("long").alias("h")))
        spread = scanned.select("*", F.inline(F.concat(itself, _positions(sorted(lengths)))))
        near = (spread.join(F.broadcast(hashes), F.col("h") == F.col("taken"), "left")
                .where("pos < 0 OR taken IS NOT NULL").select(*rest, "pos", "len", _gram_at("pos", "len").alias("gram")))
    else:
        spread = scanned.select("_row", F.inline(_positions(sorted(lengths))))
        at = (spread.join(hashes, F.col("h") == F.col("taken"), "left_semi")
              .groupBy("_row").agg(F.collect_list(F.struct("pos", "len")).alias("at")))
        near = (scanned.join(at, "_row", "left").select(*rest, "words", F.explode_outer("at").alias("c"))
                .select(*rest, "c.pos", "c.len", _gram_at("c.pos", "c.len").alias("gram")))
    grams = found.select("gram", F.col("len").alias("gram_len"), "items")
    same = (F.col("gram") == F.col("gram_of")) & (F.col("len") == F.col("gram_len"))
    joined = near.withColumnRenamed("gram", "gram_of").join(F.broadcast(grams) if total <= MAX_WORDS else grams, same, "left")
    return joined.select(*rest, F.when(F.col("items").isNotNull(), F.struct("pos", "len")).alias("hit"), "items")


_COVER = """aggregate(sort_array(hits), struct(0 AS n, 0 AS upto),
    (a, h) -> struct(a.n + greatest(0, h.pos + h.len - greatest(a.upto, h.pos)) AS n,
                     greatest(a.upto, h.pos + h.len) AS upto)).n"""


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_share: int = MIN_SHARE) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, text_key, n_words, n_hit, hits, items, contaminated.

    ``hits`` are the (pos, len) of the windows found, in words; ``items`` the sorted ids of the items.
    ``text_key`` is a digest of the text, of which the verdict is a function.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "text",
                       text_key("text").alias("text_key"))
    found = _hits(rows, benchmark, window).drop("text")
    each = found.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_key").alias("text_key"), F.first("n_words").alias("n_words"),
        F.collect_set("hit").alias("hits"), F.collect_set("items").alias("items"))
    return (each.withColumn("n_hit", F.expr(_COVER))
            .withColumn("items", F.sort_array(F.array_distinct(F.flatten("items"))))
            .withColumn("contaminated", F.expr(f"n_hit > 0 AND {min_share}L * n_hit >= n_words"))
            .select("doc_id", "text_key", "n_words", "n_hit", "hits", "items", "contaminated"))


def text_key(text: str) -> Column:
    return F.xxhash64(F.length(text), F.col(text), F.lit("text"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                     min_share: int = MIN_SHARE) -> DataFrame:
    """``docs`` without the contaminated rows; all columns stay."""
    bad = stored(scan(docs, benchmark, window, min_share).where("contaminated")
                 .select(F.col("text_key").alias("_bad")).distinct(), "decontaminate-bad")
    return packed(docs, "text").join(bad, text_key("text") == F.col("_bad"), "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with every hit word, and the separators after it, cut from ``text``; all columns stay."""
    found = stored(scan(docs, benchmark, window).where("n_hit > 0")
                   .groupBy(F.col("text_key").alias("_key")).agg(F.first("hits").alias("_hits")), "decontaminate-spans")
    joined = packed(docs, "text").join(found, text_key("text") == F.col("_key"), "left")
    chunks = F.regexp_extract_all("text", F.lit(f"{RAW_WORD}+{RAW_SEPARATOR}*"), F.lit(0))
    kept = F.filter(chunks, lambda _, i: ~F.exists("_hits", lambda h: (i >= h["pos"]) & (i < h["pos"] + h["len"])))
    cut = F.concat(F.regexp_extract("text", f"^{RAW_SEPARATOR}*", 0), F.array_join(kept, ""))
    return joined.select(F.when(F.col("_hits").isNull(), F.col("row")).otherwise(F.col("row").withField("text", cut)).alias("row")).select("row.*")
