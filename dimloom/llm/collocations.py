"""Phrase collocation mining with counting quotient filters.

Texts are lower-cased (A-Z only), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words
``[^\\x20\\x09]+``.  Everything is counted per language (null: ``und``); a phrase is a run of words of one
piece.  Candidates are phrases of 2 to ``max_words`` words that occur ``min_count`` times or more.  A
candidate is scored by its weakest cut, floor(scale * a / (l + r)) of its count and those of the two
parts; it goes if a longer candidate around it has ``cover`` percent of its count or more; the first
``top`` of each language stay.

Counting: words are counted first.  A phrase is at most as frequent as its parts, so only words with
``min_count`` get an id (of a word in its language), any other word ends a phrase, and texts become
runs of ids, stored once.  Phrases of two words, then three, then four are counted: tasks count packed
ids in counting quotient filters (``quotient_filter``), which hold every sequence exactly; the filters
are cut into shards by the leading bits of the permuted values, and the filters of a shard are merged.
Values are permuted, so shards are even and a frequent phrase is one counter of each filter.  Before
the next length, the frequent phrases' slots become a bit table of fixed size; a longer phrase is
counted only where both its parts are in it.  A slot that is taken by chance costs a counter and
changes no result.

Bounds: words are looked up in a broadcast table of the ``head`` most frequent ones; further words
are joined to the documents that have them, and, being rarer, are not skewed.  A task's filter is
sent when it has a million values; a shard has about ``SHARD`` values, through a second round of
shards where they are many.  The bit table has 2^``PRUNE_BITS`` bits at most.  Ids have 32 bits at
most: up to four billion different frequent words.

Nulls and edge cases: a null text counts as empty; an empty text has no words; texts of any length
are one run of ids; equal scores and counts are ordered by the phrase's UTF-8 bytes; repeated rows
count as often as they stand there; a null doc_id does not matter; an empty table, or one without
frequent phrases, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .quotient_filter import Collector, Shape, bit_table, bits_set, counted, from_bytes, merged, permuted, restored

#: Words of the broadcast table.
HEAD = 1 << 19
#: Different words a task counts before it sends them.
WORDS = 1 << 19
#: Ids of a stored run, of whole documents.
RUN = 1 << 18
#: Values of a shard.
SHARD = 1 << 20
#: Bits of a shard's number in the first round.
ROUTE = 12
PRUNE_BITS = 28
END = 0xFF  # ends a piece: a byte that UTF-8 does not have
_FOLD = bytes(END if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text, with the byte ``END`` between pieces."""
    return (text or b"").translate(_FOLD).replace(b"\xff", b" \xff ").split()


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes | None]]:
    return zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True)


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of docs (lang, text): occurrences of each word, and of all where ``word`` is null."""

    def rows(found: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in found.items():
            counts.pop(b"\xff", None)
            n = np.fromiter(counts.values(), np.int64, len(counts))
            words = pa.array([*counts, None], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), words, pa.array(np.append(n, n.sum()))],
                                             ["lang", "word", "n"])
        found.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)
        size = 0
        for batch in batches:
            for lang, text in _texts(batch):
                mine = found[lang]
                size -= len(mine)
                mine.update(words_of(text))
                size += len(mine)
                if size > WORDS:
                    yield from rows(found)
                    size = 0
        yield from rows(found)

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _with_ids(words: DataFrame) -> tuple[DataFrame, int]:
    """Stored words with ``place`` -> the same with ``id`` from 1 on, and the bits of the largest id."""
    low = (1 << 33) - 1
    row, part = F.col("place").bitwiseAND(F.lit(low)), F.shiftright("place", 33)
    most = words.agg(F.max(row), F.max(part)).first()
    if most[0] is None:
        return words.withColumn("id", F.col("place")), 0
    wide = most[0].bit_length()
    return words.withColumn("id", F.shiftleft(part, wide).bitwiseOR(row) + 1), max(8, ((most[1] << wide) + most[0] + 1).bit_length())


def _head_cut(words: DataFrame, head: int) -> int:
    """The least power of two that at most ``head`` words reach with their counts."""
    classes = {r[0]: r[1] for r in words.groupBy(F.floor(F.log2("n")).cast("int")).count().collect()}
    taken, cut = 0, 64
    while cut > 0 and taken + classes.get(cut - 1, 0) <= head:
        cut -= 1
        taken += classes.get(cut, 0)
    return 1 << cut


def _runs(docs: DataFrame, words: DataFrame, head: int, dtype: type) -> DataFrame:
    """(ids, n): texts as runs of ids, zeros where no phrase goes on; n ids of frequent words each."""
    cut = _head_cut(words, head)
    spark = docs.sparkSession
    table: dict[str, dict[bytes, int]] = defaultdict(dict)
    found = words.where(F.col("n") >= cut).select("lang", F.col("word").cast("binary"), "id").toArrow()  # at most ``head`` rows
    for lang, word, i in zip(*(found.column(k).to_pylist() for k in range(3)), strict=True):
        table[lang][word] = i
    shared = spark.sparkContext.broadcast(dict(table))
    rare = words.where(F.col("n") < cut)
    if cut > 1 and rare.limit(1).count():
        docs = _with_rare_words(docs, rare, shared)

    def packed(texts: list[np.ndarray]) -> pa.RecordBatch:
        ids = np.concatenate(texts)
        on = np.zeros(len(ids) + 2, bool)
        on[1:-1] = ids > 0
        ids = np.where(on[1:-1] & (on[:-2] | on[2:]), ids, 0)  # a word alone is no phrase
        keep = ids > 0
        keep[1:] |= ids[:-1] > 0
        ids = ids[keep].astype(dtype)
        return pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([int((ids > 0).sum())], pa.int64())], ["ids", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, size, known = [], 0, shared.value
        for batch in batches:
            more = batch.column("rare").to_pylist() if "rare" in batch.schema.names else repeat(None, batch.num_rows)
            for (lang, text), rare_words in zip(_texts(batch), more, strict=True):
                words_here, get = words_of(text), known.get(lang, {}).get
                if rare_words:
                    own = {w["word"].encode(): w["id"] for w in rare_words}
                    ids = [get(w) or own.get(w, 0) for w in words_here]
                else:
                    ids = map(get, words_here, repeat(0))
                texts += [np.fromiter(ids, np.uint64, len(words_here)), np.zeros(1, np.uint64)]
                size += len(words_here) + 1
                if size >= RUN:
                    yield packed(texts)
                    texts, size = [], 0
        if texts:
            yield packed(texts)

    out = stored(docs.mapInArrow(run, "ids binary, n long"), "collocations-runs")
    shared.destroy()
    return out


def _with_rare_words(docs: DataFrame, rare: DataFrame, shared) -> DataFrame:
    """docs (lang, text) with ``rare``: the (word, id) of their frequent words that are not in the broadcast table."""
    texts = stored(docs.withColumn("row", F.monotonically_increasing_id()), "collocations-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, (lang, text) in zip(batch.column("row").to_pylist(), _texts(batch), strict=True):
                words = list(set(words_of(text)).difference(shared.value.get(lang, ()), (b"\xff",)))
                yield pa.RecordBatch.from_arrays([pa.array([row] * len(words), pa.int64()), pa.array([lang] * len(words), pa.string()),
                                                  pa.array(words, pa.binary()).cast(pa.string())], ["row", "lang", "word"])

    met = texts.mapInArrow(run, "row long, lang string, word string").join(rare.select("lang", "word", "id"), ["lang", "word"])
    each = met.groupBy("row").agg(F.collect_list(F.struct("word", "id")).alias("rare"))
    return stored(texts.join(each, "row", "left").select("lang", "text", "rare"), "collocations-rare")


def _positions(ids: np.ndarray, n: int, bits: int, tables: dict[int, tuple[int, np.ndarray]]) -> np.ndarray:
    """Places of the phrases of n words all of whose shorter phrases may be frequent."""
    on = ids > 0
    at = np.flatnonzero(on[:-1] & on[1:])
    for m in range(2, n):
        shape = Shape(m, bits)
        table_bits, table = tables[m]
        slot = permuted([ids[at + k] for k in range(m)], shape)[0] >> np.uint64(shape.top_bits - table_bits)
        at = at[bits_set(table, slot)]
        may = np.zeros(len(ids) + 1, bool)
        may[at] = True
        at = at[may[at + 1]]
    return at


def _phrases(runs: DataFrame, n: int, bits: int, total: int, min_count: int, tables, dtype: type, route: int) -> DataFrame:
    """Stored (phrase, f, shard, slots): frequent phrases of n words, and a row for each shard with its part of the bit table."""
    shape = Shape(n, bits)
    shard_bits = min(max(4, (total // SHARD).bit_length()), shape.top_bits - 3)
    first_bits = min(shard_bits, route)
    table_bits = min(shape.top_bits, max(shard_bits + 3, min(PRUNE_BITS, (16 * total // min_count).bit_length())))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, known = Collector(shape, first_bits), tables.value
        for batch in batches:
            for data in batch.column("ids").to_pylist():
                ids = np.frombuffer(data, dtype)
                at = _positions(ids, n, bits, known)
                yield from mine.add(counted(*permuted([ids[at + k] for k in range(n)], shape)))
        yield from mine.rows()

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Collector(shape, shard_bits)
        for batch in batches:
            for s, data in zip(batch.column("shard").to_pylist(), batch.column("filter").to_pylist(), strict=True):
                yield from mine.add(from_bytes(data, shape, first_bits, s))
        yield from mine.rows()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        found = merged([from_bytes(data, shape, shard_bits, shard) for data in table.column("filter").to_pylist()])
        often = np.flatnonzero(found.count >= min_count)
        top = found.top[often]
        phrases = restored(top, None if found.rest is None else found.rest[often], shape).astype(np.int64)
        size = 1 << (table_bits - shard_bits)
        here = bit_table((top >> np.uint64(shape.top_bits - table_bits)) & np.uint64(size - 1), size)
        lists = pa.ListArray.from_arrays(np.arange(0, len(often) * n + 1, n, dtype=np.int32), phrases.ravel()).to_pylist()
        return pa.table({"phrase": pa.array([*lists, None], pa.list_(pa.int64())), "f": pa.array([*found.count[often].tolist(), None], pa.int64()),
                         "shard": pa.array([shard] * (len(often) + 1), pa.int64()),
                         "slots": pa.array([None] * len(often) + [here], pa.binary())})

    kind = "shard long, filter binary"
    filters = runs.select("ids").mapInArrow(count, kind)
    if shard_bits > first_bits:
        filters = filters.repartition("shard").mapInArrow(divide, kind)
    out = stored(filters.groupBy("shard").applyInArrow(merge, "phrase array<long>, f long, shard long, slots binary"), f"collocations-{n}")
    slots = np.zeros((1 << table_bits) // 8, np.uint8)  # of fixed size
    step = len(slots) >> shard_bits
    for r in out.where("slots IS NOT NULL").select("shard", "slots").collect():
        slots[r["shard"] * step: (r["shard"] + 1) * step] = np.frombuffer(r["slots"], np.uint8)
    return out.where("phrase IS NOT NULL").select("phrase", "f"), (table_bits, slots)


def _big(col: str) -> Column:
    return F.col(col).cast("decimal(20,0)")


def _scored(often: DataFrame, scale: int) -> DataFrame:
    """(phrase, a, l, r, score) of phrases (phrase, f): the lowest-scoring cut of each of two words or more, ties to the first."""
    cuts = often.where("size(phrase) > 1").selectExpr("phrase", "f AS a", "explode(sequence(1, size(phrase) - 1)) AS k").selectExpr(
        "phrase", "a", "k", "slice(phrase, 1, k) AS head", "slice(phrase, k + 1, size(phrase) - k) AS tail")
    both = (cuts.join(often.select(F.col("phrase").alias("head"), F.col("f").alias("l")), "head")
            .join(often.select(F.col("phrase").alias("tail"), F.col("f").alias("r")), "tail"))
    score = F.expr(f"(CAST(a AS DECIMAL(20,0)) * {scale}) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = both.groupBy("phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select("phrase", "a", "best.l", "best.r", "best.score")


def _covered(often: DataFrame) -> DataFrame:
    """(phrase, around): the largest count of a longer phrase around each phrase of two words or more."""
    return (often.where("size(phrase) > 2").selectExpr("phrase AS whole", "f", "explode(sequence(2, size(phrase) - 1)) AS m")
            .selectExpr("whole", "f", "m", "explode(sequence(1, size(whole) - m + 1)) AS i")
            .groupBy(F.expr("slice(whole, i, m)").alias("phrase")).agg(F.max("f").alias("around")))


def mine(docs: DataFrame, max_words: int = 4, min_count: int = 30, top: int = 2000, cover: int = 80, scale: int = 2_000_000,
         head: int = HEAD, route: int = ROUTE) -> DataFrame:
    """The first ``top`` phrases of each language of ``docs(lang, text)``: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    found = stored(word_counts(docs).where(F.col("word").isNull() | (F.col("n") >= min_count))
                   .withColumn("place", F.monotonically_increasing_id()), "collocations-words")
    totals = found.where("word IS NULL").select("lang", "n")
    words, bits = _with_ids(found.where("word IS NOT NULL"))
    if max_words * bits > 128 or max_words < 2:
        raise ValueError(f"{max_words} ids of {bits} bits: from two ids to 128 bits can be packed")
    often = words.select(F.array("id").alias("phrase"), F.col("n").alias("f"))
    if bits:
        dtype = np.uint32
        runs = _runs(docs, words, head, dtype)
        total = runs.agg(F.sum("n")).first()[0] or 0
        tables: dict[int, tuple[int, np.ndarray]] = {}
        for n in range(2, max_words + 1):
            shared = spark.sparkContext.broadcast(tables)
            level, tables[n] = _phrases(runs, n, bits, total, min_count, shared, dtype, route)
            shared.destroy()
            often = often.union(level)
    scored = _scored(often, scale).join(_covered(often), "phrase", "left").where(
        F.col("around").isNull() | (_big("around") * 100 < _big("a") * cover))
    named = words.select(F.col("id"), "lang", "word")
    lead = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    with_lang = scored.withColumn("id", F.col("phrase")[0]).join(named.select("id", "lang"), "id").drop("id")
    # ties at the end stay until the words are there to tell them apart
    ahead = stored(with_lang.withColumn("place", F.rank().over(lead)).where(F.col("place") <= top).drop("place"), "collocations-ahead")
    spelled = (ahead.select("phrase", F.posexplode("phrase").alias("i", "id")).join(named.select("id", "word"), "id")
               .groupBy("phrase").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w"))
               .select("phrase", F.array_join("w.word", " ").alias("spelled")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "spelled"))
    return (ahead.join(spelled, "phrase").withColumn("rank", rank).where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), F.col("spelled").alias("phrase"), "a", "l", "r", "n", "score"))
