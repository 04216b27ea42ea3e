"""Line de-duplication by a segment-partition edit join.

Lines (between line feeds) are compared with ASCII case folded and white space cut from both
ends.  Lines of ``min_chars`` characters or more form classes: equal lines, and lines linked by
chains of at most ``max_edits`` insertions, deletions or substitutions; with ``per_chars``, of at most
one for every so many characters of the shorter line, up to ``max_edits``.  The first occurrence of a
class, by (doc_id, line number), stays; shorter lines always stay.

Search: a line is cut into one segment more than the edits that its own length allows.  If a longer
line is within them, one segment occurs in it unchanged, at a position that the multi-match-aware
rule narrows to a few shifts.  Segments are indexed under (length, segment number, substring); each
line probes the indexes of its own and of the next smaller lengths, each cut by that length's edits.
First the keys alone are counted in quotient filters (``quotient_filter``), dealt by their leading
bits; keys with an index entry that another line meets become a bit table of at most 2^TABLE bits.
Then lines are sent only under keys whose bit is set; a bit that is taken by chance costs a row and
changes nothing.  Candidates whose character pairs differ in more parities than the edits allow are
dropped; the others are verified with banded bit-parallel edit distance, many pairs at a time.

A key with more than ``bucket`` lines is not expanded into pairs.  Its pivot, the line that most tasks
met, is verified against all others; those within the edits are linked to it.  By the triangle
inequality the rest needs the linked ones only where it is within twice the edits of the pivot.  The
rest is compared with what remains in blocks of ``BLOCK`` lines by ``BLOCK`` lines: inside a block lines that are
linked already are not compared again, and at most one link a line comes out.  This is exact; its
rows are linear while near copies gather around pivots, and its comparisons grow with the square
only of lines that share a key, are alike in their character pairs and are not within the edits.

Equal lines are one line of a task and of a key.  A line is known by a 64-bit digest; among n
different lines two share one with probability n^2 / 2^65.

Nulls and edge cases: a null text has no lines and stays null; an empty text is one empty line; a
null doc_id comes after all others; rows that repeat both doc_id and text are one document and keep
the same lines; repeated lines within a document count as occurrences like any others; lines of any
length are compared whole; an empty table gives an empty result; other columns are kept by
``remove_repeats`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, packed, stored
from .quotient_filter import Collector, Filter, Shape, bit_table, bits_set, from_bytes, merged

MAX_EDITS = 1
MIN_CHARS = 20
BUCKET = 128
BLOCK = 512
#: Pairs verified, or lines cut, by one run of vector operations.
PAIRS = 4096
#: Characters held by one run of vector operations.
CELLS = 1 << 19
#: Lines that a task remembers as met.
MET = 1 << 19
#: Linked lines (16 bytes each) up to which their classes are broadcast to the lines.
LISTED = 1 << 18
#: Bits of a key, and of the largest table of keys or digests.
KEY, TABLE = 41, 27
#: Keys of a shard when they are counted.
SHARD = 1 << 20
#: A key and whether it is an index key, as one value of a quotient filter.
SHAPE = Shape(2, (KEY + 1) // 2)
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
U = np.uint64
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)


def _lines_of(text: str) -> list[str]:
    return [x.strip(" \t\r\x0b\x0c") for x in text.encode().translate(_FOLD).decode().split("\n")]


def _digest(line: str) -> int:
    return xxhash.xxh64_intdigest(line, 42)


def _segment(length: np.ndarray, i: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start (from 0) and size of segment i of ``parts`` of lines of ``length``: even sizes, the rest in the last ones."""
    size, rest = length // parts, length % parts
    first_long = parts - rest
    return i * size + np.maximum(0, i - first_long), size + (i >= first_long)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_POWERS = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of BASE and of its inverse; kept for the next call."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((BASE, BACK)):
            _POWERS[i] = np.multiply.accumulate(np.concatenate([np.ones(1, U), np.full(max(n, 2 * CELLS) - 1, base, U)]))
    return _POWERS[0][:n], _POWERS[1][:n]


_COMMON = _mixed(np.arange(1, (1 << 16) + 1, dtype=U))


def _allowed(n, max_edits: int, per_chars: int):
    return np.minimum(max_edits, n // per_chars) if per_chars else np.full_like(n, max_edits)


class _Cut:
    """Lines of one run of vector operations."""

    def __init__(self, h: list[int], texts: list[str]):
        self.h = np.array(h, U).view(np.int64)
        whole = "".join(texts)
        try:
            codes = np.frombuffer(whole.encode("latin-1"), np.uint8)
        except UnicodeEncodeError:
            codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.mixed = _COMMON[codes] if codes.max() < len(_COMMON) else _mixed(codes.astype(U) + U(1))
        self.n = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begin = np.cumsum(self.n) - self.n

    def keys(self, max_edits: int, per_chars: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(lines, keys, whether they are index keys): of each line, of all shifts of all segments that it may share."""
        up, down = _powers(len(self.mixed) + 1)
        sums = np.zeros(len(self.mixed) + 1, U)
        np.cumsum(self.mixed * up[:-1], dtype=U, out=sums[1:])
        for less in range(max_edits + 1):
            every = self.n - less
            edits = _allowed(every, max_edits, per_chars)
            for t in range(max(1, less), max_edits + 1):
                rows = np.flatnonzero((edits == t) & (every > t))
                if not len(rows):
                    continue
                length, begin = every[rows], self.begin[rows]
                salt = length.astype(U) * U(64)
                for i in range(t + 1):
                    start, size = _segment(length, i, t + 1)
                    for shift in range(max(-i, less - (t - i)), min(i, less + (t - i)) + 1):
                        at = begin + start + shift
                        part = _mixed((sums[at + size] - sums[at]) * down[at])
                        yield rows, _mixed(part ^ (salt + U(i))) >> U(64 - KEY), not (less or shift)

    def pair_parities(self) -> tuple[np.ndarray, np.ndarray]:
        """128 parities of each line's character pairs, in two words: an edit changes four of them at most."""
        place = ((self.mixed[:-1] * U(3) + self.mixed[1:]) * U(BASE)) >> U(57)
        bit = U(1) << (place & U(63))
        words = []
        for word in (0, 1):
            bits = np.zeros(len(self.mixed), U)
            bits[:-1] = np.where(place >> U(6) == word, bit, U(0))
            bits[self.begin + self.n - 1] = 0
            words.append(np.bitwise_xor.reduceat(bits, self.begin).view(np.int64))
        return words[0], words[1]


def _cuts(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[list[int], list[str]]]:
    """(digests, lines) of ``least`` characters or more, each line once while the task remembers it."""
    met: set[int] = set()
    h, texts, chars = [], [], 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            for line in _lines_of(text) if text is not None else ():
                if len(line) >= least and (d := _digest(line)) not in met:
                    met.add(d)
                    h.append(d)
                    texts.append(line)
                    chars += len(line)
                    if len(h) == PAIRS or chars > CELLS:
                        yield h, texts
                        h, texts, chars = [], [], 0
            if len(met) > MET:
                met.clear()
    if h:
        yield h, texts


def _occurrences(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, text_key, line_no, h): every line of every row; h is null below ``least`` characters."""
    docs = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, line_no, h = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                lines = _lines_of(text)
                number += [i] * len(lines)
                line_no += range(len(lines))
                h += [_digest(x) if len(x) >= least else None for x in lines]
            known = np.array([x is not None for x in h], bool)
            digests = np.array([x or 0 for x in h], U).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(number, pa.int64())), batch.column("text_key").take(pa.array(number, pa.int64())),
                                              pa.array(line_no, pa.int32()), pa.array(digests, mask=~known)], ["doc_id", "text_key", "line_no", "h"])

    return docs.mapInArrow(run, T.StructType([docs.schema["doc_id"], docs.schema["text_key"],
                                              T.StructField("line_no", T.IntegerType()), T.StructField("h", T.LongType())]))


def _same(a: str, b: str, most: int, at) -> int:
    """The largest k up to ``most`` with at(a, k) == at(b, k), where that holds for all smaller ones too."""
    low, step = 0, 16
    while low + step <= most and at(a, low + step) == at(b, low + step):
        low += step
        step *= 2
    high = min(low + step, most + 1)  # fails there, or is beyond
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if at(a, mid) == at(b, mid) else (low, mid)
    return low


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """The strings without what they have in common at both ends, which leaves their distance as it is."""
    most = min(len(a), len(b))
    k = _same(a, b, most, lambda x, n: x[:n])
    a, b = a[k:], b[k:]
    k = _same(a, b, most - k, lambda x, n: x[len(x) - n:])
    return a[: len(a) - k], b[: len(b) - k]


def within(a: list[str], b: list[str], max_edits: int) -> np.ndarray:
    """Whether each pair of strings is within ``max_edits``: banded bit-parallel edit distance, vectorised over pairs."""
    ok = np.zeros(len(a), bool)
    if not len(a):
        return ok
    a, b = zip(*map(_trimmed, a, b), strict=True)
    order = sorted(range(len(a)), key=lambda i: max(len(a[i]), len(b[i])))
    at = 0
    while at < len(order):
        # in order of length: as many pairs as the last one that may belong leaves cells for
        size = max(1, min(PAIRS, CELLS // max(1, len(a[order[at]]), len(b[order[at]]))))
        longest = order[min(at + size, len(order)) - 1]
        size = max(1, min(size, CELLS // max(1, len(a[longest]), len(b[longest]))))
        group = order[at: at + size]
        at += size
        rows = [i for i in group if abs(len(a[i]) - len(b[i])) <= max_edits]
        short = [i for i in rows if min(len(a[i]), len(b[i])) <= max_edits]
        for i in short:
            ok[i] = max(len(a[i]), len(b[i])) <= max_edits or _distance(a[i], b[i]) <= max_edits
        rows = [i for i in rows if min(len(a[i]), len(b[i])) > max_edits]
        if rows:
            ok[rows] = _banded([a[i] for i in rows], [b[i] for i in rows], max_edits)
    return ok


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _codes(texts: list[str], width: int, before: int, fill: int) -> np.ndarray:
    out = np.full((width, len(texts)), fill, np.int32)
    for k, t in enumerate(texts):
        out[before: before + len(t), k] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    return out


def _banded(a: list[str], b: list[str], max_edits: int) -> np.ndarray:
    """Lengths differ by at most max_edits < both.  Bit 63 - d of a word stands for row column + max_edits - d."""
    rows, cols = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    width = int(max(rows.max(), cols.max()))
    left = _codes(a, width + 3 * max_edits + 1, max_edits, -1)
    right = _codes(b, width, 0, -2)
    one, top = np.uint64(1), np.uint64(63)
    vp = np.full(len(a), ~np.uint64(0) << np.uint64(63 - max_edits), np.uint64)
    vn = np.zeros(len(a), np.uint64)
    distance = np.full(len(a), max_edits, np.int64)
    last_row = np.zeros(len(a), np.uint64) + (one << np.uint64(62))
    for j in range(int(cols.max())):
        match = np.zeros(len(a), np.uint64)
        for d in range(2 * max_edits + 1):
            match |= (left[j + 2 * max_edits - d] == right[j]).astype(np.uint64) << np.uint64(63 - d)
        d0 = (((match & vp) + vp) ^ vp) | match | vn
        hp = vn | ~(d0 | vp)
        hn = d0 & vp
        diagonal = j < rows - max_edits
        inside = j < cols
        step = np.where(diagonal, 1 - (d0 >> top).astype(np.int64),
                        ((hp & last_row) != 0).astype(np.int64) - ((hn & last_row) != 0).astype(np.int64))
        distance += np.where(inside, step, 0)
        last_row = np.where(diagonal, last_row, last_row >> one)
        vp = hn | ~((d0 >> one) | hp)
        vn = (d0 >> one) & hp
    return distance <= max_edits


def _shared_keys(docs: DataFrame, lines: int, max_edits: int, least: int, per_chars: int) -> tuple[int, np.ndarray]:
    """Bit table (its bits, the table) of the keys under which a line is indexed and another one met."""
    keys = max(1, lines) * sum(1 for t in (max_edits,) for less in range(t + 1) for i in range(t + 1)
                               for _ in range(max(-i, less - (t - i)), min(i, less + (t - i)) + 1))
    shard_bits = min(20, max(4, (keys // SHARD).bit_length()))
    table_bits = max(shard_bits + 3, min(TABLE, (8 * keys).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Collector(SHAPE, shard_bits)
        for h, texts in _cuts(batches, least):
            found = [(key << U(1)) | U(own) for _, key, own in _Cut(h, texts).keys(max_edits, per_chars)]
            if found:
                yield from mine.add(Filter(top := np.concatenate(found), None, np.ones(len(top), np.int64)))
        yield from mine.rows()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        found = merged([from_bytes(data, SHAPE, shard_bits, shard) for data in table.column("filter").to_pylist()])
        own = found.top & U(1) == 1
        probed = np.zeros(len(own), bool)
        probed[1:] = own[1:] & (found.top[1:] == found.top[:-1] + U(1)) & (found.top[:-1] & U(1) == 0)
        top = found.top[own & (probed | (found.count > 1))]
        size = 1 << (table_bits - shard_bits)
        return pa.table({"shard": [shard], "slots": [bit_table((top >> U(KEY + 1 - table_bits)) & U(size - 1), size)]})

    slots = np.zeros((1 << table_bits) // 8, np.uint8)
    step = len(slots) >> shard_bits
    # the table has 2^TABLE bits (16 MB) at most, whatever the number of lines
    for r in (docs.select("text").mapInArrow(count, "shard long, filter binary").groupBy("shard")
              .applyInArrow(merge, "shard long, slots binary").collect()):
        slots[r["shard"] * step: (r["shard"] + 1) * step] = np.frombuffer(r["slots"], np.uint8)
    return table_bits, slots


def _members(docs: DataFrame, lines: int, max_edits: int, least: int, per_chars: int) -> DataFrame:
    """Stored (key, h, own, n, even, odd, met): lines under the keys of the bit table; met: in how many tasks."""
    model = docs.sparkSession.sparkContext.broadcast(_shared_keys(docs, lines, max_edits, least, per_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_bits, table = model.value
        for h, texts in _cuts(batches, least):
            cut = _Cut(h, texts)
            hits = [(rows[hit], key[hit], np.full(np.count_nonzero(hit), own, np.int32)) for rows, key, own in cut.keys(max_edits, per_chars)
                    if (hit := bits_set(table, key >> U(KEY - table_bits))).any()]
            if hits:
                rows, key, own = map(np.concatenate, zip(*hits, strict=True))
                even, odd = cut.pair_parities()
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(cut.h[rows]), pa.array(own), pa.array(cut.n[rows]),
                                                  pa.array(even[rows]), pa.array(odd[rows])], ["key", "h", "own", "n", "even", "odd"])

    rows = docs.select("text").mapInArrow(run, "key long, h long, own int, n long, even long, odd long")
    each = rows.groupBy("key", "h", "n", "even", "odd").agg(F.max("own").alias("own"), F.sum(F.lit(1)).alias("met"))
    out = stored(each, "lines-members")
    model.destroy()
    return out


def _texts(docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """Stored (h, norm) of the lines whose digest is in ``wanted(h)``: a bit table of fixed size lets few others through."""
    bits = max(17, min(TABLE, (16 * wanted.count()).bit_length()))
    piece = F.shiftrightunsigned("h", 80 - bits)

    def piece_of(key: tuple, table: pa.Table) -> pa.Table:
        slot = (table.column("h").to_numpy().view(U) >> U(64 - bits)) & U(0xFFFF)
        return pa.table({"piece": [key[0].as_py()], "slots": [bit_table(slot, 1 << 16)]})

    table = np.zeros((1 << bits) // 8, np.uint8)
    for r in wanted.select("h", piece.alias("piece")).groupBy("piece").applyInArrow(piece_of, "piece long, slots binary").collect():
        table[r["piece"] << 13: (r["piece"] + 1) << 13] = np.frombuffer(r["slots"], np.uint8)
    model = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, texts in _cuts(batches, least):
            h = np.array(h, U)
            some = np.flatnonzero(bits_set(model.value, h >> U(64 - bits)))
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(h[some].view(np.int64)), pa.array([texts[i] for i in some], pa.string())], ["h", "norm"])

    found = docs.select("text").mapInArrow(run, "h long, norm string").join(wanted, "h", "left_semi").dropDuplicates(["h"])
    out = stored(found, "lines-texts")
    model.destroy()
    return out


def _is_within(max_edits: int, per_chars: int, times: int = 1):
    """Column function: whether two lines are within ``times`` the edits that the shorter one allows."""
    @F.pandas_udf("boolean")
    def near(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield pd.Series(_near(list(x), list(y), max_edits, per_chars, times))

    return near


def _near(a: list[str], b: list[str], max_edits: int, per_chars: int, times: int = 1) -> np.ndarray:
    shorter = np.array([min(len(x), len(y)) for x, y in zip(a, b, strict=True)], np.int64)
    allowed = _allowed(shorter, max_edits, per_chars) * times
    ok = np.zeros(len(a), bool)
    for most in np.unique(allowed):
        rows = np.flatnonzero(allowed == most)
        ok[rows] = within([a[i] for i in rows], [b[i] for i in rows], int(most))
    return ok


def _edits(n: str, max_edits: int, per_chars: int) -> str:
    return f"least({max_edits}, {n} div {per_chars})" if per_chars else str(max_edits)


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    return (pairs.join(texts.select(F.col("h").alias("a"), F.col("norm").alias("a_text")), "a")
            .join(texts.select(F.col("h").alias("b"), F.col("norm").alias("b_text")), "b"))


def line_links(docs: DataFrame, lines: int, max_edits: int, least: int, bucket: int = BUCKET, per_chars: int = 0) -> DataFrame:
    """Verified links (a, b) between digests of the ``lines`` different lines or fewer of ``docs(text)``."""
    members = _members(docs, lines, max_edits, least, per_chars)
    keys = stored(members.groupBy("key").agg(F.count(F.lit(1)).alias("n_key"), F.max("own").alias("indexed"))
                  .where("n_key > 1 AND indexed = 1").select("key", "n_key"), "lines-keys")
    met = stored(members.join(keys, "key"), "lines-met")
    few = met.where(F.col("n_key") <= bucket).select("key", "h", "own", "n", "even", "odd")
    edits = _edits("least(x.n, y.n)", max_edits, per_chars)
    pairs = stored(few.alias("x").join(few.alias("y"), F.expr(
        f"x.key = y.key AND x.h < y.h AND x.own + y.own > 0 AND abs(x.n - y.n) <= {edits} AND bit_count(x.even ^ y.even) + bit_count(x.odd ^ y.odd) <= 4 * {edits}"))
        .select(F.col("x.h").alias("a"), F.col("y.h").alias("b")).distinct(), "lines-pairs")
    crowd = met.where(F.col("n_key") > bucket).drop("n_key")
    crowded = bool(crowd.limit(1).count())
    wanted = pairs.select(F.col("a").alias("h")).union(pairs.select("b"))
    if crowded:
        wanted = wanted.union(crowd.select("h"))
    texts = _texts(docs, stored(wanted.distinct(), "lines-wanted"), least)
    links = _with_texts(pairs, texts).where(_is_within(max_edits, per_chars)("a_text", "b_text")).select("a", "b")
    if crowded:
        links = links.union(_crowd_links(crowd, texts, max_edits, per_chars))
    return stored(links, "lines-links")


def _crowd_links(crowd: DataFrame, texts: DataFrame, max_edits: int, per_chars: int) -> DataFrame:
    """Links (a, b) that connect what all pairs under each key of ``crowd(key, h, own, n, even, odd, met)`` would."""
    pivots = crowd.where("own = 1").groupBy("key").agg(F.max(F.struct("met", "h", "n")).alias("p")).select(
        "key", F.col("p.h").alias("pivot"), F.col("p.n").alias("pivot_n"))
    # one verification a line and pivot, whatever the number of keys that they share
    sided = stored(crowd.join(pivots, "key"), "lines-sided")
    near, ring = _is_within(max_edits, per_chars), _is_within(max_edits, 0, 2)
    to_pivot = sided.where("h <> pivot").select(F.col("h").alias("a"), F.col("pivot").alias("b")).distinct()
    judged = stored(_with_texts(to_pivot, texts).select("a", "b", near("a_text", "b_text").alias("close"),
                                                        ring("a_text", "b_text").alias("ring")), "lines-judged")
    rows = sided.join(judged, (sided.h == judged.a) & (sided.pivot == judged.b), "left").select(
        "key", "h", "own", "n", "even", "odd", F.coalesce("close", F.lit(True)).alias("close"), F.coalesce("ring", F.lit(True)).alias("ring"))
    linked = judged.where("close").select("a", "b")
    # keys whose pivot did not link all lines; the linked ones take part where the rest comes near them
    rest = stored(rows.groupBy("key").agg(F.sum(F.expr("int(NOT close)")).alias("n_rest"), F.max(F.expr("NOT close AND ring")).alias("any_ring"),
                                          F.count(F.lit(1)).alias("n_all")).where("n_rest > 0"), "lines-rest")
    if not rest.limit(1).count():
        return linked
    left_blocks, right_blocks = f"((n_rest - 1) div {BLOCK} + 1)", f"((n_all - 1) div {BLOCK} + 1)"
    part = stored(rows.join(rest, "key").where("NOT close OR any_ring").join(texts, "h"), "lines-rest-texts")
    common = ["key", "h", "own", "n", "even", "odd", "close", "ring", "norm"]
    left = part.where("NOT close").select(*common, F.lit(True).alias("is_left"), F.expr(f"pmod(h, {left_blocks})").alias("i"),
                                          F.expr(f"explode(sequence(0L, {right_blocks} - 1))").alias("j"))
    right = part.select(*common, F.lit(False).alias("is_left"), F.expr(f"explode(sequence(0L, {left_blocks} - 1))").alias("i"),
                        F.expr(f"pmod(h, {right_blocks})").alias("j"))

    def compare(_: tuple, table: pa.Table) -> pa.Table:
        a, b = _block_links(table.to_pandas(), max_edits, per_chars)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return linked.union(left.union(right).groupBy("key", "i", "j").applyInArrow(compare, "a long, b long"))


def _block_links(rows: pd.DataFrame, max_edits: int, per_chars: int) -> tuple[list[int], list[int]]:
    """Links between the left and the right lines of a block, none between lines that are linked already."""
    left, right = rows[rows["is_left"]].reset_index(drop=True), rows[~rows["is_left"]].reset_index(drop=True)
    if not len(left) or not len(right):
        return [], []
    n, even, odd, h = (right[c].to_numpy() for c in ("n", "even", "odd", "h"))
    own, close = right["own"].to_numpy() > 0, right["close"].to_numpy()
    found = []
    for i, x in enumerate(left.itertuples()):
        edits = _allowed(np.minimum(n, x.n), max_edits, per_chars)
        apart = np.bitwise_count((even ^ x.even).view(U)).astype(np.int64) + np.bitwise_count((odd ^ x.odd).view(U))
        may = (apart <= 4 * edits) & (np.abs(n - x.n) <= edits) & (own | (x.own > 0)) & np.where(close, x.ring, h > x.h)
        j = np.flatnonzero(may)
        found.append(np.stack([apart[j], np.full(len(j), i), j]))
    order = np.concatenate(found, axis=1)
    order = order[:, np.argsort(order[0], kind="stable")]  # likelier links first
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    pivot = h[close]
    for x in pivot[1:]:
        root[int(x)] = int(pivot[0])
    a, b, at = [], [], 0
    while at < order.shape[1]:
        step = order[1:, at: at + PAIRS]
        at += PAIRS
        open_pairs = [(int(i), int(j)) for i, j in step.T if top(int(left["h"][i])) != top(int(h[j]))]
        if not open_pairs:
            continue
        ok = _near([left["norm"][i] for i, _ in open_pairs], [right["norm"][j] for _, j in open_pairs], max_edits, per_chars)
        for (i, j), good in zip(open_pairs, ok, strict=True):
            x, y = int(left["h"][i]), int(h[j])
            if good and top(x) != top(y):
                root[top(x)] = top(y)
                a.append(x)
                b.append(y)
    return a, b


def classify(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, bucket: int = BUCKET,
             per_chars: int = 0) -> DataFrame:
    """One row per line of each document: doc_id, text_key, line_no, first_doc_id, first_line_no, kept.

    ``first_*`` is the place of the class's first occurrence (null for lines below ``min_chars``, which have no class).
    """
    least = max(min_chars, max_edits + 1)
    occurrences = stored(_occurrences(docs.select("doc_id", "text"), least), "lines-occurrences")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "line_no")
    each = stored(occurrences.where("h IS NOT NULL").groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")), "lines-each")
    named = each.where("n > 1").select("h", F.col("first").alias("class_first"))
    if max_edits:
        links = line_links(docs, each.count(), max_edits, least, bucket, per_chars)
        roots = components(links, "lines-components")
        # the smallest line of a class is not listed as a node; a line without links is its own class
        listed = stored(roots.union(roots.select("root", "root")).distinct().toDF("h", "root"), "lines-listed")
        if listed.count() <= LISTED:
            listed = F.broadcast(listed)
        rooted = stored(each.join(listed, "h").select("h", "first", "root"), "lines-rooted")
        firsts = rooted.groupBy("root").agg(F.min("first").alias("class_first"))
        named = stored(named.join(listed, "h", "left_anti").union(rooted.join(firsts, "root").select("h", "class_first")), "lines-named")
    joined = occurrences.select("doc_id", "text_key", "line_no", "h").join(named, "h", "left")
    return joined.select(
        "doc_id", "text_key", "line_no",
        F.expr("CASE WHEN h IS NULL THEN NULL WHEN class_first IS NULL THEN doc_id ELSE class_first.doc_id END").alias("first_doc_id"),
        F.expr("CASE WHEN h IS NULL THEN NULL WHEN class_first IS NULL THEN line_no ELSE class_first.line_no END").alias("first_line_no"),
        F.expr("class_first IS NULL OR (class_first.doc_id <=> doc_id AND class_first.text_key <=> text_key "
               "AND class_first.line_no = line_no)").alias("kept"))


def remove_repeats(docs: DataFrame, max_edits: int = MAX_EDITS, min_chars: int = MIN_CHARS, per_chars: int = 0) -> DataFrame:
    """``docs`` with every line cut that is not the first of its class; rows that lose all their lines go."""
    gone = stored(classify(docs, max_edits, min_chars, per_chars=per_chars).where("NOT kept").groupBy("doc_id", "text_key")
                  .agg(F.collect_set("line_no").alias("_gone")).withColumnRenamed("doc_id", "_id"), "lines-gone")
    key = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("text_key"))
    joined = packed(docs, "doc_id", "text").join(gone, key, "left")
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains(F.col("_gone"), i))
    rest = joined.withColumn("_rest", F.when(F.col("_gone").isNotNull(), kept))
    cut = F.when(F.col("_rest").isNull(), F.col("row")).otherwise(F.col("row").withField("text", F.array_join("_rest", "\n")))
    return rest.where("_rest IS NULL OR size(_rest) > 0").select(cut.alias("row")).select("row.*")
