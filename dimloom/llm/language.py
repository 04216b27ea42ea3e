"""Language identification by string kernels.

Blended-spectrum presence kernel: k(x, y) counts the character n-grams, n = 1..``MAX_N``, that
occur in both texts (lower-cased, hashed into ``BUCKETS``), divided by sqrt(k(x, x) k(y, y)).
Nystroem landmarks approximate the kernel, one-versus-rest kernel ridge regression gives a
weight column per language, and texts are scored in batches by two matrix products.

The score does not fall for texts unlike all training rows (their kernel values, and so all
decisions, go to 0).  ``familiar`` does: a text is familiar to a language if the share of its n-grams
that the language's sample holds is at least ``FAMILIAR`` times the mean of that share over the
sample's rows, each against the other rows.

The classifier is fitted on a bounded sample: per language the ``PER_LANG`` training rows that
come first in the order of a hash of the row, at most ``MAX_ROWS`` rows in all.  Only their
n-gram presence bits reach the driver (``BUCKETS`` / 8 bytes a row).

Nulls and edge cases: a text that is null or has no letter is ``und`` with score 0 and not familiar; rows with a
null lang or null text are not learned from; without any labelled row every text is ``und``;
very long texts are read whole, in blocks; ties between languages go to the first in order of
name; repeated rows are each returned; an empty table gives an empty result; other columns are
kept (an input column with the name of an output column is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, stored

UNDETERMINED = "und"
MAX_N = 3
BUCKETS = 1 << 15
PER_LANG = 200
LANDMARKS_PER_LANG = 48
MAX_ROWS = 20_000
RIDGE = 1e-2
#: Part of a language's own mean share of known n-grams that a familiar text has at least.
FAMILIAR = 0.5
#: Code points read at once, and texts scored by one matrix product.
BLOCK = 1 << 20
ROWS = 128


def presence(text: str, flags: np.ndarray) -> None:
    """Set ``flags[b]`` for the bucket of every n-gram of ``text``."""
    text = text.lower()
    for start in range(0, len(text), BLOCK):
        block = text[max(0, start - MAX_N + 1): start + BLOCK].encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(block, np.uint32)
        gram = np.zeros(len(codes), np.uint32)
        for n in range(1, min(MAX_N, len(codes)) + 1):
            gram = gram[: len(codes) - n + 1] * np.uint32(0x9E3779B1) + codes[n - 1:] + np.uint32(n)
            mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            flags[mixed >> np.uint32(17)] = True


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass
class Model:
    """languages: names in order; landmarks: rows of presence bits; weights: landmark x language;
    seen: a row of presence bits for each language; least: the share of known n-grams of familiar texts."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    seen: np.ndarray
    least: np.ndarray

    def decision(self, flags: np.ndarray) -> np.ndarray:
        """One-versus-rest values of texts given as rows of presence flags."""
        marks = np.unpackbits(self.landmarks, axis=1, bitorder="little").astype(np.float32)
        return self._decide(flags, marks)

    def _decide(self, flags: np.ndarray, marks: np.ndarray) -> np.ndarray:
        x = flags.astype(np.float32)
        size = np.sqrt(np.maximum(x.sum(1), 1))[:, None] * np.sqrt(np.maximum(marks.sum(1), 1))[None, :]
        return ((x @ marks.T) / size) @ self.weights

    def _familiar(self, flags: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Whether texts, given as rows of presence flags, hold enough known n-grams of any language."""
        x = flags.astype(np.float32)
        return ((x @ seen.T) >= self.least * x.sum(1)[:, None]).any(1)

    def predict(self, texts: pd.Series) -> pd.DataFrame:
        names = np.full(len(texts), UNDETERMINED, dtype=object)
        scores = np.zeros(len(texts))
        familiar = np.zeros(len(texts), bool)
        known = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        if known:
            marks = np.unpackbits(self.landmarks, axis=1, bitorder="little").astype(np.float32)
            seen = np.unpackbits(self.seen, axis=1, bitorder="little").astype(np.float32)
        for at in range(0, len(known), ROWS):
            rows = known[at: at + ROWS]
            flags = np.zeros((len(rows), BUCKETS), bool)
            for k, i in enumerate(rows):
                presence(texts.iloc[i], flags[k])
            values = self._decide(flags, marks)
            best = values.argmax(1)
            names[rows] = [self.languages[b] for b in best]
            scores[rows] = np.clip((values[np.arange(len(rows)), best] + 1) / 2, 0, 1)
            familiar[rows] = self._familiar(flags, seen)
        return pd.DataFrame({"lang_pred": names, "score": scores, "familiar": familiar})


def _sample(train: DataFrame, per_lang: int) -> DataFrame:
    """(lang, bits): at most ``per_lang`` rows of each language, by a hash of the row."""
    rows = (train.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
            .withColumn("h", F.xxhash64("text", "lang")))
    counts = stored(rows.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("_n")), "language-counts")
    if counts.count() <= 100_000:  # one row a language
        counts = F.broadcast(counts)
    # a hash threshold first leaves about four times the rows wanted of a language, however large it is
    share = F.expr(f"(h / 9.223372036854775807e18 + 1) / 2 <= {4.0 * per_lang} / _n")
    near = (rows.join(counts, rows["lang"] == F.col("_lang")).where(share).select("lang", "h", "text")
            .dropDuplicates(["lang", "h"]))  # copies are one row, combined before the shuffle
    first = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h")))

    @F.pandas_udf("binary")
    def bits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for text in texts:
                flags = np.zeros(BUCKETS, bool)
                presence(text, flags)
                out.append(np.packbits(flags, bitorder="little").tobytes())
            yield pd.Series(out, dtype=object)

    return first.where(F.col("r") <= per_lang).select("lang", "h", bits("text").alias("bits"))


def fit(train: DataFrame, per_lang: int = PER_LANG, landmarks_per_lang: int = LANDMARKS_PER_LANG,
        ridge: float = RIDGE) -> Model:
    """Fit on ``train(text, lang)``; see the module text for the sample."""
    rows = _sample(train, per_lang).orderBy("h", "lang").limit(MAX_ROWS).collect()
    rows.sort(key=lambda r: (r["lang"], r["h"], bytes(r["bits"])))
    names = sorted({r["lang"] for r in rows})
    if not names:
        none = np.zeros((0, BUCKETS // 8), np.uint8)
        return Model([], none, np.zeros((0, 0), np.float32), none, np.zeros(0))
    packed = np.stack([np.frombuffer(bytes(r["bits"]), np.uint8) for r in rows])
    chosen, taken = [], dict.fromkeys(names, 0)
    for i, r in enumerate(rows):
        if taken[r["lang"]] < landmarks_per_lang:
            taken[r["lang"]] += 1
            chosen.append(i)
    bits = np.unpackbits(packed, axis=1, bitorder="little").astype(np.float32)
    norm = bits / np.sqrt(np.maximum(bits.sum(1), 1))[:, None]
    marks = norm[chosen]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    features = (norm @ marks.T).astype(np.float64) @ root
    target = np.array([[1.0 if r["lang"] == n else -1.0 for n in names] for r in rows])
    inner = features.T @ features + ridge * len(rows) / len(names) * np.eye(len(chosen))
    weights = root @ np.linalg.solve(inner, features.T @ target)
    seen, least = np.zeros((len(names), BUCKETS), bool), np.zeros(len(names))
    for k, name in enumerate(names):
        own = bits[[i for i, r in enumerate(rows) if r["lang"] == name]]
        times = own.sum(0)
        seen[k] = times > 0
        least[k] = FAMILIAR * ((own @ (times > 1).astype(np.float32)) / np.maximum(own.sum(1), 1)).mean()
    return Model(names, packed[chosen], weights.astype(np.float32), np.packbits(seen, axis=1, bitorder="little"), least)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and familiar."""
    @F.pandas_udf("lang_pred string, score double, familiar boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield model.predict(texts)

    rows = packed(docs, F.col(text).alias("text"), without=("lang_pred", "score", "familiar"))
    return rows.withColumn("found", predict("text")).select("row.*", "found.lang_pred", "found.score", "found.familiar")


def fold(doc_id: str = "doc_id", folds: int = 5):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))
