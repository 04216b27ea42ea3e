"""Token counts: batch encoding in Arrow functions that return lengths only.

The tokenizer is a public vocabulary file read by its own library.  A text is cut at safe
boundaries, places where the tokenizer itself always ends a token, so the counts of the pieces
add up to the count of the whole text.  For ``.json`` files whose normalizer turns white space
into single spaces and whose pre-tokenizer drops it, these are the ASCII spaces, tabs and line
breaks; other files are given whole texts.  The distinct pieces of a batch of rows are encoded
together, in groups of about ``GROUP_BYTES``, so one very long text does not make one very long
call, and the counts of pieces met before come from a table that is emptied when it is full.

Arrow batches hold a number of rows; within one, rows are encoded in lists balanced by bytes
(``BATCH_BYTES``), and the file scan deals rows over tasks by bytes.

Nulls and edge cases: a null text counts as empty (0 bytes, 0 tokens); special strings inside a
text are handled as the library does by default; repeated rows are each returned; an empty table
gives an empty result; other columns are kept by ``with_token_counts`` (an input column with the
name of an output column is replaced).
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

GROUP_BYTES = 1 << 18
BATCH_BYTES = 1 << 23
#: Pieces whose counts a task remembers, and the longest piece that it remembers.
MEMORY = 600_000
MEMORY_PIECE = 48


def _splits_at_space(path: str) -> bool:
    """Whether a tokenizer file turns white space into a space and then drops it between tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers") or [spec.get("normalizer") or {}]
    before = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
    drops = any(x.get("type") == "Split" and x.get("behavior") == "Removed" and x.get("invert")
                and r"[^\s" in x["pattern"].get("Regex", "") for x in before)
    spaces = any(x.get("type") == "Replace" and x["pattern"].get("Regex") == r"\s+" and x.get("content") == " "
                 for x in steps)
    quiet = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"])
                    for t in spec.get("added_tokens", []))
    return drops and spaces and quiet and not spec.get("post_processor")


def _lowers(path: str) -> bool:
    """Whether the file lower-cases, so that pieces differing in ASCII case have equal counts."""
    with open(path, encoding="utf-8") as f:
        steps = (json.load(f).get("normalizer") or {}).get("normalizers") or []
    return any(x.get("type") == "Lowercase" for x in steps)


class TokenCounter:
    """Counts tokens of texts with one vocabulary file (.json: tokenizers, .model: sentencepiece)."""

    def __init__(self, path: str):
        self.memory: dict[str, int] = {}
        self.special: list[str] = []
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode: Callable[[list[str]], list[int]] = lambda x: [len(y) for y in model.encode(x, num_threads=1)]
            self.pieces = self.fold = False
            return
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        self.encode = lambda x: [len(y) for y in model.encode_batch_fast(x, add_special_tokens=False)]
        self.pieces = _splits_at_space(path)
        self.fold = self.pieces and _lowers(path)
        self.special = [t["content"].lower() for t in json.loads(model.to_str()).get("added_tokens", [])]

    def _encode_groups(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text) + 16
            if size >= GROUP_BYTES:
                out += self.encode(group)
                group, size = [], 0
        return out + (self.encode(group) if group else [])

    def _cut(self, text: str) -> list[str]:
        if self.fold:
            lower = text.encode().lower().decode()  # A-Z only
            # special strings are matched before the tokenizer lower-cases, so texts with them stay as they are
            text = text if any(x in lower for x in self.special) else lower
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")

    def count(self, texts: list[str]) -> list[int]:
        if not self.pieces:
            return self._encode_groups(texts)
        if len(self.memory) > MEMORY:
            self.memory.clear()
        memory, cut = self.memory, [self._cut(t) for t in texts]
        new = list({piece for pieces in cut for piece in pieces if piece not in memory})
        memory.update(zip(new, self._encode_groups(new), strict=True))
        counts = [sum(map(memory.__getitem__, pieces)) for pieces in cut]
        for piece in new:
            if len(piece) > MEMORY_PIECE:
                del memory[piece]
        return counts


def _by_bytes(texts: pd.Series) -> Iterator[list[str]]:
    """The texts in order, in lists of about BATCH_BYTES."""
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text or "")
        size += len(part[-1])
        if size >= BATCH_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def with_token_counts(docs: DataFrame, path: str, limit: int = 2048, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit)."""
    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = TokenCounter(path)
        for texts in batches:
            yield pd.Series([n for part in _by_bytes(texts) for n in counter.count(part)], dtype="int64")

    bound_batches(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    return (docs.withColumn("n_bytes", F.octet_length(whole).cast("long"))
            .withColumn("n_tokens", tokens(whole))
            .withColumn("over_limit", F.col("n_tokens") > limit))
