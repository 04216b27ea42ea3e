"""Token counts equal the libraries' counts of whole texts."""

import random

import public_tokenizers as P
import pytest
from helpers_llm import docs_of

from dimloom.llm import tokens as T

PIECES = ["A", "b", "é", "İ", "Σ", "'s", "'LL", "'", "<|endoftext|>", "<|EndOfText|>", " ", "\n", "\t", "\r", "\x0b", " ", "1", "漢",
          "́", "!", "?", "  ", "\u0085", "\U0001F600", "ς", "don't"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_equal_the_library(name, monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(1500)] + ["word " * 3000, "x" * 5000]
    model = Tokenizer.from_file(P.path(name))
    want = [len(model.encode(t, add_special_tokens=False).ids) for t in texts]
    monkeypatch.setattr(T, "GROUP_BYTES", 500)
    monkeypatch.setattr(T, "MEMORY", 40)
    counter = T.TokenCounter(P.path(name))
    assert [n for k in range(0, len(texts), 50) for n in counter.count(texts[k:k + 50])] == want
    assert counter.pieces == (name == "word_bpe_49k.json")


def test_sentencepiece_counts():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    texts = ["Hello  world", "", "naïve 漢字\nnew line"]
    assert T.TokenCounter(P.path("piece_bpe_32k.model")).count(texts) == [len(model.encode(t)) for t in texts]


def test_rows_nulls_and_limit(spark):
    rows = [(1, "one two"), (2, None), (3, ""), (4, "é" * 3000), (1, "one two")]
    df = T.with_token_counts(docs_of(spark, rows, ["n_tokens"]), P.path("word_bpe_49k.json"), limit=2)
    got = sorted((r.doc_id, r.n_bytes, r.n_tokens > 2, r.over_limit) for r in df.collect())
    assert got == [(1, 7, False, False), (1, 7, False, False), (2, 0, False, False), (3, 0, False, False), (4, 6000, True, True)]
    assert T.with_token_counts(docs_of(spark, rows).limit(0), P.path("word_bpe_49k.json")).count() == 0
