"""Language identification: held-out accuracy, texts without letters, nothing to learn from."""

from helpers_llm import docs_of
from pyspark.sql import functions as F

from dimloom.llm import language as L

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs.where(L.fold() != 0))
    found = L.identify(docs, model).where(L.fold() == 0)
    right, n, low, high = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1)), F.min("score"), F.max("score")).first()
    assert right / n >= 0.97 and 0 <= low and high <= 1
    assert model.landmarks.shape[0] <= 4 * L.LANDMARKS_PER_LANG
    edge = docs_of(spark, [(1, None), (2, ""), (3, "12 !? ²"), (4, "the " * 50000), (5, "the of and that is"), (5, "the of and that is")], ["score"])
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(edge, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == got[5][0] == "en"


def test_nothing_to_learn_from(spark):
    docs = docs_of(spark, [(1, "some text"), (2, None)])
    model = L.fit(docs.where("false"))
    assert [(r.lang_pred, r.score) for r in L.identify(docs, model).collect()] == [("und", 0.0)] * 2
    assert L.identify(docs.where("false"), model).count() == 0


def test_blocks_see_every_ngram(monkeypatch):
    import numpy as np

    text = "abcdefghijklmnopqrstuvwxyz" * 7
    whole, parts = np.zeros(L.BUCKETS, bool), np.zeros(L.BUCKETS, bool)
    L.presence(text, whole)
    monkeypatch.setattr(L, "BLOCK", 10)
    L.presence(text, parts)
    assert (whole == parts).all()


def test_texts_of_no_learned_language_are_not_familiar(spark):
    """Unknown scripts and strings of signs with letters among them go; held-out documents and short clean texts stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs.where(L.fold() != 0))
    strange = ["这是一个测试文本,关于天气和新闻。" * 20, "Это тестовый текст о погоде и новостях в городе Москва", "αυτό είναι ένα κείμενο",
               "ж %$#@!~^&*() ф =+[]{}<> щ"]
    clean = ["the of and that is", "Elle un la", "der und die"]
    got = {r.doc_id: r.familiar for r in L.identify(docs_of(spark, list(enumerate(strange + clean)), ["familiar"]), model).collect()}
    assert [got[i] for i in range(7)] == [False] * 4 + [True] * 3
    held = L.identify(docs.where(L.fold() == 0).where(r"text rlike '\\p{L}'"), model)
    assert held.where("NOT familiar").count() == 0
