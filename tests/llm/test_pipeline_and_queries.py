"""The pipeline's stages by plain versions and edge rows; the registered queries and their SQL."""

import os
import sys

import pytest
from helpers_llm import docs_of

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__ as E  # noqa: E402
import corpus_pipeline as P  # noqa: E402
from compare import compare, duck  # noqa: E402
from dimloom.llm import queries as Q  # noqa: E402
from dimloom.llm.common import components  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


def test_registered():
    assert {n.split("_")[0] for n in Q.queries()} == {f"op{k}" for k in range(1, 14)}
    assert set(Q.queries()) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql(spark, name):
    ok, msg = compare(E.queries()[name](spark, SF), duck(SF), E.oracle_sql()[name])
    assert ok, msg


def test_stages(spark):
    """Each planted row goes at its stage; clean rows, nulls of other columns and extra columns stay."""
    clean = [(i, f"The thing number{i} of and{i} is with that{i} in for the was{i} by of on thing{i}{i}.") for i in range(1, 9)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    shared = "the same long line that stands in more than one of these documents here"
    planted = [(20, None), (21, "1234 !!"), (30, f"{clean[0][1]}"), (31, shared + "\nand the other of this"), (32, shared + "s\nthat is for them in the end"),
               (40, item + " the thing"), (None, "a row of the corpus without any id that is the one"), (1, clean[0][1])]
    docs = docs_of(spark, clean + planted, ["fp", "_bad"])
    by = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["language", "line_dedup", "near_duplicates", "decontaminate", "mix"]
    after = by["language"](spark, docs, SF)
    assert after.columns == docs.columns and sorted((r.doc_id for r in after.collect()), key=str) == sorted([*range(1, 9), 30, 31, 32, 40, None, 1], key=str)
    lines = by["line_dedup"](spark, after, SF)
    texts = {r.doc_id: (r.text, r.n_chars) for r in lines.collect()}
    assert 30 not in texts and texts[31][0].startswith(shared) and texts[32] == ("that is for them in the end", 27)
    one = by["near_duplicates"](spark, after, SF)
    assert sorted((r.doc_id for r in one.collect()), key=str) == sorted([*range(1, 9), 31, 32, 40, None], key=str)
    safe = by["decontaminate"](spark, docs, SF)
    assert safe.count() == docs.count() - 1 and safe.where("doc_id = 40").count() == 0 and safe.columns == docs.columns
    mixed = by["mix"](spark, docs, SF)
    assert mixed.count() == docs.count() and set(docs.columns) < set(mixed.columns)
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_run(spark):
    out = P.run(spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0.7 * n < out.count() <= n and out.select("doc_id").distinct().count() == out.count()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, k) for k in range(1, 60)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(101, 161)}, **{k: 0 for k in range(1, 60)}}


def test_language_stage_rejects_unknown_scripts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    strange = docs_of(spark, [(-1, "这是一个测试文本,关于天气和新闻。" * 20), (-2, "Это тестовый текст о погоде и новостях")])
    after = P.language_stage(spark, docs.unionByName(strange.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "n_chars")), SF)
    assert after.where("doc_id < 0").count() == 0
    assert after.count() == docs.where(r"text rlike '\\p{L}'").count()
