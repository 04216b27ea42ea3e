"""URL filter: parts of urls, rules by either way, held-out accuracy of the trees, edge cases."""

import random

from pyspark.sql import functions as F

from dimloom.llm import url_filter as U
from dimloom.llm.queries import URL_RULES

URLS = [None, "", "noscheme", "http://A.Example.NET/en/x?y#z", "a://b://c/d", "http://net", "http://net/", "https://x.net?q/", "ftp://org/fr/",
        "http://example.com/de", "http://www.example.com/de/1", "http://notexample.net/en/", "http://X.ORG/fr/a#b"]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    host, path = rest[:cut], tail[:end]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules_by_expression_and_by_join(spark, monkeypatch):
    df = spark.createDataFrame([(u,) for u in URLS + URLS[:3]], "url string").withColumn("host", U.host_of("url")).withColumn("path", U.path_of("url"))
    want = sorted((plain(u) for u in URLS + URLS[:3]), key=str)
    for most in (200, 0):
        monkeypatch.setattr(U, "MAX_EXPRESSION", most)
        got = sorted(((r.host, r.path, r.rule, r.rule_verdict) for r in U.with_rule(df, URL_RULES).collect()), key=str)
        assert got == want


def test_trees_learn_from_labelled_urls(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        bad = i % 2 == 0
        host = f"{'win-cash' if bad else 'news'}{rng.randint(0, 9)}.{rng.choice(['biz', 'com']) if bad else rng.choice(['org', 'com'])}"
        rows.append((f"http://{host}/{'/'.join('p' * rng.randint(1, 3) for _ in range(rng.randint(1, 4)))}{'?a=1&b=2' if bad else ''}", "block" if bad else "allow"))
    model = U.fit(spark.createDataFrame(rows[:300], "url string, verdict string"), trees=5)
    test = spark.createDataFrame(rows[300:], "url string, wanted string").withColumn("score", F.lit("clash")).withColumn("_row", F.lit(1))
    out = U.judge(test, [], model)
    assert out.where("wanted = verdict").count() >= 95 and out.where("rule IS NOT NULL").count() == 0
    edge = U.judge(spark.createDataFrame([(None, 1), (None, 1), ("", 2)], "url string, page_id int"), URL_RULES, model).collect()
    assert len(edge) == 3 and all(r.host == "" and r.path == "" and r.verdict in ("allow", "block") for r in edge)
    assert U.judge(test.limit(0), URL_RULES, model).count() == 0


def test_labels_of_one_kind_or_none(spark):
    df = spark.createDataFrame([("http://a.net/x",), (None,)], "url string")
    for rules, verdict in ((URL_RULES, "block"), ([], "allow")):
        model = U.fit(U.labelled_by_rules(df, rules))
        assert model.trees is None and {r.verdict for r in U.judge(df, [], model).collect()} == {verdict}
