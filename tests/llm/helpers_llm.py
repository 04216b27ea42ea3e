"""Plain Python versions that the operators are held against."""

import re

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(FOLD))


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def unite(parent, a, b):
    a, b = find(parent, a), find(parent, b)
    if a != b:
        parent[max(a, b)] = min(a, b)


def docs_of(spark, texts, extra=None):
    """A documents table of (doc_id, text) pairs, with a clashing extra column if asked."""
    df = spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in texts], DOCS)
    for name in extra or ():
        df = df.selectExpr("*", f"'extra' AS {name}")
    return df
