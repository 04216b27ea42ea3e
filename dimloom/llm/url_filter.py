"""URL filters: explicit rules first, and gradient-boosted trees on lexical features for the rest.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then
up to ``?``, ``#`` or the end.  A rule (verdict, host, path) fits its host and all subdomains when the
url's path starts with the rule's; the longest rule wins.

The trees see the text of the url only: lengths, depth, labels, digit ratios, character entropy,
parameter counts, and how often labelled urls with the same host suffixes (one and two labels) or
first path part were blocked.  They are fitted on labelled urls: at most about ``MAX_TRAIN`` different
urls, the first by a hash, so the table of suffixes is of bounded size and is broadcast.

Nulls and edge cases: a null url, or one without ``://``, has empty host and path, fits no rule and
is judged by the trees like any other; without labelled urls of both kinds the verdict is that of
the only kind, or allow; repeated rows are each returned; an empty table gives an empty result;
other columns are kept (an input column with the name of an output column is replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

MAX_TRAIN = 20_000
TREES = 20
DEPTH = 4
#: Rows by which a suffix's rate is drawn to the overall rate.
PRIOR_ROWS = 5.0
#: Rules up to which they are one expression; more are joined by host suffix.
MAX_EXPRESSION = 200

Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: str | Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: str | Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """``urls(host, path, ...)`` with ``rule`` (host and path of the longest that fits, else null) and ``rule_verdict``."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    if len(rules) > MAX_EXPRESSION:
        return _join_rules(urls, order)
    best = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for kind, host, path in reversed(order):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        best, verdict = F.when(fits, F.lit(host + path)).otherwise(best), F.when(fits, F.lit(kind)).otherwise(verdict)
    return urls.withColumns({"rule": best, "rule_verdict": verdict})


def _join_rules(urls: DataFrame, order: list[Rule]) -> DataFrame:
    """Different (host, path) pairs meet the rules of their host suffixes; each pair keeps its first rule."""
    table = urls.sparkSession.createDataFrame([(k, *r) for k, r in enumerate(order)], "_k int, _verdict string, _host string, _path string")
    pairs = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = (pairs.withColumn("_host", F.explode(suffixes)).join(table, "_host").where(F.col("path").startswith(F.col("_path")))
            .groupBy("host", "path").agg(F.min(F.struct("_k", "_host", "_path", "_verdict")).alias("_r")))
    found = stored(fits.select("host", "path", F.concat("_r._host", "_r._path").alias("rule"), F.col("_r._verdict").alias("rule_verdict")),
                   "url-rules")
    return urls.join(found, ["host", "path"], "left")


def _entropy(text: str) -> Column:
    """Shannon entropy, in bits, of the characters of a column."""
    size = F.greatest(F.length(text), F.lit(1))
    counts = F.transform(F.array_distinct(F.split(text, "")), lambda c: (size - F.length(F.replace(F.col(text), c))) / size)
    positive = F.filter(counts, lambda p: (p > 0) & (p < 1))
    return F.coalesce(F.aggregate(positive, F.lit(0.0), lambda a, p: a - p * F.log2(p)), F.lit(0.0))


def _count(text: str, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{pattern}]", "")).cast("double")


NUMBERS = ("url_length", "host_length", "path_length", "depth", "labels", "digits", "host_digits", "hyphens",
           "parameters", "entropy", "host_entropy", "secure", "fragment")
SUFFIXES = ("suffix1", "suffix2", "part1")


def features(urls: DataFrame) -> DataFrame:
    """``urls(url, host, path)`` with the numeric features and the suffixes."""
    urls = urls.withColumn("_url", F.coalesce("url", F.lit("")))
    size = F.greatest(F.length("_url"), F.lit(1))
    host_size = F.greatest(F.length("host"), F.lit(1))
    query = F.regexp_extract("_url", r"\?([^#]*)", 1)
    return urls.withColumns({
        "url_length": F.length("_url").cast("double"), "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"), "depth": _count("path", "/"), "labels": _count("host", "."),
        "digits": _count("_url", "0-9") / size, "host_digits": _count("host", "0-9") / host_size,
        "hyphens": _count("_url", "_-"),
        "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "entropy": _entropy("_url"), "host_entropy": _entropy("host"),
        "secure": F.col("_url").startswith("https:").cast("double"), "fragment": F.col("_url").contains("#").cast("double"),
        "suffix1": F.substring_index("host", ".", -1), "suffix2": F.substring_index("host", ".", -2),
        "part1": F.regexp_extract("path", "^/([^/]*)", 1),
    }).drop("_url")


@dataclass
class Model:
    """trees: None when there was one kind of label at most, then ``only`` is the verdict."""

    trees: GBTClassificationModel | None
    rates: DataFrame | None
    prior: float
    only: str


def _with_rates(found: DataFrame, rates: DataFrame, prior: float) -> DataFrame:
    for kind in SUFFIXES:
        own = rates.where(F.col("kind") == kind).select(F.col("suffix").alias(kind), F.col("rate").alias(f"{kind}_rate"))
        found = found.join(F.broadcast(own), kind, "left").withColumn(f"{kind}_rate", F.coalesce(f"{kind}_rate", F.lit(prior)))
    columns = [*NUMBERS, *(f"{kind}_rate" for kind in SUFFIXES)]
    return VectorAssembler(inputCols=columns, outputCol="_features").transform(found).drop(*columns)


def fit(labelled: DataFrame, max_train: int = MAX_TRAIN, trees: int = TREES, depth: int = DEPTH) -> Model:
    """Fit on ``labelled(url, verdict)``, verdict 'allow' or 'block'."""
    urls = labelled.where("url IS NOT NULL").select("url", (F.col("verdict") == "block").cast("double").alias("label")).distinct()
    urls = stored(urls, "url-labelled")
    share = max_train / max(1, urls.count())
    hashed = (F.xxhash64(F.lit("url"), "url") / F.lit(2.0 ** 64) + 0.5) <= share
    chosen = urls.where(hashed).withColumn("host", host_of("url")).withColumn("path", path_of("url"))
    train = stored(features(chosen), "url-train")
    rows = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if len(rows) < 2:
        return Model(None, None, 0.0, "block" if rows.get(1.0) else "allow")
    prior = rows[1.0] / sum(rows.values())
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("suffix")) for k in SUFFIXES]))
    rates = stored(train.select(kinds.alias("s"), "label").groupBy("s.kind", "s.suffix").agg(
        ((F.sum("label") + prior * PRIOR_ROWS) / (F.count(F.lit(1)) + PRIOR_ROWS)).alias("rate")), "url-rates")
    ready = stored(_with_rates(train, rates, prior).select("_features", "label"), "url-ready")
    learner = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=trees, maxDepth=depth, seed=17, maxBins=64)
    return Model(learner.fit(ready.coalesce(4)), rates, prior, "")


def judge(pages: DataFrame, rules: list[Rule], model: Model) -> DataFrame:
    """``pages(url, ...)`` with host, path, rule, verdict and score (the trees' chance of block)."""
    out = ["host", "path", "rule", "rule_verdict", "verdict", "score"]
    kept = [c for c in pages.columns if c not in out]
    # the judged columns travel under names of their own, so no column of the input can clash
    rows = pages.select("url", F.struct(*kept).alias("_row")).withColumn("host", host_of("url")).withColumn("path", path_of("url"))
    ruled = with_rule(rows, rules)
    if model.trees is None:
        scored = ruled.withColumn("score", F.lit(1.0 if model.only == "block" else 0.0))
    else:
        ready = _with_rates(features(ruled), model.rates, model.prior)
        trees = model.trees.copy({model.trees.predictionCol: "_guess", model.trees.rawPredictionCol: "_raw",
                                  model.trees.probabilityCol: "_chance"})
        scored = trees.transform(ready).withColumn("score", vector_to_array("_chance")[1])
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("_row.*", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "score")


def labelled_by_rules(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(url, verdict) of the urls that a rule covers: labels for ``fit``."""
    rows = pages.select("url").withColumn("host", host_of("url")).withColumn("path", path_of("url"))
    return with_rule(rows, rules).where("rule IS NOT NULL").select("url", F.col("rule_verdict").alias("verdict"))
