"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame, and their SQL.

Each query applies its operator with production parameters to the whole table and derives
the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, collocations, decontaminate, exact_dedup, hpylm, language, line_dedup, mixing, order_minhash, simhash, tokens, url_filter
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]


#: Rules of the url query: verdict, host, path.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The urls that the rules cover are the labelled ones; the trees judge the rest."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.fit(url_filter.labelled_by_rules(pages, URL_RULES))
    return url_filter.judge(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(language.fold() != 0))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(language.fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.with_token_counts(docs, public_tokenizers.path(vocabulary), limit=2048)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = hpylm.fit(docs.where(language.fold() != 1))
    scored = hpylm.score(docs, model)
    return scored.select("doc_id", F.coalesce(language.fold() == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per line: the place of the first line of its class, and whether it stays."""
    found = line_dedup.classify(read_table(spark, sf_dir, "documents"), max_edits=4, min_chars=20, per_chars=15)
    return found.select("doc_id", "line_no", "first_doc_id", "first_line_no", "kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a mix of the sources by the square roots of their sizes."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, block_size=1 << 18).select("doc_id", "source", *mixing.OUT)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recovered turns; roles are learned from conversations whose crc32(conv_id as text) mod 5 is not 0."""
    turns = read_table(spark, sf_dir, "conversations")
    found = chat.format_chats(turns, language.fold("conv_id") != 0)
    return found.select("conv_id", "turn", "line_no", F.coalesce(language.fold("conv_id") == 0, F.lit(False)).alias("held_out"), "role", "n_lines", "rendered")


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.fingerprints(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", order_minhash.as_text("sig").alias("fingerprint"),
                        order_minhash.as_text("edited_sig").alias("edited_fingerprint"), "near_edited", "near_next")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.cluster(read_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, seed="2")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        centroids.digest_of("centroid").alias("centroid_sha256"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.classify(read_table(spark, sf_dir, "documents"), largest=True)
    return found.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept",
                        F.lower(F.hex("sha")).alias("text_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("lang", "text")
    return collocations.mine(docs, max_words=4, min_count=30, top=2000, cover=80, scale=2_000_000)


def queries() -> dict[str, Query]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_simhash": op2_simhash,
        "op3_language": op3_language,
        "op4_token_counts": op4_token_counts,
        "op5_lm_score": op5_lm_score,
        "op6_decontaminate": op6_decontaminate,
        "op7_line_dedup": op7_line_dedup,
        "op8_mixing": op8_mixing,
        "op9_chat_format": op9_chat_format,
        "op10_order_minhash": op10_order_minhash,
        "op11_centroids": op11_centroids,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_collocations": op13_collocations,
    }


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
             [w for w in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w <> ''] AS w FROM documents),
b AS (SELECT item_id, [w for w in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w <> ''] AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(13, len(w)) AS n,
             unnest([array_to_string(w[p : p + 12], ' ')
                     FOR p IN range(1, greatest(len(w) - 12, 1) + 1)]) AS gram FROM b WHERE len(w) > 0),
p AS (SELECT rid, n, unnest(range(1, len(w) - n + 2)) AS pos, w
      FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n),
h AS (SELECT rid, p.n, pos, item_id FROM p JOIN g ON g.n = p.n AND g.gram = array_to_string(w[pos : pos + p.n - 1], ' ')),
hit AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + n)) AS x FROM h) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
       FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM h WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN it USING (rid)
"""


def _op11_sql(rounds: int = 5) -> str:
    """Rounds of assignment to all centroids and of floored means, one after the other."""
    near = """a{r} AS MATERIALIZED (SELECT rid, e, c, d FROM (
      SELECT rid, v.e, c, list_sum([CAST((p[1] - p[2]) * (p[1] - p[2]) AS HUGEINT) FOR p IN list_zip(v.e, k{r}.e)]) AS d FROM v CROSS JOIN k{r})
    QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)"""
    mean = """s{r} AS (SELECT c, i, sum(CAST(e[i] AS HUGEINT)) AS s, CAST(count(*) AS HUGEINT) AS n
      FROM (SELECT c, e, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY c, i),
    m{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM s{r} GROUP BY c),
    k{next} AS MATERIALIZED (SELECT k{r}.c, coalesce(m{r}.e, k{r}.e) AS e FROM k{r} LEFT JOIN m{r} USING (c))"""
    steps = [near.format(r=r) + ",\n" + mean.format(r=r, next=r + 1) for r in range(rounds)]
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF isfinite(x)]) = 64),
k0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, e) - 1 AS c, e FROM v
  QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, e) <= 40),
{(",").join(chr(10) + s for s in steps)},
{near.format(r=rounds)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(k{rounds}.e, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN k{rounds} USING (c)
"""


OP12_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM d
"""


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, [x for x in string_split_regex(piece, '[\x20\x09]+') if x <> ''] AS w FROM d),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS MATERIALIZED (SELECT lang, p, CAST(count(*) AS HUGEINT) AS f FROM (
  SELECT lang, unnest([w[i : i + 0] FOR i IN range(1, len(w) + 1)]) AS p FROM w UNION ALL
  SELECT lang, unnest([w[i : i + 1] FOR i IN range(1, len(w))]) FROM w UNION ALL
  SELECT lang, unnest([w[i : i + 2] FOR i IN range(1, len(w) - 1)]) FROM w UNION ALL
  SELECT lang, unnest([w[i : i + 3] FOR i IN range(1, len(w) - 2)]) FROM w) GROUP BY lang, p HAVING count(*) >= 30),
c AS (SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM f WHERE len(p) > 1),
s AS (SELECT c.lang, c.p, a, k, l.f AS l, r.f AS r, 2000000::HUGEINT * a // (l.f + r.f) AS score FROM c
  JOIN f AS l ON l.lang = c.lang AND l.p = c.p[1 : k] JOIN f AS r ON r.lang = c.lang AND r.p = c.p[k + 1 : len(c.p)]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
o AS (SELECT lang, sub, max(f) AS around FROM (
  SELECT lang, f, unnest([p[i : i + 1] FOR i IN range(1, len(p))]) AS sub FROM f WHERE len(p) > 2 UNION ALL
  SELECT lang, f, unnest([p[i : i + 2] FOR i IN range(1, len(p) - 1)]) FROM f WHERE len(p) > 3) GROUP BY lang, sub),
k AS (SELECT b.lang, array_to_string(b.p, ' ') AS phrase, a, l, r, score FROM b LEFT JOIN o ON o.lang = b.lang AND o.sub = b.p
  WHERE o.around IS NULL OR 100 * o.around < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a,
       CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM k JOIN n USING (lang) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_decontaminate": OP6_SQL, "op11_centroids": _op11_sql(), "op12_exact_dedup": OP12_SQL, "op13_collocations": OP13_SQL}
