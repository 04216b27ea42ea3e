"""Equi-joins that stay balanced when one key holds a large share of the rows.

``skew_join`` takes the keys of the large side that hold at least ``hot_rows`` rows, spreads the
rows of those keys over ``salt_buckets`` sub-keys, and replicates only the matching rows of the
other side once per sub-key.  Cold keys join as usual on sub-key 0.  Rows with a null key can never
match, so they are spread as well.

Hot keys come from one summary a table: a mergeable frequent-items sketch of every key column that
the joins use (``JOIN_KEYS``), all in one scan, made once for each table and application and stored in
the shared folder.  Sketches are merged in two levels, so no task takes one from every other.  A
sketch keeps every key with more than about 2.7 rows in 100,000; where that is not below ``hot_rows``,
and for tables that are not declared, keys are counted exactly by an aggregate with map-side partial counts.
A sketch's count is never below the true one, so no hot key is missed; a key that is listed in
excess only costs its replication.

Both sides of a join read that one list, so they cannot disagree; when it is empty the
join is a plain one.  The list holds at most rows / hot_rows keys; it is broadcast while it is
within ``MAX_BROADCAST_KEYS`` and joined by shuffle beyond.  The salt is the row's position, so
repeated rows spread over all sub-keys; any assignment is right, because the other side holds every
sub-key.

AQE's skew-join splitting stays enabled as a second line of defence.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_email
from ..session import ensure_checkpoint_dir
from ..sources.schemas import SOURCE_SCHEMAS

SALTING_CONF = "spark.dimloom.skew.salting"
HOT_ROWS_CONF = "spark.dimloom.skew.hotKeyRows"
SALT_BUCKETS_CONF = "spark.dimloom.skew.saltBuckets"
DEFAULT_HOT_ROWS = 1_000_000
DEFAULT_SALT_BUCKETS = 64
MAX_BROADCAST_KEYS = 1_000_000

#: Keys that a sketch tracks, and the rows of a table for each of ``hot_rows`` up to which it names all hot keys.
TRACKED = 65_536
SKETCH_ROWS = 18_000
#: Sketches of the first level.
GROUPS = 256

#: Key columns of the source tables that joins use: name -> how it is made from the table's rows.
JOIN_KEYS: dict[str, dict[str, Callable[[], Column]]] = {
    "classroom": {"id": lambda: F.col("id"), "site_id": lambda: F.col("site_id")},
    "user_site": {"sponsor_id": lambda: F.col("sponsor_id")},
    "sponsor_invite_code": {"sponsor_id": lambda: F.col("sponsor_id"), "site_id": lambda: F.col("site_id")},
    "learner_classroom_membership": {"classroom_id": lambda: F.col("classroom_id")},
    "educator_classroom_membership": {"classroom_id": lambda: F.col("classroom_id")},
    "educator_invitation_record": {"email_key": lambda: normalize_email("email"), "classroom_id": lambda: F.col("classroom_id")},
    "user_join_record": {"user_id": lambda: F.col("user_id"), "sponsor_invite_code_id": lambda: F.col("sponsor_invite_code_id")},
    "user_core": {"location_id": lambda: F.col("location_id")},
    "location_address_components": {"to_location_id": lambda: F.col("to_location_id")},
}

KeySource = tuple[DataFrame, str]

_SUMMARIES: dict[tuple, tuple[str, int]] = {}
_STORED: dict[tuple, tuple[str | None, int]] = {}


def _folder(df: DataFrame) -> str:
    return f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/dimloom-hot/{uuid.uuid4().hex}"


def _identity(df: DataFrame) -> tuple:
    """Tells relations apart by their plan, with the files that it reads."""
    return df.sparkSession.sparkContext.applicationId, df.semanticHash(), *df.columns


def _declared(df: DataFrame) -> dict[str, Callable[[], Column]]:
    """The declared key columns of ``df`` if it has the columns of a source table."""
    for name, keys in JOIN_KEYS.items():
        if df.columns == SOURCE_SCHEMAS[name].fieldNames():
            return keys
    return {}


def key_summary(df: DataFrame, keys: dict[str, Callable[[], Column]]) -> tuple[str, int]:
    """(folder, rows) of the stored summary of a table: one row with the frequent (item, count) of each key column."""
    known = (*_identity(df), tuple(keys))
    if known not in _SUMMARIES:
        names = list(keys)
        rows = df.select(*[keys[c]().alias(f"k{i}") for i, c in enumerate(names)])
        first = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g")).agg(
            F.count(F.lit(1)).alias("n"), *[F.expr(f"approx_top_k_accumulate(k{i}, {TRACKED})").alias(f"s{i}") for i in range(len(names))])
        # grouped, so that an empty table gives no row: there is no sketch to combine
        whole = first.groupBy(F.lit(0).alias("all")).agg(F.sum("n").alias("n"), *[F.expr(f"approx_top_k_combine(s{i}, {TRACKED})").alias(f"s{i}") for i in range(len(names))])
        path = _folder(df)
        whole.select("n", *[F.expr(f"approx_top_k_estimate(s{i}, {TRACKED})").alias(f"top{i}") for i in range(len(names))]).write.parquet(path)
        counted = df.sparkSession.read.parquet(path).select("n").first()
        _SUMMARIES[known] = (path, counted["n"] if counted else 0)
    return _SUMMARIES[known]


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    value = df.sparkSession.conf.get(key, None)
    return int(value) if value else default


def _listed(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """(__hot_key) of the keys of ``df[key]`` with ``hot_rows`` rows or more."""
    declared = _declared(df)
    if key in declared:
        path, n = key_summary(df, declared)
        if n <= hot_rows * SKETCH_ROWS and n <= hot_rows * TRACKED:
            top = df.sparkSession.read.parquet(path).select(F.explode(f"top{list(declared).index(key)}").alias("t"))
            return top.where((F.col("t.count") >= hot_rows) & F.col("t.item").isNotNull()).select(F.col("t.item").alias("__hot_key"))
    column = declared[key]() if key in declared else F.col(f"`{key}`")
    return (df.select(column.alias("__hot_key")).where("__hot_key IS NOT NULL")
            .groupBy("__hot_key").count().where(F.col("count") >= hot_rows).select("__hot_key"))


def has_hot_key(df: DataFrame, key: str, hot_rows: int | None = None) -> bool:
    """Whether a key of ``df[key]`` holds ``hot_rows`` rows or more, nulls being a key like any other.

    By one sketch of the column, whose counts may say yes a little early; exactly where the table is
    too long for the sketch.
    """
    hot_rows = hot_rows or _conf_int(df, HOT_ROWS_CONF, DEFAULT_HOT_ROWS)
    if df.where(F.col(f"`{key}`").isNull()).limit(hot_rows).count() >= hot_rows:
        return True
    path, n = key_summary(df, {key: lambda: F.col(f"`{key}`")})
    if n > hot_rows * SKETCH_ROWS or n > hot_rows * TRACKED:
        return hot_keys(df, key, hot_rows) is not None
    top = df.sparkSession.read.parquet(path).select(F.explode("top0").alias("t"))
    return not top.where((F.col("t.count") >= hot_rows) & F.col("t.item").isNotNull()).isEmpty()


def hot_keys(df: DataFrame, key: str, hot_rows: int, *more: KeySource) -> DataFrame | None:
    """The stored list (column ``__hot_key``) of the keys of ``df[key]`` with ``hot_rows`` rows or
    more, ready for a join; None when there is none.  With ``more`` (table, key) the rows of all count:
    a key is listed that has its share of ``hot_rows`` in one of them."""
    spark = df.sparkSession
    sources = [(df, key), *more]
    known = (*(x for table, k in sources for x in (*_identity(table), k)), hot_rows)
    if known not in _STORED:
        path, share = _folder(df), -(-hot_rows // len(sources))
        found = _listed(df, key, share)
        for table, k in more:
            found = found.union(_listed(table, k, share))
        (found.distinct() if more else found).write.parquet(path)
        n = spark.read.parquet(path).count()
        _STORED[known] = (path if n else None, n)
    path, n = _STORED[known]
    if path is None:
        return None
    found = spark.read.parquet(path).withColumn("__is_hot", F.lit(True))
    return F.broadcast(found) if n <= MAX_BROADCAST_KEYS else found


def skew_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner",
              hot_rows: int | None = None, salt_buckets: int | None = None,
              keys_from: KeySource | Sequence[KeySource] | None = None, also: Column | None = None) -> DataFrame:
    """``left.join(right, left[left_key] == right[right_key], how)`` for ``how`` in inner / left.

    ``left`` is the side whose keys may be hot; ``right`` is replicated only for hot keys.
    Column names of the two sides must be disjoint.  ``keys_from=(df, col)`` counts the
    hot keys on a cheaper relation whose key multiset covers ``left``'s (typically the
    source table before the joins that led to ``left``, with one of its ``JOIN_KEYS``), or on several
    that cover it together; salting a key that turns out not to be hot only costs its replication.
    ``also`` is one more condition of a match.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"skew_join supports inner and left joins, not {how!r}")
    overlap = set(left.columns) & set(right.columns)
    if overlap:
        raise ValueError(f"skew_join needs disjoint columns, both sides have {sorted(overlap)}")
    plain = F.col(left_key) == F.col(right_key)
    if also is not None:
        plain = plain & also
    if (left.sparkSession.conf.get(SALTING_CONF, "true") or "true").lower() == "false":
        return left.join(right, plain, how)
    hot_rows = hot_rows or _conf_int(left, HOT_ROWS_CONF, DEFAULT_HOT_ROWS)
    buckets = salt_buckets or _conf_int(left, SALT_BUCKETS_CONF, DEFAULT_SALT_BUCKETS)
    first, *more = [(left, left_key)] if keys_from is None else [keys_from] if isinstance(keys_from, tuple) else keys_from
    hot = hot_keys(*first, hot_rows, *more)
    if hot is None:
        return left.join(right, plain, how)
    left_cols, right_cols = left.columns, right.columns
    position = f"pmod(monotonically_increasing_id(), {buckets})"
    salt = F.expr(f"CASE WHEN coalesce(__is_hot, false) OR `{left_key}` IS NULL THEN {position} ELSE 0 END")
    salted_left = (left.join(hot, F.col(left_key) == F.col("__hot_key"), "left")
                   .select(*left_cols, salt.alias("__salt")))
    replicas = F.expr(f"explode(CASE WHEN __is_hot THEN sequence(0, {buckets - 1}) ELSE array(0) END)")
    salted_right = (right.join(hot, F.col(right_key) == F.col("__hot_key"), "left")
                    .select(*right_cols, replicas.alias("__rsalt")))
    cond = F.expr("__salt = __rsalt") & plain
    return salted_left.join(salted_right, cond, how).select(*left_cols, *right_cols)


def left_join_fanout(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     hot_rows: int | None = None, salt_buckets: int | None = None,
                     keys_from: KeySource | None = None) -> DataFrame:
    """Left join where the *right* side may hold many rows per key (one-to-many).

    Without a hot key it is a plain left join, which makes ``right`` once.  With one, matches are
    produced with ``right`` as the salted large side; left rows without a
    match are added back through an anti join against the distinct right keys (a
    pre-aggregated, skew-free shuffle).  Equal to ``left.join(right, ..., "left")``.
    ``keys_from`` (table, key) is a cheaper relation to count the hot keys on, with the same keys.
    """
    overlap = set(left.columns) & set(right.columns)
    if overlap:
        raise ValueError(f"left_join_fanout needs disjoint columns, both sides have {sorted(overlap)}")
    salting = (left.sparkSession.conf.get(SALTING_CONF, "true") or "true").lower() != "false"
    hot_rows = hot_rows or _conf_int(left, HOT_ROWS_CONF, DEFAULT_HOT_ROWS)
    if not salting or hot_keys(*(keys_from or (right, right_key)), hot_rows) is None:
        return left.join(right, F.col(left_key) == F.col(right_key), "left")
    matched = skew_join(right, left, right_key, left_key, "inner", hot_rows, salt_buckets, keys_from)
    keyed, key = keys_from or (right, right_key)
    right_keys = keyed.where(F.col(key).isNotNull()).select(F.col(key).alias("__rk")).distinct()
    unmatched = left.join(right_keys, F.col(left_key) == F.col("__rk"), "left_anti")
    for field in right.schema.fields:
        unmatched = unmatched.withColumn(field.name, F.lit(None).cast(field.dataType))
    return matched.select(*left.columns, *right.columns).unionByName(unmatched.select(*left.columns, *right.columns))
