"""Q — declarative data-quality checks as DataFrames.

Each check yields one summary row ``(check_id, model, test, column_name, failures)``;
``failures`` counts what the check's SQL would return (null rows, duplicated keys,
rows breaking an expression).  ``run_checks`` reads each table once for all its checks, whatever their kind.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUMMARY_COLUMNS = ("check_id", "model", "test", "column_name", "failures")


def _summary(df: DataFrame, model: str, test: str, column_name: str) -> DataFrame:
    """``df`` has one column ``failures``; add the identifying columns."""
    return df.select(
        F.lit(f"{test}:{model}:{column_name}").alias("check_id"), F.lit(model).alias("model"),
        F.lit(test).alias("test"), F.lit(column_name).alias("column_name"),
        F.col("failures").cast("long").alias("failures"),
    )


def not_null_rows(df: DataFrame, col: str) -> DataFrame:
    """Q1 violating rows."""
    return df.where(F.col(col).isNull())


def not_null(df: DataFrame, model: str, cols: Sequence[str]) -> DataFrame:
    """Q1 for several columns of one table in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in cols
    ])).alias("s")).select("s.*")
    return stacked.select(
        F.concat(F.lit(f"not_null:{model}:"), F.col("column_name")).alias("check_id"), F.lit(model).alias("model"),
        F.lit("not_null").alias("test"), "column_name", F.col("failures").cast("long").alias("failures"))


def duplicate_keys(df: DataFrame, cols: Sequence[str], ignore_nulls: bool = True) -> DataFrame:
    """Key values that occur more than once (Q2 / Q3 violating rows)."""
    base = df.where(F.col(cols[0]).isNotNull()) if ignore_nulls and len(cols) == 1 else df
    return base.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def unique(df: DataFrame, model: str, col: str) -> DataFrame:
    """Q2: a null key is not a duplicate."""
    failures = duplicate_keys(df, [col]).agg(F.count(F.lit(1)).alias("failures"))
    return _summary(failures, model, "unique", col)


def unique_combination(df: DataFrame, model: str, cols: Sequence[str]) -> DataFrame:
    """Q3: combinations that occur more than once (nulls group together)."""
    failures = duplicate_keys(df, cols, ignore_nulls=False).agg(F.count(F.lit(1)).alias("failures"))
    return _summary(failures, model, "unique_combination_of_columns", ",".join(cols))


def expression_rows(df: DataFrame, expression: Column, where: Column | None = None) -> DataFrame:
    """Q4 / Q5 violating rows: the expression is false (null does not fail)."""
    base = df if where is None else df.where(where)
    return base.where(~expression)


def expression_is_true(df: DataFrame, model: str, label: str, expression: Column,
                       where: Column | None = None) -> DataFrame:
    failures = expression_rows(df, expression, where).agg(F.count(F.lit(1)).alias("failures"))
    return _summary(failures, model, "expression_is_true", label)


@dataclass(frozen=True)
class Check:
    """A check of one model: rows that break it (``fails``, a condition) or keys that occur more
    than once (``keys``; a null single key is no duplicate)."""

    model: str
    test: str
    column_name: str
    fails: Column | None = None
    keys: tuple[str, ...] = ()

    @property
    def check_id(self) -> str:
        return f"{self.test}:{self.model}:{self.column_name}"

    def entry(self, number: int) -> Column:
        """What a row says to the check: null, its key, or (without a key) that it breaks it."""
        key = F.array(*[F.col(c).cast("string") for c in self.keys]) if self.keys else F.lit(None).cast("array<string>")
        said = F.struct(F.lit(number).alias("check"), key.alias("key"))
        if self.fails is not None:
            return F.when(self.fails, said)
        return F.when(F.col(self.keys[0]).isNotNull(), said) if len(self.keys) == 1 else said


def _failures(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check_id, failures) of the checks of one model that found any, from one scan.

    Rows say what they have to say to each check; equal entries are counted with map-side partial
    counts, so failing rows leave a task as one number and only keys are shuffled, those of all checks together.
    """
    said = F.filter(F.array(*[c.entry(k) for k, c in enumerate(checks)]), lambda e: e.isNotNull())
    counted = df.select(F.explode(said).alias("e")).groupBy("e.check", "e.key").agg(F.count(F.lit(1)).alias("n"))
    failures = F.sum(F.expr("CASE WHEN key IS NULL THEN n WHEN n > 1 THEN 1 ELSE 0 END"))
    names = F.array(*[F.lit(c.check_id) for c in checks])
    return counted.groupBy("check").agg(failures.alias("found")).select(F.get(names, F.col("check")).alias("check_id"), "found")


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Q6: every check's summary row in one DataFrame; each model is scanned once."""
    parts = [_failures(models[model], [c for c in checks if c.model == model]) for model in dict.fromkeys(c.model for c in checks)]
    found = reduce(DataFrame.unionByName, parts)
    declared = models[checks[0].model].sparkSession.createDataFrame(
        [(c.check_id, c.model, c.test, c.column_name) for c in checks], ", ".join(f"{c} string" for c in SUMMARY_COLUMNS[:-1]))
    return (declared.join(found, "check_id", "left")
            .withColumn("failures", F.coalesce("found", F.lit(0)).cast("long")).select(*SUMMARY_COLUMNS))


# The declared suite: 11 not-null, 6 unique, 1 combination, 3 expression checks.
SOURCE_NOT_NULL = {
    "user_core": ("id",), "user_site": ("id",), "user_sponsor": ("id",), "classroom": ("id",),
    "classroom_invite_code": ("code",), "location_core": ("id",), "sponsor_invite_code": ("id",),
}
MODEL_NOT_NULL = {
    "locations_clean": ("from_location_id",), "user_attributions": ("user_id",),
    "dim_users": ("user_id", "user_type"),
}
SOURCE_UNIQUE = (("user_site", "id"), ("classroom", "id"), ("classroom_invite_code", "code"),
                 ("location_core", "id"))
MODEL_UNIQUE = (("locations_clean", "from_location_id"), ("dim_users", "user_id"))


def _nn(model: str, cols: Sequence[str]) -> list[Check]:
    return [Check(model, "not_null", c, fails=F.col(c).isNull()) for c in cols]


def _uq(model: str, col: str) -> Check:
    return Check(model, "unique", col, keys=(col,))


def _expression(model: str, label: str, expression: Column, where: Column) -> Check:
    return Check(model, "expression_is_true", label, fails=where & ~expression)


def source_not_null_checks() -> list[Check]:
    return [c for m, cols in SOURCE_NOT_NULL.items() for c in _nn(m, cols)]


def source_unique_checks() -> list[Check]:
    return [_uq(m, c) for m, c in SOURCE_UNIQUE]


def model_not_null_checks() -> list[Check]:
    return [c for m, cols in MODEL_NOT_NULL.items() for c in _nn(m, cols)]


def model_unique_checks() -> list[Check]:
    return [_uq(m, c) for m, c in MODEL_UNIQUE]


def combination_checks() -> list[Check]:
    cols = ("user_id", "sponsor_id", "site_id")
    return [Check("dim_users", "unique_combination_of_columns", ",".join(cols), keys=cols)]


def expression_checks() -> list[Check]:
    place = F.col("city").isNotNull() | F.col("country").isNotNull()
    return [_expression("dim_users", "city IS NOT NULL OR country IS NOT NULL", place, F.col("location_id").isNotNull()),
            *(_expression("locations_clean", c, F.col(c).isNotNull(), F.col("city").isNotNull()) for c in ("city_latitude", "city_longitude"))]


def model_checks() -> list[Check]:
    return model_not_null_checks() + model_unique_checks() + combination_checks() + expression_checks()


def full_suite() -> list[Check]:
    return source_not_null_checks() + source_unique_checks() + model_checks()
