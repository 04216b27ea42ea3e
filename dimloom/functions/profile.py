"""Derived profile fields of a person, as Column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ASCII_SPACE

# User type codes and their labels.
USER_TYPE_NAMES = (("E", "Educator"), ("CL", "Classroom Learner"), ("IL", "Independent Learner"))
# The email that marks a test account although it has no 'test' in it.
TEST_EMAIL = "educatorst1@example.com"
# Race groups counted for 'Multiracial' (each entry: substrings, any matches).
RACE_GROUPS = (
    ("White",),
    ("Hispanic", "Latinx"),
    ("Black", "African American"),
    ("South Asian", "East Asian"),
    ("Native Hawaiian or other Pacific Islander",),
    ("Native American or Alaska Native",),
    ("Other",),
)
# Exact race answers and their category, tested in this order.
RACE_EXACT = (
    ("Hispanic or Latinx", "Hispanic"),
    ("Black or African American", "Black"),
)
RACE_EXACT_AFTER_ASIAN = (
    ("Native Hawaiian or other Pacific Islander", "Native Hawaiian or other Pacific Islander"),
    ("Native American or Alaska Native", "Native American or Alaska Native"),
    ("White", "White"),
    ("Other", "Other"),
)
PREFER_NOT = "Prefer Not To Say"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def user_type_name(type_code: Column | str) -> Column:
    """Label of a user type code; unknown or null codes give null."""
    t = _col(type_code)
    out = F.when(t == USER_TYPE_NAMES[0][0], F.lit(USER_TYPE_NAMES[0][1]))
    for code, label in USER_TYPE_NAMES[1:]:
        out = out.when(t == code, F.lit(label))
    return out


def _has_test(c: Column) -> Column:
    # Trimming the ends cannot create or remove an inner 'test', so only the inner
    # whitespace removal matters.  Null input gives null, which counts as false.
    return F.regexp_replace(F.lower(c), ASCII_SPACE + "+", "").contains("test")


def is_test_user(first_name: Column | str, last_name: Column | str, email: Column | str) -> Column:
    e = _col(email)
    hit = _has_test(_col(first_name)) | _has_test(_col(last_name)) | _has_test(e) | (e == TEST_EMAIL)
    return F.coalesce(hit, F.lit(False))


def race_category(race: Column | str) -> Column:
    """Race category of a comma-separated answer, rules tested in this order:

    no answer or any 'prefer not to say' (any case) -> Prefer Not To Say; more than one
    group named -> Multiracial; the exact Hispanic and Black answers; any South or East
    Asian -> Asian; the remaining exact answers; everything else -> Other.  Group tests
    are case-sensitive substring tests, so 'Asian' or 'Hispanic' alone end as Other.
    """
    r = _col(race)
    n_groups = sum((F.when(_any_contains(r, subs), 1).otherwise(0) for subs in RACE_GROUPS), F.lit(0))
    out = F.when(r.isNull() | F.lower(r).contains("prefer not to say"), F.lit(PREFER_NOT))
    out = out.when(n_groups > 1, F.lit("Multiracial"))
    for exact, label in RACE_EXACT:
        out = out.when(r == exact, F.lit(label))
    out = out.when(r.contains("South Asian") | r.contains("East Asian"), F.lit("Asian"))
    for exact, label in RACE_EXACT_AFTER_ASIAN:
        out = out.when(r == exact, F.lit(label))
    return out.otherwise(F.lit("Other"))


def _any_contains(c: Column, subs: tuple[str, ...]) -> Column:
    cond = c.contains(subs[0])
    for s in subs[1:]:
        cond = cond | c.contains(s)
    return cond


def gender_category(gender: Column | str) -> Column:
    """Gender summary of a multi-select answer, rules tested in this order:

    no answer or exactly 'Prefer not to say' -> Prefer Not To Say; self-description, or
    both Man and Woman, or exactly Non-binary -> Non-binary; exactly Man / Woman -> itself;
    anything else (e.g. 'Man,Non-binary') -> Prefer Not To Say.
    """
    g = _col(gender)
    return (
        F.when(g.isNull() | (g == "Prefer not to say"), F.lit(PREFER_NOT))
        .when(g.contains("Prefer to self-describe"), F.lit("Non-binary"))
        .when(g.contains("Man") & g.contains("Woman"), F.lit("Non-binary"))
        .when(g == "Non-binary", F.lit("Non-binary"))
        .when(g == "Man", F.lit("Man"))
        .when(g == "Woman", F.lit("Woman"))
        .otherwise(F.lit(PREFER_NOT))
    )


def account_status(is_active: Column | str) -> Column:
    """'deactivated' only for an explicit false; true and null are 'active'."""
    return F.when(_col(is_active) == F.lit(False), F.lit("deactivated")).otherwise(F.lit("active"))


def age_years(birthday: Column | str, as_of: _dt.date | Column | None = None, mode: str = "as_coded") -> Column:
    """Age on ``as_of`` (default: today in the session time zone).

    ``as_coded`` follows the source rule: year difference minus one when the month of
    ``as_of`` (with its year) is before the birthday's month (with its year), or the same
    month with an earlier day.  For birthdays in earlier years that is the plain
    calendar-year difference.  ``completed`` gives completed years of life.
    """
    b = _col(birthday)
    ref = F.current_date() if as_of is None else (F.lit(as_of) if isinstance(as_of, _dt.date) else as_of)
    years = F.year(ref) - F.year(b)
    if mode == "as_coded":
        rm, bm = F.trunc(ref, "MM"), F.trunc(b, "MM")
        before = (rm < bm) | ((rm == bm) & (F.dayofmonth(ref) < F.dayofmonth(b)))
    elif mode == "completed":
        before = (F.month(ref) < F.month(b)) | ((F.month(ref) == F.month(b)) & (F.dayofmonth(ref) < F.dayofmonth(b)))
    else:
        raise ValueError(f"unknown age mode {mode!r}")
    return F.when(b.isNull(), F.lit(None).cast("long")).otherwise(
        (years - F.when(before, 1).otherwise(0)).cast("long"))
