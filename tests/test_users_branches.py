"""Profile-field rules and the one-row-per-person choice (FIXTURES.md §4, D2-D10)."""

import datetime as dt

import pytest
from helpers import with_rows
from pyspark.sql import functions as F

from dimloom.functions import (
    account_status,
    age_years,
    coalesce_trim,
    gender_category,
    is_test_user,
    race_category,
    trim_ws,
    user_type_name,
)
from dimloom.operators import users as U

AS_OF = dt.date(2026, 3, 10)


def _one(spark, schema, row, expr):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).collect()[0].v


@pytest.mark.parametrize("first,last,email,expected", [
    ("Te St", None, None, True), (None, None, None, False), ("A", "B", "educatorst1@example.com", True),
    ("A", "B", "a@example.com", False), ("A", "pro\ttest", None, True), ("A", "B", "TEST@x.com", True),
])
def test_is_test_user(spark, first, last, email, expected):
    assert _one(spark, "f string, l string, e string", (first, last, email), is_test_user("f", "l", "e")) is expected


@pytest.mark.parametrize("value,expected", [
    ("South Asian,East Asian", "Asian"), ("Asian", "Other"), ("", "Other"), ("PREFER NOT TO SAY,White", "Prefer Not To Say"),
    (None, "Prefer Not To Say"), ("Hispanic", "Other"), ("Hispanic or Latinx", "Hispanic"), ("White", "White"),
    ("Black or African American,Other", "Multiracial"), ("Native Hawaiian or other Pacific Islander", "Native Hawaiian or other Pacific Islander"),
    ("East Asian,Native American or Alaska Native", "Multiracial"), ("Other", "Other"),
])
def test_race_category(spark, value, expected):
    assert _one(spark, "r string", (value,), race_category("r")) == expected


@pytest.mark.parametrize("value,expected", [
    ("Man,Woman", "Non-binary"), ("Man,Non-binary", "Prefer Not To Say"), (None, "Prefer Not To Say"),
    ("Prefer not to say", "Prefer Not To Say"), ("Woman,Prefer to self-describe", "Non-binary"), ("Woman", "Woman"),
    ("Man", "Man"), ("Non-binary", "Non-binary"),
])
def test_gender_category(spark, value, expected):
    assert _one(spark, "g string", (value,), gender_category("g")) == expected


def test_user_type_and_status(spark):
    assert _one(spark, "t string", ("IL",), user_type_name("t")) == "Independent Learner"
    assert _one(spark, "t string", ("X",), user_type_name("t")) is None
    assert _one(spark, "a boolean", (None,), account_status("a")) == "active"
    assert _one(spark, "a boolean", (False,), account_status("a")) == "deactivated"


@pytest.mark.parametrize("birthday,as_coded,completed", [
    (None, None, None),
    (dt.date(2026, 3, 11), -1, -1),
    (dt.date(2026, 3, 10), 0, 0),
    (dt.date(2025, 5, 1), 1, 0),
    (dt.date(1995, 5, 20), 31, 30),
    (dt.date(1990, 1, 1), 36, 36),
])
def test_age_rules(spark, birthday, as_coded, completed):
    assert _one(spark, "b date", (birthday,), age_years("b", AS_OF)) == as_coded
    assert _one(spark, "b date", (birthday,), age_years("b", AS_OF, "completed")) == completed


def test_trim_and_coalesce_trim(spark):
    assert _one(spark, "s string", ("\t  a b \n　",), trim_ws("s")) == "a b"
    assert _one(spark, "s string", (None,), coalesce_trim("s", "fallback")) == "fallback"
    assert _one(spark, "s string", ("   ",), coalesce_trim("s", "fallback")) == ""


def _u(uid, uuid, email, joined, active, first="F"):
    return (uid, uuid, first, "L", email, "CL", None, None, None, joined, active, False, None, None)


def test_dedupe_prefers_latest_then_active_then_email(spark):
    t = dt.datetime(2024, 1, 1)
    users = [
        _u("a", "1", "a1@x", t, False), _u("a", "2", "a2@x", t, True),          # active wins
        _u("b", "1", "b1@x", t, True), _u("b", "2", "b2@x", t, True),           # later email wins
        _u("c", "1", None, t, True), _u("c", "2", "c@x", t, True),              # null email last
        _u("d", "1", "d@x", t, True), _u("d", "2", "d@x", dt.datetime(2025, 1, 1), True),  # latest join
        _u("e", "1", "e@x", None, True), _u("e", "2", "e@x", t, False),         # null join date last
    ]
    T = with_rows(spark, user_core=users, learner_classroom_membership=[], educator_classroom_membership=[],
                  educator_invitation_record=[], user_join_record=[])
    got = {r.user_id: r.uuid for r in U.dim_users(T, AS_OF).collect()}
    assert got == {"a": "2", "b": "2", "c": "2", "d": "2", "e": "2"}
    lit = {r.user_id: r.uuid for r in U.dim_users_literal(T, AS_OF).collect()}
    assert lit == got


def test_independent_learner_sponsor_name_masked(spark, tables):
    rows = {r.user_id: r for r in U.dim_users(tables, AS_OF).collect()}
    assert rows["u001"].user_type == "IL" and rows["u001"].sponsor_id == "spon001" and rows["u001"].sponsor_name is None
