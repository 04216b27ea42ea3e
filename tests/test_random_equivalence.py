"""Seeded random inputs: the restructured plans equal the literal forms of the models."""

import datetime as dt
import random

import pytest
from helpers import srt

from dimloom.operators import locations as L
from dimloom.operators import users as U
from dimloom.sources import from_rows

AS_OF = dt.date(2026, 3, 10)
NAMES = ["Alpha", "Beta", "Gamma", None, "12 Elm", "Seoul", "Lake County", "St. Louis", "Hill"]


def random_places(rng: random.Random, n: int = 40):
    core, comps, types = [], [], []
    for i in range(n):
        lat = None if rng.random() < 0.1 else 40 + rng.random() * 0.6
        core.append((f"p{i:02d}", rng.choice(NAMES), rng.choice(["Land", "Alpha", None]), lat,
                     -100 + rng.random() * 0.6, f"p{i}"))
        for t in rng.sample([1, 2, 3, 4, 7, 8], rng.choice([0, 1, 1, 1, 2])):
            types.append((f"p{i:02d}", t))
    for i in range(n):
        for j in rng.sample(range(n), rng.choice([0, 1, 2, 3, 4])):
            if i != j:
                comps.append((f"p{i:02d}", f"p{j:02d}"))
    return {"location_core": core, "location_address_components": comps, "location_type": types}


def random_people(rng: random.Random, n: int = 30):
    users, learners = [], []
    for i in range(n):
        for _ in range(rng.choice([1, 1, 2, 3])):
            joined = rng.choice([None, dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)])
            users.append((f"u{i}", f"uuid{rng.randint(0, 2)}", rng.choice(["A", "B", None]), "L",
                          rng.choice([None, f"a{i}@x", f"b{i}@x"]), rng.choice(["E", "CL", "IL", None]),
                          None, None, None, joined, rng.choice([True, False, None]), False,
                          rng.choice([None, dt.date(1990, 5, 1)]), rng.choice([None, "locA", "locB"])))
        for c in rng.sample(["cls101", "cls202", "cls303", "cls404", "none"], rng.choice([0, 1, 2])):
            learners.append((f"u{i}", c))
    return users, learners


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_locations_clean_equals_literal(spark, seed):
    T = from_rows(spark, random_places(random.Random(seed)))
    assert srt(L.locations_clean(T).collect()) == srt(L.locations_clean_literal(T).collect())


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_repeated_place_ids_give_one_row_each(spark, seed):
    """Repeated place rows: the literal form ranks them, the one-pass form must agree."""
    rng = random.Random(seed)
    rows = random_places(rng)
    again = [(i, rng.choice(NAMES), long, None if rng.random() < 0.2 else 40 + rng.random() * 0.6, lon, slug)
             for i, _, long, _, lon, slug in rng.sample(rows["location_core"], 12)]
    typed = {i for i, _ in rows["location_type"]}
    rows["location_core"] = rows["location_core"] + [r for r in again if r[0] not in typed]
    T = from_rows(spark, rows)
    got = L.locations_clean(T).collect()
    assert srt(got) == srt(L.locations_clean_literal(T).collect())
    assert len({r.from_location_id for r in got}) == len(got)


def test_a_repeated_place_does_not_repeat_people(spark):
    from reference_fixture import ROWS

    rows = dict(ROWS)
    rows["location_core"] = ROWS["location_core"] + [ROWS["location_core"][0]]
    T = from_rows(spark, rows)
    assert L.locations_clean(T).count() == 9
    assert U.dim_users(T, AS_OF).count() == 8
    assert srt(U.dim_users(T, AS_OF).collect()) == srt(U.dim_users_literal(T, AS_OF).collect())


@pytest.mark.parametrize("seed", [21, 22])
def test_attributions_equal_literal(spark, seed):
    """Narrow pairs joined to the distinct context give the rows of the full routes made distinct."""
    from reference_fixture import ROWS

    from dimloom.operators import attributions as A

    rng = random.Random(seed)
    users, learners = random_people(rng)
    rows = dict(ROWS)
    rows["user_core"] = users
    rows["learner_classroom_membership"] = learners + rng.sample(learners, min(5, len(learners))) + [("u1", None), (None, "cls101"), ("u1", "gone")]
    rows["educator_classroom_membership"] = [(f"u{rng.randint(0, 9)}", rng.choice(["cls101", "cls202", "gone", None])) for _ in range(20)]
    rows["educator_invitation_record"] = [(rng.choice([" A3@X ", "b4@x", None]), rng.choice(["cls101", "gone"])) for _ in range(10)]
    rows["classroom_invite_code"] = ROWS["classroom_invite_code"] + [("second", "cls101"), ("second", "cls101")]
    rows["sponsor_invite_code"] = ROWS["sponsor_invite_code"] + [("i9", "ZZZ", "spon001", "site2")]
    T = from_rows(spark, rows)
    assert srt(A.user_attributions(T).collect()) == srt(A.user_attributions_literal(T).collect())
    assert srt(A.best_attribution(T).collect()) == srt(A.first_attribution(A.user_attributions_literal(T)).collect())


@pytest.mark.parametrize("seed", [4, 5])
def test_dim_users_equals_literal(spark, seed):
    from reference_fixture import ROWS

    rng = random.Random(seed)
    users, learners = random_people(rng)
    rows = dict(ROWS)
    rows["user_core"] = users
    rows["learner_classroom_membership"] = learners
    rows["sponsor_invite_code"] = ROWS["sponsor_invite_code"] + [("i9", "ZZZ", "spon001", "site2")]
    T = from_rows(spark, rows)
    assert srt(U.dim_users(T, AS_OF).collect()) == srt(U.dim_users_literal(T, AS_OF).collect())
