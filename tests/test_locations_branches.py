"""One small table per branch of the location rules (FIXTURES.md §4)."""

import pytest
from pyspark.sql import functions as F

from dimloom.functions.text import is_address_like
from dimloom.operators import locations as L
from dimloom.sources import from_rows

MILE_DEG = 1 / 69.0934  # degrees of latitude per mile on the 6371.01 km sphere


def _place(pid, name, near_miles, far_miles=40.0, lat=40.0, lon=-100.0, city_names=("Alpha", "Beta")):
    """A type-2 place linked to two cities north of it at the given distances."""
    core = [(pid, name, f"{pid} long", lat, lon, pid)]
    comps, types = [], [(pid, 2)]
    for i, (d, cname) in enumerate(zip((near_miles, far_miles), city_names)):
        cid = f"{pid}-c{i}"
        core.append((cid, cname, f"{cname} long", lat + d * MILE_DEG, lon, cid))
        comps.append((pid, cid))
        types.append((cid, 4 if i == 0 else 3))
    return core, comps, types


def _tables(spark, *parts, extra_core=(), extra_comps=(), extra_types=()):
    core, comps, types = list(extra_core), list(extra_comps), list(extra_types)
    for c, k, t in parts:
        core += c
        comps += k
        types += t
    return from_rows(spark, {"location_core": core, "location_address_components": comps, "location_type": types})


def _clean(T):
    return {r.from_location_id: r for r in L.locations_clean(T).collect()}


def test_far_plain_name_keeps_own_name_and_coordinates(spark):
    T = _tables(spark, _place("p", "Hillside", 15.0))
    r = _clean(T)["p"]
    assert r.city == "Hillside"
    assert (r.city_latitude, r.city_longitude) == (40.0, -100.0)


@pytest.mark.parametrize("name", ["12 Elm", "8FVC+9G X", "Oak Ave", "Lake County", "St. Louis"])
def test_far_address_like_takes_city_name_but_own_coordinates(spark, name):
    T = _tables(spark, _place("p", name, 15.0))
    r = _clean(T)["p"]
    assert r.city == "Alpha"
    assert (r.city_latitude, r.city_longitude) == (40.0, -100.0)


def test_the_ten_mile_rule_uses_the_raw_distance(spark):
    """A hair beyond ten miles is far, although a report shows 10.0."""
    T = _tables(spark, _place("p", "Hillside", 1.0))
    d = L.city_candidates(T, L.location_components(T), L.ambiguous_locations(L.location_components(T))).agg(F.min("distance_from_origin")).first()[0]
    T = _tables(spark, _place("p", "Hillside", 10.0000003 / d))
    assert _clean(T)["p"].city == "Hillside"
    T = _tables(spark, _place("p", "Hillside", 9.9999997 / d))
    assert _clean(T)["p"].city == "Alpha"


def test_near_takes_city_name_and_coordinates(spark):
    T = _tables(spark, _place("p", "Hillside", 3.0))
    r = _clean(T)["p"]
    assert r.city == "Alpha"
    assert r.city_latitude == pytest.approx(40.0 + 3.0 * MILE_DEG)


def test_far_null_name_takes_city_name(spark):
    T = _tables(spark, _place("p", None, 15.0))
    r = _clean(T)["p"]
    assert r.city == "Alpha"
    assert r.city_latitude == 40.0


def test_place_that_is_a_city_picks_itself(spark):
    core, comps, types = _place("p", "Selfton", 15.0)
    types = [(pid, 4) if pid == "p" else (pid, t) for pid, t in types]
    T = _tables(spark, (core, comps, types))
    cands = L.nearest_city(L.city_candidates(T, L.location_components(T),
                                             L.ambiguous_locations(L.location_components(T))))
    r = {x.from_location_id: x for x in cands.collect()}["p"]
    assert r.to_location_id == "p" and r.distance_from_origin == 0.0
    assert _clean(T)["p"].city == "Selfton"


def test_same_name_or_null_name_is_not_ambiguous(spark):
    same = _place("p", "Hillside", 15.0, city_names=("Alpha", "Alpha"))
    with_null = _place("q", "Hillside", 15.0, city_names=("Alpha", None))
    T = _tables(spark, same, with_null)
    assert L.ambiguous_locations(L.location_components(T)).count() == 0
    rows = _clean(T)
    # not ambiguous: the smallest city id wins, with its coordinates
    assert rows["p"].city == "Alpha" and rows["p"].city_latitude == pytest.approx(40.0 + 15.0 * MILE_DEG)
    assert rows["q"].city == "Alpha"


def test_parent_levels_and_state_rules(spark):
    core = [
        ("ctry", "Korea", "Korea", 37.0, 127.0, "ctry"),
        ("st", "Korea", "Korea", 37.1, 127.1, "st"),          # state named like the country
        ("seoul", "Seoul", "Seoul", 37.5, 127.0, "seoul"),    # no city ancestor
        ("multi", "Multi", "Multi Land", 10.0, 10.0, "multi"),  # typed country and state
        ("st2", "Region Two", "Region Two", 10.1, 10.1, "st2"),
        ("untyped", "Loose", "Loose", 11.0, 11.0, "untyped"),
        ("nolat", "Nowhere", "Nowhere", None, 11.0, "nolat"),
    ]
    comps = [("seoul", "st"), ("seoul", "ctry"), ("multi", "st2"), ("untyped", "st2"), ("nolat", "st2")]
    types = [("ctry", 1), ("st", 7), ("seoul", 2), ("multi", 1), ("multi", 7), ("st2", 7)]
    T = _tables(spark, extra_core=core, extra_comps=comps, extra_types=types)
    rows = _clean(T)
    assert rows["seoul"].city == "Seoul"
    assert rows["seoul"].state is None and rows["seoul"].country == "Korea"
    # its own type-7 row is its best state and its own type-1 row its country; the
    # type-1 row does not null the state because another type row exists
    assert rows["multi"].state == "Multi" and rows["multi"].country == "Multi Land"
    assert rows["untyped"].state == "Region Two"
    assert "nolat" not in rows
    lit = {r.from_location_id: r for r in L.locations_clean_literal(T).collect()}
    assert {k: tuple(v) for k, v in lit.items()} == {k: tuple(v) for k, v in rows.items()}


def test_best_parent_takes_smallest_id(spark):
    core = [("p", "P", "P", 1.0, 1.0, "p"), ("s2", "B", "B", 1.0, 1.0, "s2"), ("s1", "A", "A", 1.0, 1.0, "s1")]
    T = _tables(spark, extra_core=core, extra_comps=[("p", "s2"), ("p", "s1")],
                extra_types=[("p", 2), ("s1", 7), ("s2", 7)])
    r = L.best_parent(L.location_components(T), "state").where("from_location_id = 'p'").collect()[0]
    assert r.to_location_id == "s1" and r.display_name == "A"


@pytest.mark.parametrize("name,expected", [
    ("Ést", True), ("12\x0bx", False), ("St. Louis", True), ("Main Rd", True), ("Hillside", False),
    ("1234 Elm", True), ("123456x", False), ("8fvc+9g", True), ("Kings County", True), ("Stanton", False),
    (None, None),
])
def test_address_like_patterns(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string").select(is_address_like("n").alias("a"))
    assert df.collect()[0].a is expected
