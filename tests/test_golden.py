"""The source project's sample rows against the goldens traced in FIXTURES.md §2."""

from helpers import srt
from reference_fixture import AS_OF

from dimloom.operators import attributions as A
from dimloom.operators import locations as L
from dimloom.operators import users as U
from dimloom.sources.schemas import ATTRIBUTION_COLUMNS, DIM_USERS_COLUMNS, LOCATIONS_CLEAN_COLUMNS

USA = "United States of America"
GBR = "United Kingdom of Great Britain and Northern Ireland"

LOCATIONS = {
    "locA": ("New York", "New York", "New York County", "New York", USA),
    "locB": ("London", "London", None, None, GBR),
    "locC": ("San Francisco", "San Francisco", "San Francisco County", "California", USA),
    "county-ny": ("New York County", None, "New York County", "New York", USA),
    "county-sf": ("San Francisco County", None, "San Francisco County", "California", USA),
    "state-ny": ("New York", None, None, "New York", USA),
    "state-ca": ("California", None, None, "California", USA),
    "country-usa": ("USA", None, None, None, USA),
    "country-gbr": ("United Kingdom", None, None, None, GBR),
}


def test_locations_golden(spark, tables):
    df = L.locations_clean(tables)
    assert tuple(df.columns) == LOCATIONS_CLEAN_COLUMNS
    rows = {r.from_location_id: r for r in df.collect()}
    assert set(rows) == set(LOCATIONS)
    core = {r[0]: (r[3], r[4]) for r in tables["location_core"].collect()}
    for k, (orig, city, county, state, country) in LOCATIONS.items():
        r = rows[k]
        assert (r.original_locale, r.city, r.county, r.state, r.country) == (orig, city, county, state, country), k
        assert (r.city_latitude, r.city_longitude) == core[k], k


def test_locations_literal_form_agrees(spark, tables):
    a = srt(L.locations_clean(tables).collect())
    b = srt(L.locations_clean_literal(tables).collect())
    assert a == b


def test_attributions_golden(spark, tables):
    df = A.user_attributions(tables)
    assert tuple(df.columns) == ATTRIBUTION_COLUMNS
    got = srt((r.user_id, r.sponsor_id, r.sponsor_code, r.classroom_id, r.classroom_code, r.site_id)
              for r in df.collect())
    want = srt([
        ("u001", "spon001", "ABC123", "cls101", "INV-ABC123", "site1"),
        ("u001", "spon001", "ABC123", "cls303", "INV-EDU456", "site1"),
        ("u002", "spon002", "XYZ789", "cls202", "INV-XYZ789", "site2"),
        ("u004", "spon001", "ABC123", "cls101", "INV-ABC123", "site1"),
        ("u003", "spon003", "EDU456", "cls404", "INV-TEACH001", "site3"),
        ("u003", "spon001", "ABC123", "cls101", "INV-ABC123", "site1"),
        ("u003", "spon003", "EDU456", None, None, "site3"),
    ])
    assert got == want


def test_dim_users_golden(spark, tables):
    df = U.dim_users(tables, AS_OF)
    assert tuple(df.columns) == DIM_USERS_COLUMNS
    rows = {r.user_id: r for r in df.collect()}
    want = {
        "u001": ("alice2@example.com", "White", "Woman", False, "active", None, "spon001", None, "cls101", 31),
        "u002": ("bob@example.com", "Other", "Man", False, "active", "London", "spon002", "Tech Learning Partners", "cls202", 26),
        "u003": ("charlie@example.com", "Other", "Non-binary", False, "active", "San Francisco", "spon003", "Community Scholars Network", "cls404", 38),
        "u005": ("elena.updated@example.com", "Multiracial", "Prefer Not To Say", False, "active", "New York", None, None, None, 28),
        "u006": ("marcus.w@example.com", "Multiracial", "Non-binary", False, "active", "San Francisco", None, None, None, 24),
        "u007": ("sofia.r@example.com", "Hispanic", "Woman", False, "active", "London", None, None, None, 41),
        "u008": ("testuser123@example.com", "White", "Man", True, "deactivated", None, None, None, None, 36),
        "u009": ("jordan.t@example.com", "Prefer Not To Say", "Non-binary", False, "deactivated", "New York", None, None, None, 29),
    }
    assert set(rows) == set(want)
    for uid, w in want.items():
        r = rows[uid]
        got = (r.email, r.race, r.gender_sum, r.is_test_user, r.account_status, r.city, r.sponsor_id,
               r.sponsor_name, r.classroom_id, r.age)
        assert got == w, uid
        assert r.rn == 1


def test_dim_users_literal_form_agrees(spark, tables):
    a = srt(U.dim_users(tables, AS_OF).collect())
    b = srt(U.dim_users_literal(tables, AS_OF).collect())
    assert a == b


def test_completed_age_mode(spark, tables):
    ages = {r.user_id: r.age for r in U.user_profile(tables, AS_OF, age_mode="completed").collect()}
    assert ages["u001"] == 30 and ages["u008"] == 36 and ages["u002"] == 25
