"""Typed definitions of the 13 source tables and the column order of the outputs.

All columns are nullable and no key is declared, as in the source DDL.  Every field
carries a short description in ``metadata["comment"]``; sinks persist it and the table
profile reports it.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": comment})


S, B, L, D, TS, DT = T.StringType(), T.BooleanType(), T.LongType(), T.DoubleType(), T.TimestampType(), T.DateType()

SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "user_core": T.StructType([
        _f("id", S, "person id"),
        _f("uuid", S, "record uuid from the source system"),
        _f("first_name", S, "given name"),
        _f("last_name", S, "family name"),
        _f("email", S, "registered email"),
        _f("type", S, "user type code: E, CL, IL or null"),
        _f("race_ethnicity", S, "comma separated race / ethnicity selections"),
        _f("gender", S, "comma separated gender selections"),
        _f("self_describe_gender", S, "free-text gender"),
        _f("date_joined", TS, "account creation time (UTC)"),
        _f("is_active", B, "account active flag"),
        _f("is_staff", B, "staff flag"),
        _f("birthday", DT, "date of birth"),
        _f("location_id", S, "place id of the person"),
    ]),
    "user_join_record": T.StructType([
        _f("user_id", S, "person id"),
        _f("action_type", S, "join action, e.g. userjoins"),
        _f("sponsor_invite_code_id", S, "sponsor invite code id used"),
    ]),
    "user_site": T.StructType([
        _f("id", S, "site id"),
        _f("name", S, "site name"),
        _f("sponsor_id", S, "sponsor owning the site"),
    ]),
    "user_sponsor": T.StructType([
        _f("id", S, "sponsor id"),
        _f("name", S, "sponsor name"),
    ]),
    "classroom": T.StructType([
        _f("id", S, "classroom id"),
        _f("name", S, "classroom name"),
        _f("site_id", S, "site hosting the classroom"),
    ]),
    "classroom_invite_code": T.StructType([
        _f("code", S, "classroom invite code"),
        _f("classroom_id", S, "classroom the code opens"),
    ]),
    "educator_classroom_membership": T.StructType([
        _f("user_id", S, "educator person id"),
        _f("classroom_id", S, "classroom id"),
    ]),
    "educator_invitation_record": T.StructType([
        _f("email", S, "invited email as typed"),
        _f("classroom_id", S, "classroom the invitation is for"),
    ]),
    "learner_classroom_membership": T.StructType([
        _f("user_id", S, "learner person id"),
        _f("classroom_id", S, "classroom id"),
    ]),
    "location_core": T.StructType([
        _f("id", S, "place id"),
        _f("display_name", S, "short place name"),
        _f("long_name", S, "full place name"),
        _f("latitude", D, "latitude in degrees"),
        _f("longitude", D, "longitude in degrees"),
        _f("slug", S, "url slug"),
    ]),
    "location_address_components": T.StructType([
        _f("from_location_id", S, "place (child)"),
        _f("to_location_id", S, "ancestor place (parent)"),
    ]),
    "location_type": T.StructType([
        _f("location_id", S, "place id"),
        _f("locationtype_id", L, "1 country, 3/4 city, 7 state, 8 county"),
    ]),
    "sponsor_invite_code": T.StructType([
        _f("id", S, "sponsor invite code id"),
        _f("code", S, "code text"),
        _f("sponsor_id", S, "sponsor of the code"),
        _f("site_id", S, "site of the code"),
    ]),
}

SOURCE_NAMES: tuple[str, ...] = tuple(SOURCE_SCHEMAS)

# Output column order of the three built tables.
LOCATIONS_CLEAN_COLUMNS = (
    "from_location_id", "original_locale", "city", "county", "state", "country",
    "city_latitude", "city_longitude",
)
ATTRIBUTION_COLUMNS = (
    "user_id", "sponsor_id", "sponsor_name", "sponsor_code", "classroom_id",
    "classroom_name", "classroom_code", "site_id", "site_name",
)
USER_PROFILE_COLUMNS = (
    "user_id", "uuid", "first_name", "last_name", "email", "user_type", "user_type_name",
    "is_test_user", "race_ethnicity", "race", "gender", "self_describe_gender", "gender_sum",
    "date_joined", "is_active", "account_status", "is_staff", "age", "location_id",
)
ENRICHED_COLUMNS = USER_PROFILE_COLUMNS + (
    "country", "state", "county", "city", "city_latitude", "city_longitude",
    "sponsor_id", "sponsor_name", "sponsor_code", "classroom_id", "classroom_name",
    "classroom_code", "site_id", "site_name",
)
DIM_USERS_COLUMNS = ENRICHED_COLUMNS + ("rn",)

OUTPUT_COMMENTS = {
    "from_location_id": "place id, one row per place with coordinates",
    "original_locale": "place display name before resolution",
    "city": "resolved city (nearest city or own name)",
    "county": "resolved county",
    "state": "resolved state, null when it only repeats the country",
    "country": "resolved country",
    "city_latitude": "latitude of the resolved city",
    "city_longitude": "longitude of the resolved city",
    "user_id": "person id",
    "sponsor_id": "sponsor id",
    "sponsor_name": "sponsor name (null for independent learners in dim_users)",
    "sponsor_code": "sponsor invite code",
    "classroom_id": "classroom id",
    "classroom_name": "classroom name",
    "classroom_code": "classroom invite code",
    "site_id": "site id",
    "site_name": "site name",
    "user_type_name": "name of the person's type",
    "is_test_user": "whether name or email mark a test account",
    "race": "race category derived from the survey answers",
    "gender_sum": "gender category derived from the survey answers",
    "account_status": "active or deactivated",
    "age": "age in years on the build's date",
    "rn": "rank of the kept row, always 1",
}

# Names of the column types as the source warehouse reports them.
WAREHOUSE_TYPE_NAMES = {
    T.StringType: "STRING", T.BooleanType: "BOOL", T.LongType: "INT64", T.IntegerType: "INT64",
    T.DoubleType: "FLOAT64", T.TimestampType: "TIMESTAMP", T.DateType: "DATE",
}


def warehouse_type(dtype: T.DataType) -> str:
    return WAREHOUSE_TYPE_NAMES.get(type(dtype), dtype.simpleString().upper())


# Table descriptions persisted by ``sinks.save_table``.
TABLE_COMMENTS = {
    "user_core": "people: profile, demographics, account state and place",
    "user_join_record": "join actions of people with the sponsor invite code used",
    "user_site": "sites and the sponsor that owns each",
    "user_sponsor": "sponsors",
    "classroom": "classrooms and their site",
    "classroom_invite_code": "invite codes of classrooms",
    "educator_classroom_membership": "educators teaching in classrooms",
    "educator_invitation_record": "classroom invitations sent to an email address",
    "learner_classroom_membership": "learners enrolled in classrooms",
    "location_core": "places with names and coordinates",
    "location_address_components": "edges from a place to each of its ancestor places",
    "location_type": "types of places (country, city, state, county, ...)",
    "sponsor_invite_code": "sponsor invite codes with their sponsor and site",
    "locations_clean": "one row per place with coordinates: resolved city, county, state, country",
    "user_attributions": "every route linking a person to a sponsor, site and classroom",
    "dim_users": "one row per person: profile, resolved place and chosen attribution",
}
