"""A — unify the four routes that link a person to a classroom, site and sponsor.

The classroom -> site -> sponsor -> codes lookup is built once (``classroom_context``)
and shared by the three classroom routes.  Joins whose left key can be hot (many
classrooms per site, many members per classroom, many joins per invite code, many
people per email) go through ``skew_join``.  The unified table makes narrow rows of all routes
distinct together and joins them to the context once, so the wide rows are made after
the duplicates are gone; the single routes (A2 to A5) keep their repeated rows.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_email
from ..sources.schemas import ATTRIBUTION_COLUMNS
from .joins import skew_join
from .topk import order_by, top1

# The type code excluded from the invitation and sponsor-join routes, and
# the join action that counts as joining.
INDEPENDENT_LEARNER = "IL"
JOIN_ACTION = "userjoins"

CONTEXT_COLUMNS = ("sponsor_id", "sponsor_name", "sponsor_code", "classroom_id", "classroom_name",
                   "classroom_code", "site_id", "site_name")

# Deterministic choice among a person's attributions (the source leaves it open):
# the highest sponsor id, then the smallest classroom, site and codes, nulls last.
ATTRIBUTION_ORDER = (
    ("sponsor_id", "desc"),
    ("classroom_id", "asc"),
    ("site_id", "asc"),
    ("sponsor_code", "asc"),
    ("classroom_code", "asc"),
    ("site_name", "asc"),
    ("classroom_name", "asc"),
    ("sponsor_name", "asc"),
)

Tables = Mapping[str, DataFrame]


def _sponsors(T: Tables) -> DataFrame:
    return T["user_sponsor"].select(F.col("id").alias("sponsor_id"), F.col("name").alias("sponsor_name"))


def site_context(T: Tables) -> DataFrame:
    """Site -> sponsor -> every code of that sponsor (keyed by ``ctx_site_key``)."""
    sites = T["user_site"].select(F.col("id").alias("ctx_site_key"), F.col("name").alias("site_name"),
                                  F.col("sponsor_id").alias("site_sponsor_id"))
    codes = T["sponsor_invite_code"].select(F.col("sponsor_id").alias("code_sponsor_id"),
                                            F.col("code").alias("sponsor_code"))
    # a matched sponsor id equals the site's sponsor id, so the site column bounds its counts
    of_sites = (T["user_site"], "sponsor_id")
    with_sponsor = skew_join(sites, _sponsors(T), "site_sponsor_id", "sponsor_id", "left", keys_from=of_sites)
    return (skew_join(with_sponsor, codes, "sponsor_id", "code_sponsor_id", "left", keys_from=of_sites)
            .select("ctx_site_key", "site_name", "sponsor_id", "sponsor_name", "sponsor_code"))


def classroom_context(T: Tables) -> DataFrame:
    """A1: classroom with its site, sponsor, every sponsor code and every classroom code."""
    rooms = T["classroom"].select(F.col("id").alias("classroom_id"), F.col("name").alias("classroom_name"),
                                  "site_id")
    ccodes = T["classroom_invite_code"].select(F.col("classroom_id").alias("cc_classroom_id"),
                                               F.col("code").alias("classroom_code"))
    ctx = skew_join(rooms, site_context(T), "site_id", "ctx_site_key", "left", keys_from=(T["classroom"], "site_id"))
    ctx = skew_join(ctx, ccodes, "classroom_id", "cc_classroom_id", "left", keys_from=(T["classroom"], "id"))
    return ctx.select(*CONTEXT_COLUMNS)


def _membership_route(memberships: DataFrame, context: DataFrame) -> DataFrame:
    m = memberships.select("user_id", F.col("classroom_id").alias("m_classroom_id"))
    return skew_join(m, context, "m_classroom_id", "classroom_id", "left", keys_from=(memberships, "classroom_id")).select(*ATTRIBUTION_COLUMNS)


def route_learner(T: Tables, context: DataFrame | None = None) -> DataFrame:
    """A2: learner memberships; a membership of a missing classroom keeps a row of nulls."""
    ctx = context if context is not None else classroom_context(T)
    return _membership_route(T["learner_classroom_membership"], ctx)


def route_educator(T: Tables, context: DataFrame | None = None) -> DataFrame:
    """A3: educator memberships, same lookups."""
    ctx = context if context is not None else classroom_context(T)
    return _membership_route(T["educator_classroom_membership"], ctx)


def _eligible_people(T: Tables) -> DataFrame:
    # ``type <> 'IL'`` is false for IL and null for a null type: both are excluded.
    return T["user_core"].where(F.col("type") != INDEPENDENT_LEARNER)


def route_invited(T: Tables, context: DataFrame | None = None) -> DataFrame:
    """A4: invitations matched to people by trimmed, lower-cased email; classroom must exist.

    A person with several rows of the same email matches once per row, as in the source;
    the distinct of ``stack_routes`` removes such repeats map-side first.  De-duplicating
    the inputs here would cost a full extra shuffle of them for a usually small saving.
    """
    ctx = context if context is not None else classroom_context(T)
    people = _eligible_people(T).select(normalize_email("email").alias("u_email"), F.col("id").alias("user_id"))
    inv = T["educator_invitation_record"].select(normalize_email("email").alias("i_email"),
                                                 F.col("classroom_id").alias("i_classroom_id"))
    matched = skew_join(inv, people, "i_email", "u_email", "inner", keys_from=(T["educator_invitation_record"], "email_key"))
    # the matched rows follow a shuffle, so their hot classrooms are those of the invitations
    return (skew_join(matched, ctx, "i_classroom_id", "classroom_id", "inner", keys_from=(T["educator_invitation_record"], "classroom_id"))
            .select(*ATTRIBUTION_COLUMNS))


def sponsor_code_context(T: Tables) -> DataFrame:
    """Sponsor invite code with its own sponsor and its own site (keyed by ``code_key``)."""
    codes = T["sponsor_invite_code"].select(F.col("id").alias("code_key"), F.col("code").alias("sponsor_code"),
                                            F.col("sponsor_id").alias("code_sponsor_id"), "site_id")
    sites = T["user_site"].select(F.col("id").alias("s_site_key"), F.col("name").alias("site_name"))
    with_sponsor = skew_join(codes, _sponsors(T), "code_sponsor_id", "sponsor_id", "left", keys_from=(T["sponsor_invite_code"], "sponsor_id"))
    return (skew_join(with_sponsor, sites, "site_id", "s_site_key", "left", keys_from=(T["sponsor_invite_code"], "site_id"))
            .select("code_key", "sponsor_id", "sponsor_name", "sponsor_code", "site_id", "site_name"))


def route_sponsor_join(T: Tables) -> DataFrame:
    """A5: 'userjoins' records of eligible people with an existing sponsor code; the site
    is the code's own and the classroom columns are null."""
    joins = (T["user_join_record"].where(F.col("action_type") == JOIN_ACTION)
             .select(F.col("user_id").alias("jr_user_id"), F.col("sponsor_invite_code_id").alias("jr_code_id")))
    people = _eligible_people(T).select(F.col("id").alias("user_id"))
    matched = skew_join(joins, people, "jr_user_id", "user_id", "inner", keys_from=(T["user_join_record"], "user_id"))
    out = skew_join(matched, sponsor_code_context(T), "jr_code_id", "code_key", "inner",
                    keys_from=(T["user_join_record"], "sponsor_invite_code_id"))
    none = F.lit(None).cast("string")
    return out.select("user_id", "sponsor_id", "sponsor_name", "sponsor_code",
                      none.alias("classroom_id"), none.alias("classroom_name"), none.alias("classroom_code"),
                      "site_id", "site_name")


def stack_routes(learner: DataFrame, educator: DataFrame, invited: DataFrame, sponsor_join: DataFrame) -> DataFrame:
    """A6: distinct educator rows, then distinct learner rows (a row in both stays twice)."""
    educators = educator.where(F.col("user_id").isNotNull()).distinct()
    learners = (learner.unionByName(invited).unionByName(sponsor_join)
                .where(F.col("user_id").isNotNull()).distinct())
    return educators.unionByName(learners).select(*ATTRIBUTION_COLUMNS)


def user_attributions_literal(T: Tables) -> DataFrame:
    """A7 in the literal form: the routes in full, then distinct (test oracle)."""
    ctx = classroom_context(T)
    return stack_routes(route_learner(T, ctx), route_educator(T, ctx), route_invited(T, ctx),
                        route_sponsor_join(T))


def _invited_pairs(T: Tables) -> DataFrame:
    """(user_id, classroom_id) of the invitations that reach a person."""
    people = _eligible_people(T).select(normalize_email("email").alias("u_email"), F.col("id").alias("user_id"))
    inv = T["educator_invitation_record"].select(normalize_email("email").alias("i_email"), "classroom_id")
    return skew_join(inv, people, "i_email", "u_email", "inner",
                     keys_from=(T["educator_invitation_record"], "email_key")).select("user_id", "classroom_id")


#: What a sponsor code knows by itself; a classroom's context knows these too.
OWN = ("sponsor_id", "sponsor_name", "sponsor_code", "site_id", "site_name")


def _room_keys(T: Tables) -> list[tuple[DataFrame, str]]:
    return [(T[t], "classroom_id") for t in ("learner_classroom_membership", "educator_classroom_membership", "educator_invitation_record")]


def _placed(T: Tables, rooms: DataFrame) -> DataFrame:
    """Memberships and invitations of people (route, user_id) with the columns of ``rooms``, whose key is
    ``room``; a membership of a missing classroom keeps nulls, an invitation to one goes."""
    members = T["educator_classroom_membership"].select("user_id", "classroom_id", F.lit("educator").alias("route"), F.lit(True).alias("keep"))
    for pairs, keep in ((T["learner_classroom_membership"], True), (_invited_pairs(T), False)):
        members = members.unionByName(pairs.select("user_id", "classroom_id", F.lit("learner").alias("route"), F.lit(keep).alias("keep")))
    found = skew_join(members.where(F.col("user_id").isNotNull()), rooms, "classroom_id", "room", "left", keys_from=_room_keys(T))
    return found.where("keep OR room IS NOT NULL").drop("keep", "classroom_id")


def _joined(T: Tables) -> DataFrame:
    """Sponsor joins of people: user_id and what the code knows, as ``own_`` columns."""
    return route_sponsor_join(T).where(F.col("user_id").isNotNull()).select("user_id", *[F.col(c).alias(f"own_{c}") for c in OWN])


def _with_context(narrow: DataFrame, context: DataFrame, T: Tables) -> DataFrame:
    """Narrow rows (user_id, room, ``own_`` columns) as attribution rows."""
    # rows without a classroom match nothing; a key of their own keeps them from meeting in one task
    spread = F.concat(F.lit("no classroom "), F.pmod(F.monotonically_increasing_id(), F.lit(4096)))
    keyed = narrow.withColumn("room_key", F.coalesce("room", spread))
    wide = skew_join(keyed, context, "room_key", "classroom_id", "left", keys_from=_room_keys(T), also=F.col("room").isNotNull())
    # a row with a classroom has nothing of its own, a row without one nothing of the context
    return wide.select("user_id", *[F.coalesce(f"own_{c}", c).alias(c) if c in OWN else F.col(c) for c in ATTRIBUTION_COLUMNS if c != "user_id"]).select(
        *ATTRIBUTION_COLUMNS)


def attribution_keys(T: Tables) -> DataFrame:
    """The narrow rows of all routes, distinct within the educator rows and within the learner rows: a person, the
    classroom if it exists, for sponsor joins the site and sponsor of the code, and which of the two sets they belong to."""
    rooms = T["classroom"].select(F.col("id").alias("room")).where("room IS NOT NULL").distinct()
    placed = _placed(T, rooms).select("route", "user_id", "room", *[F.lit(None).cast("string").alias(f"own_{c}") for c in OWN])
    joined = _joined(T).select(F.lit("learner").alias("route"), "user_id", F.lit(None).cast("string").alias("room"), *[f"own_{c}" for c in OWN])
    return placed.unionByName(joined).distinct()


def stored_attribution_keys(T: Tables, folder: str) -> DataFrame:
    """``attribution_keys`` written as Parquet to ``folder`` and read back."""
    keys = attribution_keys(T)
    keys.write.parquet(folder)
    return keys.sparkSession.read.schema(keys.schema).parquet(folder)


def most_rows_of_a_key(T: Tables) -> int:
    """The most rows of ``user_attributions`` that one of ``attribution_keys`` gives."""
    rows = classroom_context(T).distinct().where("classroom_id IS NOT NULL").groupBy("classroom_id").count()
    return max(1, rows.agg(F.max("count")).first()[0] or 1)


def user_attributions(T: Tables, keys: DataFrame | None = None) -> DataFrame:
    """A7: every attribution row of every person (many rows per person), distinct within the
    educator rows and within the learner rows (learner, invited and sponsor join).

    One pass over all routes.  Their narrow rows (``attribution_keys``, or stored ones given as ``keys``) meet
    in one union.  One aggregate makes them distinct, so that a person's rows without a classroom collapse
    to one, also with a sponsor join that knows nothing more.  Then the distinct context is joined once.
    """
    return _with_context(attribution_keys(T) if keys is None else keys, classroom_context(T).distinct(), T)


def first_context(T: Tables) -> DataFrame:
    """The first row of each classroom's context under ATTRIBUTION_ORDER (nulls last).

    Sponsor and site come before the codes in the order, and the two codes are free of each other,
    so only the smallest code of a sponsor and of a classroom can be in the first row.
    """
    least = ChainMap({
        "sponsor_invite_code": T["sponsor_invite_code"].groupBy("sponsor_id").agg(F.min("code").alias("code")),
        "classroom_invite_code": T["classroom_invite_code"].groupBy("classroom_id").agg(F.min("code").alias("code"))}, T)
    return top1(classroom_context(least), ["classroom_id"], order_by(ATTRIBUTION_ORDER))


def first_sponsor(T: Tables) -> DataFrame:
    """(room, first_sponsor): the sponsor in the first row of each classroom's context, the highest one."""
    known = T["user_sponsor"].select(F.col("id").alias("sponsor_key")).distinct()
    sites = T["user_site"].select(F.col("id").alias("s_site_key"), F.col("sponsor_id").alias("site_sponsor_id"))
    of_sites = (skew_join(sites, known, "site_sponsor_id", "sponsor_key", "left", keys_from=(T["user_site"], "sponsor_id"))
                .groupBy("s_site_key").agg(F.max("sponsor_key").alias("sponsor_key")))
    rooms = T["classroom"].select(F.col("id").alias("room"), "site_id").where("room IS NOT NULL")
    return (skew_join(rooms, of_sites, "site_id", "s_site_key", "left", keys_from=(T["classroom"], "site_id"))
            .groupBy("room").agg(F.max("sponsor_key").alias("first_sponsor")))


def best_attribution(T: Tables) -> DataFrame:
    """One attribution per person: the first of ``user_attributions`` under ATTRIBUTION_ORDER.

    The first row of a person is chosen among narrow candidates: the sponsor in the first row of the
    classroom's context and the classroom decide between classrooms, whose rows are otherwise the same,
    and what the code knows between sponsor joins.  Only the chosen rows meet the wide context, one a
    person, and of that only the first row of each classroom.
    """
    none = [F.lit(None).cast("string").alias(f"own_{c}") for c in OWN]
    placed = _placed(T, first_sponsor(T)).select("user_id", "room", "first_sponsor", *none)
    joined = _joined(T).withColumn("room", F.lit(None).cast("string")).withColumn("first_sponsor", F.col("own_sponsor_id"))
    order = [("first_sponsor", "desc"), ("room", "asc"), ("own_site_id", "asc"), ("own_sponsor_code", "asc"), ("own_site_name", "asc"), ("own_sponsor_name", "asc")]
    chosen = top1(placed.unionByName(joined), ["user_id"], order_by(order)).drop("first_sponsor")
    return _with_context(chosen, first_context(T), T)


def first_attribution(attributions: DataFrame) -> DataFrame:
    """One row per person from an attributions table (e.g. a stored ``user_attributions``)."""
    return top1(attributions.where(F.col("user_id").isNotNull()), ["user_id"], order_by(ATTRIBUTION_ORDER))
