"""L — resolve every place to one city, county, state and country.

Plan shape at scale:

* ``location_components`` joins each (place, ancestor) edge to the typed ancestor.  A few
  ancestors (countries, states) are shared by a large share of all places, so this join
  goes through ``skew_join``.
* everything after it is keyed by ``from_location_id``: one aggregate over the components,
  joined once to the place's own coordinates, tells ambiguity, picks the nearest city and the
  four best parents (``place_summary``), so the edges are read and joined once.
* the type fan-out and score/rank of the source model are replaced by one boolean per
  place ("all of its type rows are countries"), which gives the same rows (proof in the
  tests: ``flat_locations`` / ``scored_locations`` keep the literal form).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_miles
from ..functions.text import is_address_like
from ..sources.schemas import LOCATIONS_CLEAN_COLUMNS
from .joins import skew_join
from .topk import min_struct, top1

# Location type ids and the distance rule.
COUNTRY, STATE, COUNTY = 1, 7, 8
CITY_TYPES = (3, 4)
RESOLVED_TYPES = (1, 3, 4, 7, 8)
NEAR_MILES = 10.0
# Place names that are a city although no city ancestor is recorded.
CITY_STATES = ("Seoul",)

COMPONENT_COLUMNS = ("from_location_id", "to_location_id", "display_name", "long_name",
                     "latitude", "longitude", "locationtype_id")
PLACE_FIELDS = ("to_location_id", "display_name", "long_name", "latitude", "longitude")
LEVELS = {"country": (COUNTRY,), "state": (STATE,), "county": (COUNTY,), "city": CITY_TYPES}

Tables = Mapping[str, DataFrame]


def typed_places(T: Tables) -> DataFrame:
    """Places with each of their resolvable types (one row per place and type)."""
    core = T["location_core"].select(
        F.col("id").alias("t_id"), "display_name", "long_name", "latitude", "longitude")
    types = (T["location_type"].where(F.col("locationtype_id").isin(*RESOLVED_TYPES))
             .select(F.col("location_id").alias("t_location_id"), "locationtype_id"))
    return core.join(types, F.col("t_id") == F.col("t_location_id")).drop("t_location_id")


def location_components(T: Tables) -> DataFrame:
    """L1: every place's typed ancestors, plus the place itself."""
    typed = typed_places(T)
    edges = T["location_address_components"].select("from_location_id", "to_location_id")
    ancestors = skew_join(edges, typed, "to_location_id", "t_id", "inner",
                          keys_from=(T["location_address_components"], "to_location_id")).select(*COMPONENT_COLUMNS)
    itself = typed.select(F.col("t_id").alias("from_location_id"), F.col("t_id").alias("to_location_id"),
                          *COMPONENT_COLUMNS[2:])
    return ancestors.unionByName(itself)


def ambiguous_locations(components: DataFrame) -> DataFrame:
    """L2: places with more than one distinct non-null city name among their other cities.

    ``count(distinct)`` is planned as hash aggregates on (place, name) that drop repeated
    pairs on the map side before the shuffle; string min/max would need a sort-based
    aggregate instead.
    """
    return (
        components.where(F.col("locationtype_id").isin(*CITY_TYPES)
                         & (F.col("from_location_id") != F.col("to_location_id")))
        .groupBy("from_location_id")
        .agg(F.count_distinct("display_name").alias("n_names"))
        .where(F.col("n_names") > 1)
        .select("from_location_id")
    )


def city_candidates(T: Tables, components: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """L3: every city (including the place itself) of an ambiguous place, with its distance."""
    origin = (
        T["location_core"]
        .where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .select(F.col("id").alias("o_id"), F.col("display_name").alias("original_locale"),
                F.col("latitude").alias("og_latitude"), F.col("longitude").alias("og_longitude"))
    )
    places = ambiguous.join(origin, F.col("from_location_id") == F.col("o_id")).drop("o_id")
    cities = (
        components.where(F.col("locationtype_id").isin(*CITY_TYPES)
                         & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        .select(F.col("from_location_id").alias("c_from"), "to_location_id",
                F.col("display_name").alias("city"), F.col("latitude").alias("city_latitude"),
                F.col("longitude").alias("city_longitude"))
    )
    return (
        places.join(cities, F.col("from_location_id") == F.col("c_from"))
        .select(
            "from_location_id", "to_location_id", "city", "city_latitude", "city_longitude",
            "original_locale", "og_latitude", "og_longitude",
            haversine_miles(F.col("city_latitude"), F.col("city_longitude"),
                            F.col("og_latitude"), F.col("og_longitude")).alias("distance_from_origin"),
        )
    )


def nearest_city(candidates: DataFrame) -> DataFrame:
    """L4: the closest candidate per place; equal distances go to the smaller city id, then (for
    place ids with several rows) to the smallest own and city columns, nulls last."""
    order = ("distance_from_origin", "to_location_id", "original_locale", "og_latitude", "og_longitude",
             "city", "city_latitude", "city_longitude")
    return top1(candidates, ["from_location_id"], [F.col(c).asc_nulls_last() for c in order])


def city_override(nearest: DataFrame, near_miles: float = NEAR_MILES) -> DataFrame:
    """L6: beyond ``near_miles`` a place keeps its own name (unless it looks like an
    address) and always its own coordinates; otherwise it takes the city's."""
    city, latitude, longitude = _override_columns(near_miles)
    return nearest.select(
        "from_location_id", "to_location_id", "original_locale", "distance_from_origin",
        city.alias("city_replace"), latitude.alias("city_latitude_replace"), longitude.alias("city_longitude_replace"),
        "og_latitude", "og_longitude",
    )


def _override_columns(near_miles: float):
    far = F.col("distance_from_origin") > F.lit(near_miles)
    return (F.when(far & ~is_address_like(F.col("original_locale")), F.col("original_locale")).otherwise(F.col("city")),
            F.when(far, F.col("og_latitude")).otherwise(F.col("city_latitude")),
            F.when(far, F.col("og_longitude")).otherwise(F.col("city_longitude")))


def overrides(T: Tables, components: DataFrame) -> DataFrame:
    """L2 -> L6 in one call."""
    return city_override(nearest_city(city_candidates(T, components, ambiguous_locations(components))))


def best_parents(components: DataFrame, levels: Sequence[str] = tuple(LEVELS)) -> DataFrame:
    """L7: for each place and level, the ancestor with the smallest id (one aggregate).

    Returns ``from_location_id`` and one struct column per level with fields
    ``to_location_id, display_name, long_name, latitude, longitude`` (null if none).
    """
    return components.groupBy("from_location_id").agg(*[
        min_struct(F.col("locationtype_id").isin(*LEVELS[lv]), *PLACE_FIELDS).alias(f"best_{lv}")
        for lv in levels
    ])


def best_parent(components: DataFrame, level: str) -> DataFrame:
    """L7 for one level, flattened: from_location_id plus the chosen ancestor's fields."""
    col = f"best_{level}"
    return (best_parents(components, (level,)).where(F.col(col).isNotNull())
            .select("from_location_id", *[F.col(f"{col}.{f}").alias(f) for f in PLACE_FIELDS]))


def _resolved_columns(country_row):
    """City and state rules given a boolean Column 'this row is a country row'."""
    city = (
        F.when(F.col("city_replace").isNotNull(), F.col("city_replace"))
        .when(country_row, F.lit(None).cast("string"))
        .when(F.col("best_city.display_name").isNotNull(), F.col("best_city.display_name"))
        .when(F.col("display_name").isin(*CITY_STATES), F.col("display_name"))
    )
    state = (
        F.when(country_row, F.lit(None).cast("string"))
        .when(F.col("best_state.display_name") == F.col("best_country.long_name"), F.lit(None).cast("string"))
        .otherwise(F.col("best_state.display_name"))
    )
    return city, state


def place_summary(T: Tables, components: DataFrame) -> DataFrame:
    """L2 to L7 in one aggregate: the four best parents and, for ambiguous places, the override.

    Columns: ``p_from``, ``best_<level>``, ``city_replace``, ``city_latitude_replace``,
    ``city_longitude_replace``.  A place id may have several rows of its own: the nearest
    (own row, city) pair counts.
    """
    own = T["location_core"].select(F.col("id").alias("o_id"), F.col("display_name").alias("original_locale"),
                                    F.col("latitude").alias("og_latitude"), F.col("longitude").alias("og_longitude"))
    each = components.join(own, F.col("from_location_id") == F.col("o_id"), "left")
    is_city = F.col("locationtype_id").isin(*CITY_TYPES)
    located = F.greatest(*[F.col(c).isNull().cast("int") for c in ("latitude", "longitude", "og_latitude", "og_longitude")]) == 0
    miles = haversine_miles(F.col("latitude"), F.col("longitude"), F.col("og_latitude"), F.col("og_longitude"))
    other_name = F.when(is_city & (F.col("from_location_id") != F.col("to_location_id")), F.col("display_name"))
    nearest = F.min(F.when(is_city & located, F.struct(
        miles.isNull().alias("no_distance"), miles.alias("distance_from_origin"), F.col("to_location_id"),
        F.col("original_locale").isNull().alias("no_name"), F.col("original_locale"), F.col("og_latitude"), F.col("og_longitude"),
        F.col("display_name").isNull().alias("no_city"), F.col("display_name").alias("city"),
        F.col("latitude").alias("city_latitude"), F.col("longitude").alias("city_longitude"))))
    grouped = each.groupBy("from_location_id").agg(
        F.min(other_name).alias("least_name"), F.max(other_name).alias("most_name"), nearest.alias("nearest"),
        *[min_struct(F.col("locationtype_id").isin(*LEVELS[lv]), *PLACE_FIELDS).alias(f"best_{lv}") for lv in LEVELS])
    chosen = F.when(F.col("least_name") != F.col("most_name"), F.col("nearest"))
    flat = grouped.withColumn("nearest", chosen).select("from_location_id", *[f"best_{lv}" for lv in LEVELS], "nearest.*")
    city, latitude, longitude = _override_columns(NEAR_MILES)
    return flat.select(F.col("from_location_id").alias("p_from"), *[f"best_{lv}" for lv in LEVELS], city.alias("city_replace"),
                       latitude.alias("city_latitude_replace"), longitude.alias("city_longitude_replace"))


def _core_with_parents(T: Tables, components: DataFrame, core: DataFrame) -> DataFrame:
    return core.join(place_summary(T, components), F.col("id") == F.col("p_from"), "left")


def flat_locations(T: Tables, components: DataFrame | None = None) -> DataFrame:
    """L8, literal form: one row per place and type row (untyped places once)."""
    comps = location_components(T) if components is None else components
    core = T["location_core"].select("id", "display_name", "latitude", "longitude", "slug")
    types = T["location_type"].select(F.col("location_id").alias("lt_id"), "locationtype_id")
    base = _core_with_parents(T, comps, core).join(types, F.col("id") == F.col("lt_id"), "left")
    city, state = _resolved_columns(F.col("locationtype_id") == COUNTRY)
    return base.select(
        F.col("id").alias("from_location_id"),
        F.col("display_name").alias("original_locale"),
        city.alias("city"),
        F.coalesce("city_latitude_replace", "best_city.latitude", "latitude").alias("city_latitude"),
        F.coalesce("city_longitude_replace", "best_city.longitude", "longitude").alias("city_longitude"),
        F.col("best_county.display_name").alias("county"),
        state.alias("state"),
        F.col("best_country.long_name").alias("country"),
        "latitude", "longitude", "slug", "locationtype_id",
    )


def scored_locations(flat: DataFrame) -> DataFrame:
    """L9: rows with own coordinates and the count of their eight filled fields."""
    fields = ("city", "city_latitude", "city_longitude", "county", "state", "country", "latitude", "longitude")
    score = sum((F.col(f).isNotNull().cast("long") for f in fields), F.lit(0).cast("long"))
    return (flat.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
            .withColumn("score", score))


def locations_clean(T: Tables, components: DataFrame | None = None) -> DataFrame:
    """L11: one row per place with coordinates; the output table of the L pipeline.

    Equal to ranking ``scored_locations`` by score and keeping the first row, without
    the type fan-out: a country type row can never score above another row of the same
    place, and rows with equal scores resolve to the same values, so only "are all of
    this place's type rows countries" matters.
    """
    comps = location_components(T) if components is None else components
    core = (T["location_core"].where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
            .select("id", "display_name", "latitude", "longitude"))
    only_country = (
        T["location_type"].groupBy(F.col("location_id").alias("ct_id"))
        .agg(F.min(F.coalesce(F.col("locationtype_id") == COUNTRY, F.lit(False))).alias("only_country"))
    )
    base = _core_with_parents(T, comps, core).join(only_country, F.col("id") == F.col("ct_id"), "left")
    city, state = _resolved_columns(F.coalesce(F.col("only_country"), F.lit(False)))
    out = base.select(
        F.col("id").alias("from_location_id"),
        F.col("display_name").alias("original_locale"),
        city.alias("city"),
        F.col("best_county.display_name").alias("county"),
        state.alias("state"),
        F.col("best_country.long_name").alias("country"),
        F.coalesce("city_latitude_replace", "best_city.latitude", "latitude").alias("city_latitude"),
        F.coalesce("city_longitude_replace", "best_city.longitude", "longitude").alias("city_longitude"),
    )
    # a place id may be repeated: its row with the most filled fields stays (own coordinates and the
    # place's parents are filled alike, so the resolved fields decide)
    filled = sum((F.col(f).isNotNull().cast("int") for f in ("city", "city_latitude", "city_longitude", "state")), F.lit(0))
    ranked = top1(out.withColumn("score", filled), ["from_location_id"], _clean_order())
    return ranked.select(*LOCATIONS_CLEAN_COLUMNS)


def _clean_order():
    """Best score first, then the output columns ascending, nulls last."""
    return [F.col("score").desc(), *[F.col(c).asc_nulls_last() for c in LOCATIONS_CLEAN_COLUMNS[1:]]]


def locations_clean_literal(T: Tables) -> DataFrame:
    """L10 + L11 in the literal form (score, rank, keep the first row); used as a test oracle."""
    scored = scored_locations(flat_locations(T))
    return top1(scored, ["from_location_id"], _clean_order()).select(*LOCATIONS_CLEAN_COLUMNS)
