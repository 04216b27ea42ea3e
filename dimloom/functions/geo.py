"""Great-circle distance as a Column expression (no geography type needed)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371010.0  # spherical earth used by the warehouse's geography functions
METRES_PER_MILE = 1609.34
DEG_TO_RAD = math.pi / 180.0
# Reports may show distances on a grid of 1e-6 mile (about 1.6 mm): sin/cos/asin of
# different math libraries may differ in the last bit, and snapping to the grid with
# plain IEEE operations makes every engine show the same double.  The operators order and
# compare the raw distance.
RESOLUTION_PER_MILE = 1e6


def on_grid(miles: Column) -> Column:
    """A distance snapped to the reporting grid."""
    return F.floor(miles * F.lit(RESOLUTION_PER_MILE) + F.lit(0.5)).cast("double") / F.lit(RESOLUTION_PER_MILE)


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                    radius_m: float = EARTH_RADIUS_M) -> Column:
    """Distance in miles between two (lat, lon) points in degrees.

    ``2 R asin(min(1, sqrt(h)))`` is used rather than the arccos form, which loses
    precision (and can leave the domain) for nearby points.  Null or out-of-range
    latitude gives null.
    """
    p1 = lat1 * F.lit(DEG_TO_RAD)
    p2 = lat2 * F.lit(DEG_TO_RAD)
    dp = (lat2 - lat1) * F.lit(DEG_TO_RAD)
    dl = (lon2 - lon1) * F.lit(DEG_TO_RAD)
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    metres = F.lit(2 * radius_m) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))
    valid = (F.abs(lat1) <= 90) & (F.abs(lat2) <= 90)
    return F.when(valid, metres / F.lit(METRES_PER_MILE))
