"""Column helpers: every function here takes and returns ``pyspark.sql.Column``.

They compile to JVM expressions inside whole-stage codegen; none is a Python UDF.
"""

from .geo import EARTH_RADIUS_M, METRES_PER_MILE, haversine_miles
from .profile import (
    account_status,
    age_years,
    gender_category,
    is_test_user,
    race_category,
    user_type_name,
)
from .text import coalesce_trim, is_address_like, normalize_email, trim_ws

__all__ = [
    "EARTH_RADIUS_M", "METRES_PER_MILE", "haversine_miles",
    "account_status", "age_years", "gender_category", "is_test_user", "race_category", "user_type_name",
    "coalesce_trim", "is_address_like", "normalize_email", "trim_ws",
]
