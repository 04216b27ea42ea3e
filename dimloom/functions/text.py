"""String helpers with the warehouse's whitespace and regex semantics.

Spark's ``trim`` removes only the space character and Java regex classes differ from
RE2's (``\\s`` also matches vertical tab, ``\\b`` is Unicode aware), so the classes are
spelled out explicitly.  The same patterns give the same answers under RE2 (DuckDB).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode White_Space: TAB..CR, NEL and the separator categories (space, line, paragraph).
UNICODE_WS = r"[\t-\r\x{85}\p{Z}]"
TRIM_PATTERN = rf"^{UNICODE_WS}+|{UNICODE_WS}+$"
# RE2 / ASCII ``\s`` and ``\w``.
ASCII_SPACE = r"[\t\n\f\r ]"
ASCII_WORD = r"[0-9A-Za-z_]"

# Fixed patterns of the address heuristic (applied to the lower-cased name).
NUMBER_THEN_WORD = rf"[0-9]{{1,5}}{ASCII_SPACE}+{ASCII_WORD}"
PLUS_CODE_PREFIX = r"^[0-9a-z]{4}\+[0-9a-z]{2,}"
STREET_WORD = rf"(^|[^0-9A-Za-z_])(st|ave|rd|dr|ln)($|[^0-9A-Za-z_])"
COUNTY_WORD = "county"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """Strip leading and trailing Unicode whitespace (not only U+0020)."""
    return F.regexp_replace(_col(c), TRIM_PATTERN, "")


def coalesce_trim(c: Column | str, fallback: Column | str | None) -> Column:
    """``coalesce(trim(value), fallback)``; an empty string stays empty (only null falls back)."""
    fb = F.lit(fallback) if fallback is None or isinstance(fallback, str) else fallback
    return F.coalesce(trim_ws(c), fb)


def normalize_email(c: Column | str) -> Column:
    """Join key for emails: lower case after trimming whitespace."""
    return F.lower(trim_ws(c))


def is_address_like(c: Column | str) -> Column:
    """True when a place name looks like a street address rather than a town.

    Any of: a 1-5 digit number followed by a word, a plus-code prefix, a street word
    (st, ave, rd, dr, ln) standing alone, or the word 'county'.  Null names give null.
    """
    low = F.lower(_col(c))
    return (
        low.rlike(NUMBER_THEN_WORD)
        | low.rlike(PLUS_CODE_PREFIX)
        | low.rlike(STREET_WORD)
        | low.contains(COUNTY_WORD)
    )
