import copy

from reference_fixture import ROWS

from dimloom.sources import from_rows


def with_rows(spark, **overrides):
    """The reference fixture with some tables replaced."""
    rows = copy.deepcopy(ROWS)
    rows.update(overrides)
    return from_rows(spark, rows)


def as_dicts(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def srt(rows):
    """Sort rows (or tuples) that may hold nulls."""
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))
