"""Seeded fuzz: the Java spellings of the RE2 rules agree with RE2 itself (DuckDB).

Random strings mix digits, ASCII and accented letters, every ASCII space character
including vertical tab, Unicode spaces, '+', '.', and fragments of the street words.
"""

import random

import duckdb

from dimloom.functions.text import TRIM_PATTERN, is_address_like, trim_ws

PIECES = ["0", "12", "12345", "123456", "a", "Z", "É", "é", "ß", " ", "\t", "\n", "\x0b", "\x0c", "\r",
          "\u00a0", "\u2003", "\u3000", "\u0085", "+", ".", "st", "St", "ave", "rd", "dr", "ln", "county",
          "COUNTY", "8FVC", "9G", "_", "-", "x"]


def _strings(seed: int, n: int = 400):
    rng = random.Random(seed)
    out = [None, ""]
    for _ in range(n):
        out.append("".join(rng.choice(PIECES) for _ in range(rng.randint(1, 6))))
    return out


def test_address_patterns_match_re2(spark):
    values = _strings(11)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.a for r in df.select("i", is_address_like("s").alias("a")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, s VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    want = dict(con.execute(
        "SELECT i, regexp_matches(lower(s), '\\d{1,5}\\s+\\w+') OR regexp_matches(lower(s), '^[0-9a-z]{4}\\+[0-9a-z]{2,}')"
        " OR regexp_matches(lower(s), '\\bst\\b|\\bave\\b|\\brd\\b|\\bdr\\b|\\bln\\b') OR contains(lower(s), 'county')"
        " FROM t").fetchall())
    diff = [(values[i], got[i], want[i]) for i in got if got[i] != want[i]]
    assert not diff, diff[:5]


def test_trim_matches_unicode_white_space(spark):
    values = _strings(12)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", trim_ws("s").alias("t")).collect()}
    # Python's str.strip() removes exactly the Unicode White_Space characters used here
    want = {i: (None if v is None else v.strip(" \t\n\x0b\x0c\r\x85\xa0\u2003\u3000")) for i, v in enumerate(values)}
    assert got == want
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, s VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    duck = dict(con.execute(f"SELECT i, regexp_replace(s, '{TRIM_PATTERN}', '', 'g') FROM t").fetchall())
    assert duck == want
