"""Record parsers over a DataFrame of text lines (column ``value``).

Each parser is a set of Column expressions, so Catalyst sees through it: the
parse is one narrow projection, filters on parsed fields push down to it, and
nothing runs in Python. Every parser returns ``(good, rejected)``; rejected
rows keep the raw ``value`` and a ``reason`` (``header`` or ``bad``). Both come
from one projection: cache the input if you consume both sides.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.fixed_values import (
    ABBREV_LINE, AIRPORT_HEADER, AIRPORT_LINE, CARRIER_HEADER, CARRIER_LINE, DATE_FIELDS,
    FLIGHT_FIELDS, FLIGHT_TAIL_FIELDS, PLANE_FIELDS, TIMES_FIELDS, FLIGHT_HEADER_FIRST_FIELD, FLIGHT_SEPARATOR, GENRE_SEPARATOR, MISSING_INT,
    PAIR_LINE, PLANE_HEADER, PLANE_LINE, PLANE_NO_YEAR, PLANE_TAIL_ONLY, RATING_SEPARATOR,
    VECTOR_SEPARATOR,
)
from tessera.functions.strings import explode_split, java_split, java_trim, to_int


class Parsed(NamedTuple):
    good: DataFrame
    rejected: DataFrame


def _split_result(df: DataFrame, header: Column, ok: Column, cols: list[Column]) -> Parsed:
    tagged = df.select(
        F.col("value"),
        F.when(header, F.lit("header")).when(~ok, F.lit("bad")).alias("reason"),
        *cols)
    good = tagged.where(F.col("reason").isNull()).drop("value", "reason")
    rejected = tagged.where(F.col("reason").isNotNull()).select("value", "reason")
    return Parsed(good, rejected)


def _g(arr: Column, i: int) -> Column:
    """Element i (0-based), null when out of range (``a[i]`` raises under ANSI)."""
    return F.get(arr, i)


def _with_fields(lines: DataFrame, pattern: str) -> DataFrame:
    """Each line with the fields of its trimmed text. They are a row of their own step:
    Catalyst does not copy the split into each field and into the filter."""
    return explode_split(lines, java_trim(F.col("value")), pattern, keep=["value"], alias="_fields", whole=True)


# ---------------------------------------------------------------- flights (SRC-8)


def parse_flights(lines: DataFrame, missing: int | None = MISSING_INT) -> Parsed:
    """29 comma-separated fields -> the flight record (16 columns, two structs).

    Header (first field ``Year``) and lines with fewer than 29 fields are
    rejected; fields after the 29th are ignored; blank/``NA``/bad ints -> ``missing``.
    """
    f = F.col("_fields")

    def i(k):
        return to_int(_g(f, k), missing)

    def s(k):
        return java_trim(_g(f, k))

    cols = [
        F.struct(*[i(k).alias(n) for k, n in enumerate(DATE_FIELDS)]).alias("date"),
        F.struct(*[i(k).alias(n) for n, k in TIMES_FIELDS]).alias("times"),
        s(8).alias("uniqueCarrier"), i(9).alias("flightNum"), s(10).alias("tailNum"),
        s(16).alias("origin"), s(17).alias("dest"), i(18).alias("distance"),
    ]
    for n, k in FLIGHT_TAIL_FIELDS:
        cols.append((s(k) if n == "cancellationCode" else i(k)).alias(n))
    header = _g(f, 0) == F.lit(FLIGHT_HEADER_FIRST_FIELD)
    return _split_result(_with_fields(lines, FLIGHT_SEPARATOR), header, F.size(f) >= FLIGHT_FIELDS, cols)


# ---------------------------------------------------------------- airports (SRC-9)



def parse_airports(lines: DataFrame) -> Parsed:
    v = F.col("value")
    g = [F.regexp_extract(v, AIRPORT_LINE, k) for k in range(1, 8)]
    lat, lng = g[5].try_cast("float"), g[6].try_cast("float")
    cols = [java_trim(g[0]).alias("iata"), java_trim(g[1]).alias("airport"),
            java_trim(g[2]).alias("city"), java_trim(g[3]).alias("state"),
            java_trim(g[4]).alias("country"), lat.alias("latitude"), lng.alias("longitude")]
    ok = v.rlike(AIRPORT_LINE) & lat.isNotNull() & lng.isNotNull()
    return _split_result(lines, v.rlike(AIRPORT_HEADER), ok, cols)


# ---------------------------------------------------------------- carriers (SRC-10)



def parse_carriers(lines: DataFrame) -> Parsed:
    v = F.col("value")
    cols = [java_trim(F.regexp_extract(v, CARRIER_LINE, 1)).alias("code"),
            java_trim(F.regexp_extract(v, CARRIER_LINE, 2)).alias("description")]
    return _split_result(lines, v.rlike(CARRIER_HEADER), v.rlike(CARRIER_LINE), cols)


# ---------------------------------------------------------------- planes (SRC-11)


def parse_planes(lines: DataFrame) -> Parsed:
    v = F.col("value")
    tail_only = v.rlike(PLANE_TAIL_ONLY)
    cols = []
    for k, n in enumerate(PLANE_FIELDS, start=1):
        full = F.regexp_extract(v, PLANE_LINE, k)
        if k == 1:
            cols.append(F.when(tail_only, F.regexp_extract(v, PLANE_TAIL_ONLY, 1))
                        .otherwise(full).alias(n))
        else:
            cols.append(F.when(tail_only, F.lit("")).otherwise(full).alias(n))
    yr = F.regexp_extract(v, PLANE_LINE, 9)
    year = (F.when(tail_only, F.lit(0))
             .when(yr == PLANE_NO_YEAR, F.lit(MISSING_INT))
             .otherwise(to_int(yr)))
    cols.append(year.alias("year"))
    ok = tail_only | v.rlike(PLANE_LINE)
    return _split_result(lines, v.rlike(PLANE_HEADER), ok, cols)


# ---------------------------------------------------------------- abbreviations (SRC-12)



def parse_abbreviations(lines: DataFrame) -> Parsed:
    v = F.col("value")
    cols = [F.regexp_extract(v, ABBREV_LINE, 1).alias("book"),
            F.regexp_extract(v, ABBREV_LINE, 2).alias("bookName")]
    return _split_result(lines, F.lit(False), v.rlike(ABBREV_LINE), cols)


# ---------------------------------------------------------------- (name,text) pairs (SRC-13)



def parse_pairs(lines: DataFrame) -> Parsed:
    """``(name,text)`` lines -> (doc, text); name trimmed, text lowercased."""
    v = F.col("value")
    cols = [java_trim(F.regexp_extract(v, PAIR_LINE, 1)).alias("doc"),
            F.lower(F.regexp_extract(v, PAIR_LINE, 2)).alias("text")]
    return _split_result(lines, F.lit(False), v.rlike(PAIR_LINE), cols)


# ---------------------------------------------------------------- ratings and movies (SRC-14/15)

def parse_ratings(lines: DataFrame) -> Parsed:
    """``user::movie::rating[::ts]`` -> (userId INT, movieId INT, rating DOUBLE)."""
    f = java_split(F.col("value"), RATING_SEPARATOR)
    u, m, r = (_g(f, 0).try_cast("int"), _g(f, 1).try_cast("int"),
               _g(f, 2).try_cast("double"))
    ok = u.isNotNull() & m.isNotNull() & r.isNotNull()
    return _split_result(lines, F.lit(False), ok,
                         [u.alias("userId"), m.alias("movieId"), r.alias("rating")])


def parse_movies(lines: DataFrame) -> Parsed:
    """``id::title::g1|g2`` -> (movieId INT, title STRING, genres ARRAY<STRING>).

    Genres are split on a literal ``|`` (the reference's ``split("|")`` cuts
    them into single characters)."""
    f = java_split(F.col("value"), RATING_SEPARATOR)
    mid = _g(f, 0).try_cast("int")
    ok = (F.size(f) == 3) & mid.isNotNull()
    return _split_result(lines, F.lit(False), ok,
                         [mid.alias("movieId"), _g(f, 1).alias("title"),
                          java_split(_g(f, 2), GENRE_SEPARATOR).alias("genres")])


# ---------------------------------------------------------------- vectors (SRC-16)

def parse_vectors(lines: DataFrame, col: str = "features") -> Parsed:
    """Space-separated doubles -> dense ``VECTOR``; empty lines are dropped."""
    from pyspark.ml.functions import array_to_vector

    nonempty = lines.where(F.col("value") != "")
    arr = F.transform(java_split(F.col("value"), VECTOR_SEPARATOR), lambda x: x.try_cast("double"))
    ok = F.forall(arr, lambda x: x.isNotNull()) & (F.size(arr) > 0)
    res = _split_result(nonempty, F.lit(False), ok, [arr.alias("_arr")])
    return Parsed(res.good.select(array_to_vector("_arr").alias(col)), res.rejected)
