"""Relational operators of the flight-analytics programs (AGG, JON, SRT, FLT).

Aggregations run as partial + final hash aggregates, so a hot key is combined
map-side before the shuffle. Cubes expand each row once per grouping set
(4 sets for two keys) before that partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import exact_avg, exact_sum
from tessera.session import shared_dir


def route_counts(flights: DataFrame, src: str = "origin", dst: str = "dest") -> DataFrame:
    """Flights per (src, dst), most frequent first (AGG-1, SRT-2)."""
    return flights.groupBy(src, dst).count().orderBy(F.desc("count"), src, dst)


def on_date(flights: DataFrame, year: int, month: int, day: int, date: str = "date") -> DataFrame:
    """Flights of one day: equalities on the nested date fields (FLT-5)."""
    d = F.col(date)
    return flights.where((d["year"] == year) & (d["month"] == month) & (d["dayOfMonth"] == day))


def route_counts_coalesced(flights: DataFrame, n: int = 2,
                           src: str = "origin", dst: str = "dest") -> DataFrame:
    """SRT-3: the same counts, coalesced to ``n`` partitions before the sort."""
    return (flights.groupBy(src, dst).count().coalesce(n)
            .sort(F.desc("count"), src, dst))


def count_by(df: DataFrame, *keys: str, order_by_count: bool = False) -> DataFrame:
    out = df.groupBy(*keys).count()
    if order_by_count:
        out = out.orderBy(F.desc("count"), *keys)
    return out


def min_max_avg_sum(df: DataFrame, col: str, scale: int | None = None,
                    names=("min", "max", "avg", "sum")) -> DataFrame:
    """Global min, max, avg and sum of one column, one pass (AGG-4).

    With ``scale``, avg and sum are computed exactly, for values of at most ``scale`` decimals."""
    c = F.col(col)
    avg = exact_avg(c, scale) if scale is not None else F.avg(c)
    tot = exact_sum(c, scale) if scale is not None else F.sum(c)
    return df.agg(F.min(c).alias(names[0]), F.max(c).alias(names[1]),
                  avg.alias(names[2]), tot.alias(names[3]))


def count_summary(df: DataFrame, col: str) -> DataFrame:
    """COUNT(*), COUNT(col), COUNT(DISTINCT col) in one aggregate (AGG-5/6/7)."""
    return df.agg(F.count(F.lit(1)).alias("count"), F.count(col).alias("count_col"),
                  F.count_distinct(col).alias("countd"))


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def cube_avg(df: DataFrame, keys: list[str], cols: list[str] | None = None,
             with_grouping_id: bool = False) -> DataFrame:
    """``cube(keys).avg(cols)``; with no cols, every numeric column (AGG-9/13).

    A subtotal row has null keys, which a null key value looks the same as;
    ``with_grouping_id`` adds ``grouping_id`` (bit set = key rolled up)."""
    g = df.cube(*keys)
    if not with_grouping_id:
        return g.avg(*cols) if cols else g.avg()
    if not cols:
        cols = [c for c, t in df.dtypes if t in _NUMERIC or t.startswith("decimal")]
    return g.agg(*[F.avg(c).alias(f"avg({c})") for c in cols], F.grouping_id().alias("grouping_id"))


def cube_agg(df: DataFrame, keys: list[str], *exprs: Column,
             with_grouping_id: bool = False) -> DataFrame:
    if with_grouping_id:
        exprs = (*exprs, F.grouping_id().alias("grouping_id"))
    return df.cube(*keys).agg(*exprs)


def name_routes(routes: DataFrame, airports: DataFrame, code: str = "iata",
                name: str = "airport") -> DataFrame:
    """Inner-join route counts with the airport dimension twice (JON-1):
    (origin, origin_airport, dest, dest_airport, count). Catalyst and AQE broadcast
    the dimension when its bytes are under their threshold."""
    dim = airports.select(code, name)
    a1 = dim.select(F.col(code).alias("_o"), F.col(name).alias("origin_airport"))
    a2 = dim.select(F.col(code).alias("_d"), F.col(name).alias("dest_airport"))
    return (routes.join(a1, routes["origin"] == a1["_o"])
            .join(a2, routes["dest"] == a2["_d"])
            .select("origin", "origin_airport", "dest", "dest_airport", "count"))


def airports_with_routes(airports: DataFrame, routes: DataFrame, code: str = "iata",
                         src: str = "origin") -> DataFrame:
    """Every airport, with its routes when it has some (JON-3, left outer)."""
    return airports.join(routes, airports[code] == routes[src], "left_outer")


def monthly_sketches(df: DataFrame, keys: list[str], value: str, lg: int = 12) -> DataFrame:
    """Stored rows (keys, count, sketch): rows with a ``value`` and a mergeable HyperLogLog
    sketch of its distinct values, per group of ``keys`` (AGG-8). Sketches of later
    rows can be added as rows; ``unite_sketches`` takes any of them together."""
    path = shared_dir(df.sparkSession, "sketches")
    (df.groupBy(*keys).agg(F.count(value).alias("count"), F.hll_sketch_agg(value, F.lit(lg)).alias("sketch"))
     .write.parquet(path))
    return df.sparkSession.read.parquet(path)


def unite_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, count, estimate) of the union of sketches with equal ``keys``, without a look
    at the rows behind them."""
    return sketches.groupBy(*keys).agg(
        F.sum("count").alias("count"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
