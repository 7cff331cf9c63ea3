"""Flight analytics over the stand-in tables: filters, aggregates, cubes, joins,
sorts (programs of modules 3 and 4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import date_label
from tessera.functions.numeric import exact_avg, safe_ratio
from tessera.operators import relational as rel
from tessera.plans import standins as si
from tessera.plans.oracle_sql import (
    AIRPORTS_CTE, FLIGHTS_CTE, ROUTE_AIRPORTS_CTE, exact_avg as sql_exact_avg, with_,
)
from tessera.plans.registry import query
from tessera.sources.tables import Tables

# Parameters of the stand-in queries (the reference's literals in brackets).
ORIGIN_FILTER = "1"        # cube filter on one origin  ['LAX']
HOME_COUNTRY = "AMERICA"   # country of the airport table ['USA']
CANCEL_DAY = dt.datetime(1996, 3, 15)   # the day of cancelled_on_day

AVG_COLUMNS = ["flightNum", "distance", "canceled", "diverted", "carrierDelay",
               "weatherDelay", "nasDelay", "securityDelay", "lateAircraftDelay"]


def _flights(spark: SparkSession, sf_dir: str):
    return si.flights(Tables(spark, sf_dir))


def _line_flights(spark: SparkSession, sf_dir: str):
    """The flight fields that a line item has by itself: one scan, no join."""
    return si.line_flights(Tables(spark, sf_dir))


def _sql(spark: SparkSession, text: str, **frames):
    """Run SQL with DataFrames bound to ``{name}`` placeholders; nothing is
    registered in the session catalog, so concurrent callers cannot clash."""
    return spark.sql(text, **frames)


def _oracle(text: str) -> str:
    """The same SQL for DuckDB, where the placeholders are the view names."""
    return text.replace("{flights}", "flights").replace("{airports}", "airports")


# ------------------------------------------------------------------ route counts

ROUTE_COUNTS_SQL = with_(FLIGHTS_CTE) + """
SELECT origin, dest, COUNT(*) AS count FROM flights
GROUP BY origin, dest ORDER BY count DESC, origin, dest"""


@query("route_counts", ROUTE_COUNTS_SQL)
def route_counts(spark, sf_dir):
    return rel.route_counts(_flights(spark, sf_dir))


@query("route_counts_sql", ROUTE_COUNTS_SQL)
def route_counts_sql(spark, sf_dir):
    return _sql(spark, """
        SELECT origin, dest, COUNT(*) AS count FROM {flights}
        GROUP BY origin, dest ORDER BY count DESC, origin, dest""",
                flights=_flights(spark, sf_dir))


@query("route_counts_coalesced", ROUTE_COUNTS_SQL)
def route_counts_coalesced(spark, sf_dir):
    return rel.route_counts_coalesced(_flights(spark, sf_dir), 2)


# ------------------------------------------------------------------ filters

@query("filter_flagged", with_(FLIGHTS_CTE) + """
SELECT l_orderkey, l_linenumber, origin, dest, distance, canceled
FROM flights WHERE canceled > 0""")
def filter_flagged(spark, sf_dir):
    return (si.flight_rows(Tables(spark, sf_dir)).where(F.col("canceled") > 0)
            .select("l_orderkey", "l_linenumber", "origin", "dest", "distance", "canceled"))


@query("filter_not_equal", with_(AIRPORTS_CTE) + f"""
SELECT iata, airport, country FROM airports WHERE country <> '{HOME_COUNTRY}'""")
def filter_not_equal(spark, sf_dir):
    return (si.airports(Tables(spark, sf_dir)).where(F.col("country") != HOME_COUNTRY)
            .select("iata", "airport", "country"))


@query("flagged_by_month", with_(FLIGHTS_CTE) + """
SELECT "date".month AS month, COUNT(*) AS count FROM flights
WHERE canceled > 0 GROUP BY "date".month""")
def flagged_by_month(spark, sf_dir):
    return _line_flights(spark, sf_dir).where(F.col("canceled") > 0).groupBy("date.month").count()


# ------------------------------------------------------------------ global aggregates

AGG_BASIC_SQL = with_(FLIGHTS_CTE) + """
SELECT MIN(times.actualElapsedTime) AS min, MAX(times.actualElapsedTime) AS max,
       AVG(times.actualElapsedTime) AS avg,
       CAST(SUM(times.actualElapsedTime) AS BIGINT) AS sum
FROM flights"""


@query("agg_basic", AGG_BASIC_SQL)
def agg_basic(spark, sf_dir):
    return rel.min_max_avg_sum(_line_flights(spark, sf_dir), "times.actualElapsedTime")


@query("agg_basic_sql", AGG_BASIC_SQL)
def agg_basic_sql(spark, sf_dir):
    return _sql(spark, """
        SELECT MIN(times.actualElapsedTime) AS min, MAX(times.actualElapsedTime) AS max,
               AVG(times.actualElapsedTime) AS avg, SUM(times.actualElapsedTime) AS sum
        FROM {flights}""", flights=_line_flights(spark, sf_dir))


@query("agg_nested_struct", with_(FLIGHTS_CTE) + """
SELECT "date".month AS month, MIN(times.actualElapsedTime) AS min_time,
       MAX(times.actualElapsedTime) AS max_time, AVG(times.actualElapsedTime) AS avg_time
FROM flights GROUP BY "date".month""")
def agg_nested_struct(spark, sf_dir):
    t = F.col("times.actualElapsedTime")
    return (_line_flights(spark, sf_dir).groupBy("date.month")
            .agg(F.min(t).alias("min_time"), F.max(t).alias("max_time"),
                 F.avg(t).alias("avg_time")))


@query("count_star", with_(FLIGHTS_CTE) + "SELECT COUNT(*) AS count FROM flights")
def count_star(spark, sf_dir):
    return _line_flights(spark, sf_dir).agg(F.count("*").alias("count"))


@query("count_col", with_(FLIGHTS_CTE) + "SELECT COUNT(tailNum) AS count FROM flights")
def count_col(spark, sf_dir):
    return _line_flights(spark, sf_dir).agg(F.count("tailNum").alias("count"))


@query("count_distinct", with_(FLIGHTS_CTE) +
       "SELECT COUNT(DISTINCT tailNum) AS countd FROM flights")
def count_distinct(spark, sf_dir):
    return _line_flights(spark, sf_dir).agg(F.count_distinct("tailNum").alias("countd"))


APPROX_ERROR = 0.05   # the default relative standard deviation


@query("approx_distinct", with_(FLIGHTS_CTE) + "SELECT COUNT(tailNum) AS count, TRUE AS within_bound FROM flights")
def approx_distinct(spark, sf_dir):
    """HyperLogLog++ estimate: whether it lies within three standard deviations of
    the exact count."""
    c = _line_flights(spark, sf_dir).agg(F.count("tailNum").alias("count"), F.approx_count_distinct("tailNum", APPROX_ERROR).alias("a"),
                                         F.count_distinct("tailNum").alias("e"))
    return c.select("count", (F.abs(F.col("a") - F.col("e")) <= 3 * APPROX_ERROR * F.col("e")).alias("within_bound"))


SKETCH_LG = 12          # 4,096 registers: a relative standard error of about 1.6 %
SKETCH_BOUND = 0.08


@query("approx_distinct_monthly", with_(FLIGHTS_CTE) + """
SELECT CAST("date".month AS INTEGER) AS month, COUNT(tailNum) AS count, TRUE AS within_bound FROM flights GROUP BY 1
UNION ALL SELECT NULL, COUNT(tailNum), TRUE FROM flights""")
def approx_distinct_monthly(spark, sf_dir):
    """Distinct tail numbers per month and, in the row without a month, of all months, from
    sketches that are kept per month and united later (AGG-8): whether each estimate lies
    within its bound of the exact count, and the united one within that of one pass."""
    f = _line_flights(spark, sf_dir).select(F.col("date.month").alias("month"), "tailNum")
    sketches = rel.monthly_sketches(f, ["month"], "tailNum", SKETCH_LG)
    per_month = sketches.select("month", "count", F.hll_sketch_estimate("sketch").alias("a"))
    united = rel.unite_sketches(sketches, [])
    one = rel.monthly_sketches(f, [], "tailNum", SKETCH_LG).select(F.hll_sketch_estimate("sketch").alias("one"))
    exact = f.groupBy("month").agg(F.count_distinct("tailNum").alias("e"))
    exact_all = f.agg(F.count_distinct("tailNum").alias("e"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= SKETCH_BOUND * F.col(b)
    months = per_month.join(exact, "month").select("month", "count", near("a", "e").alias("within_bound"))
    total = united.select(F.lit(1).alias("k"), "count", "estimate").join(one.withColumn("k", F.lit(1)), "k") \
        .join(exact_all.withColumn("k", F.lit(1)), "k") \
        .select(F.lit(None).cast("int").alias("month"), "count",
                (near("estimate", "e") & (F.abs(F.col("estimate") - F.col("one")) <= 0.01 * F.col("one"))).alias("within_bound"))
    return months.unionByName(total)


# ------------------------------------------------------------------ cubes

def _avg_list(cols):
    return ",\n  ".join(f'AVG({c}) AS "avg({c})"' for c in cols)


@query("cube_avg_all", with_(FLIGHTS_CTE) + f"""
SELECT origin, dest,
  {_avg_list(AVG_COLUMNS)}
FROM flights GROUP BY CUBE (origin, dest)""")
def cube_avg_all(spark, sf_dir):
    return rel.cube_avg(_flights(spark, sf_dir), ["origin", "dest"])


@query("cube_filter", with_(FLIGHTS_CTE) + f"""
SELECT * FROM (
  SELECT origin, dest, AVG(distance) AS "avg(distance)"
  FROM flights GROUP BY CUBE (origin, dest)) c
WHERE origin = '{ORIGIN_FILTER}'""")
def cube_filter(spark, sf_dir):
    return (rel.cube_avg(_flights(spark, sf_dir), ["origin", "dest"])
            .select("origin", "dest", "avg(distance)")
            .filter(F.col("origin") == ORIGIN_FILTER))


@query("cube_map_agg", with_(FLIGHTS_CTE) + """
SELECT origin, dest, COUNT(*) AS count, AVG(times.actualElapsedTime) AS avg_time,
       AVG(distance) AS avg_dist
FROM flights GROUP BY CUBE (origin, dest) ORDER BY avg_dist DESC""")
def cube_map_agg(spark, sf_dir):
    out = (_flights(spark, sf_dir).cube("origin", "dest")
           .agg({"*": "count", "times.actualElapsedTime": "avg", "distance": "avg"}))

    # generated names: count(1), avg(distance) and a form of avg(times.actualElapsedTime)
    def rename(c):
        if c.startswith("count("):
            return "count"
        if c.startswith("avg(") and "actualElapsedTime" in c:
            return "avg_time"
        if c == "avg(distance)":
            return "avg_dist"
        return c
    out = out.toDF(*[rename(c) for c in out.columns])
    return (out.select("origin", "dest", "count", "avg_time", "avg_dist")
            .orderBy(F.desc("avg_dist")))


# Fixed statements: RATIO_SELECT, GROUP_COUNT_AVGS, GROUP_TWO_AVGS and the two join
# statements of the SQL twins have the aliases and column order that are required.
RATIO_SELECT = """
  AVG(distance) AS avg_dist,
  MIN(times.actualElapsedTime) AS min_time,
  MAX(times.actualElapsedTime) AS max_time,
  AVG(times.actualElapsedTime) AS avg_time,
  (AVG(distance) / AVG(times.actualElapsedTime)) AS t_d"""


@query("cube_ratio", with_(FLIGHTS_CTE) + f"""
SELECT origin, dest, {RATIO_SELECT}
FROM flights GROUP BY CUBE (origin, dest) ORDER BY avg_dist DESC""")
def cube_ratio(spark, sf_dir):
    t = F.col("times.actualElapsedTime")
    return (_flights(spark, sf_dir).cube("origin", "dest")
            .agg(F.avg("distance").alias("avg_dist"), F.min(t).alias("min_time"),
                 F.max(t).alias("max_time"), F.avg(t).alias("avg_time"),
                 safe_ratio(F.avg("distance"), F.avg(t)).alias("t_d"))
            .orderBy(F.desc("avg_dist")))


@query("cube_two_avgs", with_(FLIGHTS_CTE) + """
SELECT origin, dest, AVG(canceled) AS canceled, AVG(weatherDelay) AS weatherDelay
FROM flights GROUP BY CUBE (origin, dest)""")
def cube_two_avgs(spark, sf_dir):
    return (rel.cube_avg(_flights(spark, sf_dir), ["origin", "dest"], ["canceled", "weatherDelay"])
            .toDF("origin", "dest", "canceled", "weatherDelay")
            .orderBy(F.desc("canceled")))


@query("cube_one_key", with_(AIRPORTS_CTE) + f"""
SELECT state, MIN(lat) AS "min(lat)", MAX(lat) AS "max(lat)", {sql_exact_avg('lat')} AS "avg(lat)",
       MIN(long) AS "min(long)", MAX(long) AS "max(long)", {sql_exact_avg('long')} AS "avg(long)"
FROM airports GROUP BY CUBE (state)""")
def cube_one_key(spark, sf_dir):
    a = si.airports(Tables(spark, sf_dir)).select("state", "lat", "long")
    return a.cube("state").agg(
        F.min("lat").alias("min(lat)"), F.max("lat").alias("max(lat)"),
        exact_avg("lat", 2).alias("avg(lat)"),
        F.min("long").alias("min(long)"), F.max("long").alias("max(long)"),
        exact_avg("long", 2).alias("avg(long)"))


# ------------------------------------------------------------------ plain GROUP BY in SQL

def _sql_avgs(cols):
    return ",\n  ".join(f"AVG({c}) AS `avg({c})`" for c in cols)


@query("group_avgs_sql", with_(FLIGHTS_CTE) + f"""
SELECT origin, dest,
  {_avg_list(AVG_COLUMNS)}
FROM flights GROUP BY origin, dest""")
def group_avgs_sql(spark, sf_dir):
    return _sql(spark, f"""
        SELECT origin, dest,
          {_sql_avgs(AVG_COLUMNS)}
        FROM {{flights}} GROUP BY origin, dest""", flights=_flights(spark, sf_dir))


GROUP_COUNT_AVGS = """
SELECT origin, dest, COUNT(*) AS count, AVG(times.actualElapsedTime) AS avg_time,
       AVG(distance) AS avg_dist
FROM {flights} GROUP BY origin, dest ORDER BY avg_dist DESC"""


@query("group_count_avgs_sql", with_(FLIGHTS_CTE) + _oracle(GROUP_COUNT_AVGS))
def group_count_avgs_sql(spark, sf_dir):
    return _sql(spark, GROUP_COUNT_AVGS, flights=_flights(spark, sf_dir))


@query("group_ratio_sql", with_(FLIGHTS_CTE) + f"""
SELECT origin, dest, {RATIO_SELECT}
FROM flights GROUP BY origin, dest ORDER BY avg_dist DESC""")
def group_ratio_sql(spark, sf_dir):
    return _sql(spark, """
        SELECT origin, dest,
          AVG(distance) AS avg_dist,
          MIN(times.actualElapsedTime) AS min_time,
          MAX(times.actualElapsedTime) AS max_time,
          AVG(times.actualElapsedTime) AS avg_time,
          try_divide(AVG(distance), AVG(times.actualElapsedTime)) AS t_d
        FROM {flights} GROUP BY origin, dest ORDER BY avg_dist DESC""",
                flights=_flights(spark, sf_dir))


GROUP_TWO_AVGS = """
SELECT origin, dest, AVG(canceled) AS canceled, AVG(weatherDelay) AS weatherDelay
FROM {flights} GROUP BY origin, dest ORDER BY canceled DESC"""


@query("group_two_avgs_sql", with_(FLIGHTS_CTE) + _oracle(GROUP_TWO_AVGS))
def group_two_avgs_sql(spark, sf_dir):
    return _sql(spark, GROUP_TWO_AVGS, flights=_flights(spark, sf_dir))


# ------------------------------------------------------------------ the airport table

@query("dim_count", with_(AIRPORTS_CTE) +
       "SELECT country, COUNT(*) AS count FROM airports GROUP BY country")
def dim_count(spark, sf_dir):
    return _sql(spark, "SELECT country, COUNT(*) AS count FROM {airports} GROUP BY country",
                airports=si.airports(Tables(spark, sf_dir)))


DIM_COUNT_FILTERED = f"""
SELECT state, COUNT(*) AS count FROM {{airports}}
WHERE country = '{HOME_COUNTRY}' GROUP BY state ORDER BY count DESC"""


@query("dim_count_filtered", with_(AIRPORTS_CTE) + _oracle(DIM_COUNT_FILTERED))
def dim_count_filtered(spark, sf_dir):
    return _sql(spark, DIM_COUNT_FILTERED, airports=si.airports(Tables(spark, sf_dir)))


# ------------------------------------------------------------------ dates, sorts

@query("distinct_dates", with_(FLIGHTS_CTE) + """
SELECT DISTINCT "date".year AS year, "date".month AS month, "date".dayOfMonth AS dayOfMonth
FROM flights""")
def distinct_dates(spark, sf_dir):
    return _line_flights(spark, sf_dir).select("date.year", "date.month", "date.dayOfMonth").distinct()


@query("date_labels", with_(FLIGHTS_CTE) + """
SELECT "date".year AS year, "date".month AS month, "date".dayOfMonth AS dayOfMonth,
       "date".dayOfWeek AS dayOfWeek, strftime(l_shipdate, '%Y-%m-%d (%A)') AS label,
       COUNT(*) AS count
FROM flights GROUP BY ALL""")
def date_labels(spark, sf_dir):
    f = _line_flights(spark, sf_dir)
    return (f.groupBy("date.year", "date.month", "date.dayOfMonth", "date.dayOfWeek").count()
            .select("year", "month", "dayOfMonth", "dayOfWeek",
                    date_label("year", "month", "dayOfMonth", "dayOfWeek").alias("label"),
                    "count"))


SORTED_TOPK_N = 20


@query("sorted_topk", with_(FLIGHTS_CTE) + f"""
SELECT l_orderkey, l_linenumber, origin, dest, distance FROM flights
ORDER BY distance DESC, l_orderkey, l_linenumber LIMIT {SORTED_TOPK_N}""")
def sorted_topk(spark, sf_dir):
    """The longest flights; a top-k report, planned as TakeOrderedAndProject."""
    return (si.flight_rows(Tables(spark, sf_dir))
            .select("l_orderkey", "l_linenumber", "origin", "dest", "distance")
            .orderBy(F.desc("distance"), "l_orderkey", "l_linenumber")
            .limit(SORTED_TOPK_N))


# ------------------------------------------------------------------ joins with the airports

ROUTE_NAMES_SQL = with_(FLIGHTS_CTE, ROUTE_AIRPORTS_CTE, """
fbasql AS (SELECT origin, dest, COUNT(*) AS count FROM flights GROUP BY origin, dest)""") + """
SELECT f.origin, a1.airport AS origin_airport, f.dest, a2.airport AS dest_airport, f.count
FROM fbasql f
JOIN route_airports a1 ON f.origin = a1.iata
JOIN route_airports a2 ON f.dest = a2.iata"""


@query("route_names", ROUTE_NAMES_SQL)
def route_names(spark, sf_dir):
    t = Tables(spark, sf_dir)
    routes = si.flights(t).groupBy("origin", "dest").count()
    return rel.name_routes(routes, si.route_airports(t)).orderBy(F.desc("count"), "origin", "dest")


@query("route_names_sql", ROUTE_NAMES_SQL)
def route_names_sql(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _sql(spark, """
        SELECT f.origin, a1.airport AS origin_airport,
               f.dest, a2.airport AS dest_airport, f.count
        FROM {fbasql} f
        JOIN {airports} a1 ON f.origin = a1.iata
        JOIN {airports} a2 ON f.dest = a2.iata""",
                fbasql=si.flights(t).groupBy("origin", "dest").count(),
                airports=si.route_airports(t))


LEFT_OUTER_SQL = with_(FLIGHTS_CTE, AIRPORTS_CTE, """
fba AS (SELECT origin, dest, COUNT(*) AS count FROM flights GROUP BY origin, dest)""") + """
SELECT * FROM airports a LEFT OUTER JOIN fba f ON a.iata = f.origin"""


@query("left_outer_all", LEFT_OUTER_SQL)
def left_outer_all(spark, sf_dir):
    """The airport catalog with the counts of all routes; most airports have none."""
    t = Tables(spark, sf_dir)
    return rel.airports_with_routes(si.airports(t), si.flights(t).groupBy("origin", "dest").count())


@query("left_outer_sql", LEFT_OUTER_SQL)
def left_outer_sql(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _sql(spark, "SELECT * FROM {airports} a LEFT OUTER JOIN {fba} f ON a.iata = f.origin",
                airports=si.airports(t), fba=si.flights(t).groupBy("origin", "dest").count())


DAY_SQL = with_(FLIGHTS_CTE, f"""
day AS (SELECT * FROM flights WHERE l_shipdate >= TIMESTAMP '{CANCEL_DAY:%Y-%m-%d}'
        AND l_shipdate < TIMESTAMP '{CANCEL_DAY + dt.timedelta(days=1):%Y-%m-%d}')""") + """
SELECT origin, dest, COUNT(*) AS count FROM day WHERE canceled > 0 GROUP BY origin, dest"""


@query("cancelled_on_day", DAY_SQL)
def cancelled_on_day(spark, sf_dir):
    """Routes cancelled on one day; the day filter is pushed into the scan."""
    d = F.col("l_shipdate")
    nxt = CANCEL_DAY + dt.timedelta(days=1)
    return (si.flight_rows(Tables(spark, sf_dir))
            .where((d >= F.lit(CANCEL_DAY).cast("timestamp_ntz")) & (d < F.lit(nxt).cast("timestamp_ntz"))
                   & (F.col("canceled") > 0))
            .groupBy("origin", "dest").count())
