"""Record parsers over lines rendered from the driver's tables. Each line is good,
a header or malformed by a key rule, so the oracle states the parsed fields by
the same rule without parsing anything."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import dates as dt
from tessera.functions.strings import to_double
from tessera.operators import text as tx
from tessera.plans.q_text import sql_normalize
from tessera.plans.registry import query
from tessera.sources import parsers as P
from tessera.sources.tables import Tables


def _lines(df, expr: str):
    return df.select(F.expr(expr).alias("value"))


# ---------------------------------------------------------------- flights (SRC-8, INT-1)

# k = l_orderkey % 10: 0 header, 1 too few fields, 2 blank line, else good
FLIGHT_LINE = """CASE l_orderkey % 10 WHEN 0 THEN ' Year , Month, DayofMonth' WHEN 1 THEN '1996,1,2,3' WHEN 2 THEN ''
  ELSE concat_ws(',', year(l_shipdate), month(l_shipdate), dayofmonth(l_shipdate), weekday(l_shipdate) + 1,
    CASE WHEN l_linenumber % 3 = 0 THEN 'NA' ELSE cast(100 * l_linenumber + 5 AS string) END, '',
    CASE WHEN l_linenumber % 4 = 0 THEN '10x3' ELSE cast(1200 + l_linenumber AS string) END, '1300', ' AA ', l_linenumber,
    concat('N', l_partkey), cast(l_quantity AS int), 'NA', '5', '-3', ' 0 ', concat('O', l_suppkey), concat('D', l_partkey),
    cast(floor(l_extendedprice) AS int), '4', '8', CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END,
    CASE WHEN l_returnflag = 'R' THEN 'A' ELSE '' END, '0', 'NA', '1', '2', '3', '4', 'beyond') END"""

FLIGHT_SQL = """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       CAST(day(l_shipdate) AS INTEGER) AS "dayOfMonth", CAST(isodow(l_shipdate) AS INTEGER) AS "dayOfWeek",
       CAST(CASE WHEN l_linenumber % 3 = 0 THEN -1 ELSE 100 * l_linenumber + 5 END AS INTEGER) AS "depTime", -1 AS "crsDepTime",
       CAST(CASE WHEN l_linenumber % 4 = 0 THEN -1 ELSE 1200 + l_linenumber END AS INTEGER) AS "arrTime", 1300 AS "crsArrTime",
       CAST(l_quantity AS INTEGER) AS "actualElapsedTime", -1 AS "crsElapsedTime", 5 AS "airTime", -3 AS "arrDelay", 0 AS "depDelay",
       4 AS "taxiIn", 8 AS "taxiOut", 'AA' AS "uniqueCarrier", CAST(l_linenumber AS INTEGER) AS "flightNum",
       'N' || l_partkey AS "tailNum", 'O' || l_suppkey AS origin, 'D' || l_partkey AS dest,
       CAST(floor(l_extendedprice) AS INTEGER) AS distance, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS canceled,
       CASE WHEN l_returnflag = 'R' THEN 'A' ELSE '' END AS "cancellationCode", 0 AS diverted, -1 AS "carrierDelay",
       1 AS "weatherDelay", 2 AS "nasDelay", 3 AS "securityDelay", 4 AS "lateAircraftDelay"
FROM lineitem WHERE l_orderkey % 10 > 2"""


def _flight_lines(t: Tables):
    return _lines(t.lineitem, FLIGHT_LINE)


@query("parse_flights", FLIGHT_SQL)
def parse_flights(spark, sf_dir):
    """Flight lines, one per line item, parsed; all fields of the good ones."""
    good = P.parse_flights(_flight_lines(Tables(spark, sf_dir))).good
    return good.select("date.*", "times.*", *[c for c in good.columns if c not in ("date", "times")])


# ---------------------------------------------------------------- airports, carriers, planes (SRC-9 to 11, STR-8, NUM-1)

AIRPORT = """CASE c_custkey % 20 WHEN 0 THEN ' "iata" ,"airport","city"' WHEN 1 THEN concat('"A', c_custkey, '","Bad "Q" Field","c","s","USA",1.0,2.0')
  WHEN 2 THEN concat('"A', c_custkey, '" , "', c_name, '",NA,NA,"Palau",', c_nationkey, '.5,-122.25')
  WHEN 3 THEN concat('"A', c_custkey, '","', c_name, '","c","s","USA",1.2.3,2.0')
  ELSE concat('"A', c_custkey, '","', c_name, '","', c_mktsegment, '","WA","USA",', c_nationkey, '.5, -122.25 ') END"""


@query("parse_airports", """
SELECT 'A' || c_custkey AS iata, c_name AS airport, CASE WHEN c_custkey % 20 = 2 THEN 'NA' ELSE c_mktsegment END AS city,
       CASE WHEN c_custkey % 20 = 2 THEN 'NA' ELSE 'WA' END AS state, CASE WHEN c_custkey % 20 = 2 THEN 'Palau' ELSE 'USA' END AS country,
       CAST(c_nationkey + 0.5 AS FLOAT) AS latitude, CAST(-122.25 AS FLOAT) AS longitude
FROM customer WHERE c_custkey % 20 NOT IN (0, 1, 3)""")
def parse_airports(spark, sf_dir):
    return P.parse_airports(_lines(Tables(spark, sf_dir).customer, AIRPORT)).good


CARRIER = """CASE s_suppkey % 25 WHEN 0 THEN 'Code,Description' WHEN 1 THEN concat('C', s_suppkey, ',unquoted')
  ELSE concat(' "C', s_suppkey, '" , "', s_name, ' Inc." ') END"""


@query("parse_carriers", """
SELECT 'C' || s_suppkey AS code, s_name || ' Inc.' AS description FROM supplier WHERE s_suppkey % 25 > 1""")
def parse_carriers(spark, sf_dir):
    return P.parse_carriers(_lines(Tables(spark, sf_dir).supplier, CARRIER)).good


PLANE = """CASE WHEN p_partkey % 50 = 0 THEN 'tailnum,type' WHEN p_partkey % 50 = 1 THEN concat('X', p_partkey)
  WHEN p_partkey % 3 = 0 THEN concat(' N', p_partkey, ' ')
  ELSE concat('N', p_partkey, ',Corporation,MAKER,01/02/2003,M-1,Valid,Fixed Wing,Turbo-Fan,', CASE WHEN p_partkey % 3 = 1 THEN 'None' ELSE '1999' END) END"""
_full = lambda v: f"CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '{v}' END"


@query("parse_planes", f"""
SELECT 'N' || p_partkey AS "tailNum", {_full('Corporation')} AS kind, {_full('MAKER')} AS manufacturer, {_full('01/02/2003')} AS "issueDate",
       {_full('M-1')} AS model, {_full('Valid')} AS status, {_full('Fixed Wing')} AS "aircraftType", {_full('Turbo-Fan')} AS "engineType",
       CASE p_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN -1 ELSE 1999 END AS year
FROM part WHERE p_partkey % 50 > 1""")
def parse_planes(spark, sf_dir):
    return P.parse_planes(_lines(Tables(spark, sf_dir).part, PLANE)).good


# ---------------------------------------------------------------- abbreviations, pairs (SRC-12, 13)

ABBREV = "CASE WHEN s_suppkey % 9 = 0 THEN concat('no tab ', s_suppkey) ELSE concat(' S', s_suppkey, '\\t ', s_name) END"


@query("parse_abbreviations", """
SELECT 'S' || s_suppkey AS book, s_name AS "bookName" FROM supplier WHERE s_suppkey % 9 > 0""")
def parse_abbreviations(spark, sf_dir):
    return P.parse_abbreviations(_lines(Tables(spark, sf_dir).supplier, ABBREV)).good


def _pair_lines(t: Tables):
    one_line = F.concat(F.lit("( d"), F.col("doc_id"), F.lit(" ,"), tx.normalize_text("text"), F.lit(")"))
    bad = F.concat(F.lit("no pair "), F.col("doc_id"))
    return t.documents.select(F.when(F.col("doc_id") % 11 == 0, bad).otherwise(one_line).alias("value"))


@query("parse_pairs", f"""
SELECT 'd' || doc_id AS doc, lower({sql_normalize('text')}) AS text FROM documents WHERE doc_id % 11 > 0""")
def parse_pairs(spark, sf_dir):
    return P.parse_pairs(_pair_lines(Tables(spark, sf_dir))).good


# ---------------------------------------------------------------- ratings, movies, vectors (SRC-14 to 16, ARR-2, FLT-9)

RATING = """CASE WHEN l_linenumber = 7 THEN 'x::1::2' WHEN l_orderkey % 13 = 0 THEN concat(l_partkey, '::', l_suppkey)
  ELSE concat(l_partkey, '::', l_suppkey, '::', l_linenumber, '.5', CASE WHEN l_linenumber % 2 = 0 THEN '::978300760' ELSE '' END) END"""


@query("parse_ratings", """
SELECT CAST(l_partkey AS INTEGER) AS "userId", CAST(l_suppkey AS INTEGER) AS "movieId", l_linenumber + CAST(0.5 AS DOUBLE) AS rating
FROM lineitem WHERE l_linenumber <> 7 AND l_orderkey % 13 <> 0""")
def parse_ratings(spark, sf_dir):
    return P.parse_ratings(_lines(Tables(spark, sf_dir).lineitem, RATING)).good


MOVIE = """CASE WHEN p_partkey % 30 = 0 THEN concat(p_partkey, '::', p_name) WHEN p_partkey % 30 = 1 THEN concat('m', p_partkey, '::t::g')
  ELSE concat(p_partkey, '::', p_name, '::', replace(p_type, ' ', '|')) END"""


@query("parse_movies", """
SELECT CAST(p_partkey AS INTEGER) AS "movieId", p_name AS title, replace(p_type, ' ', '/') AS genres, len(string_split(p_type, ' ')) AS n_genres
FROM part WHERE p_partkey % 30 > 1""")
def parse_movies(spark, sf_dir):
    good = P.parse_movies(_lines(Tables(spark, sf_dir).part, MOVIE)).good
    return good.select("movieId", "title", F.array_join("genres", "/").alias("genres"), F.size("genres").cast("long").alias("n_genres"))


VECTOR = "CASE vec_id % 10 WHEN 0 THEN '' WHEN 1 THEN '1.0 x 2' ELSE concat(vec_id, '.5 ', label, ' -1.25e1') END"


@query("parse_vectors", """
SELECT vec_id + CAST(0.5 AS DOUBLE) AS a, CAST(label AS DOUBLE) AS b, CAST(-12.5 AS DOUBLE) AS c FROM embeddings WHERE vec_id % 10 > 1""")
def parse_vectors(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array
    good = P.parse_vectors(_lines(Tables(spark, sf_dir).embeddings, VECTOR)).good.select(vector_to_array("features").alias("v"))
    return good.select(*[F.col("v")[i].alias(n) for i, n in enumerate("abc")])


# ---------------------------------------------------------------- rejects (FLT-4, SRC-6 for lines)

_REJECTS = {
    "flights": ("lineitem", "l_orderkey % 10 = 0", "l_orderkey % 10 IN (1, 2)"),
    "airports": ("customer", "c_custkey % 20 = 0", "c_custkey % 20 IN (1, 3)"),
    "carriers": ("supplier", "s_suppkey % 25 = 0", "s_suppkey % 25 = 1"),
    "planes": ("part", "p_partkey % 50 = 0", "p_partkey % 50 = 1"),
    "abbreviations": ("supplier", "false", "s_suppkey % 9 = 0"),
    "pairs": ("documents", "false", "doc_id % 11 = 0"),
    "ratings": ("lineitem", "false", "l_linenumber = 7 OR l_orderkey % 13 = 0"),
    "movies": ("part", "false", "p_partkey % 30 <= 1"),
    "vectors": ("embeddings", "false", "vec_id % 10 = 1"),
}


@query("parse_rejects", "\nUNION ALL\n".join(
    f"SELECT '{p}' AS parser, reason, count(*) AS count FROM (SELECT CASE WHEN {h} THEN 'header' WHEN {b} THEN 'bad' END AS reason FROM {t}) "
    f"WHERE reason IS NOT NULL GROUP BY reason" for p, (t, h, b) in _REJECTS.items()))
def parse_rejects(spark, sf_dir):
    """Rejected lines of every parser by reason; the good ones are in ``parse_*``."""
    t = Tables(spark, sf_dir)
    rejected = {
        "flights": P.parse_flights(_flight_lines(t)), "airports": P.parse_airports(_lines(t.customer, AIRPORT)),
        "carriers": P.parse_carriers(_lines(t.supplier, CARRIER)), "planes": P.parse_planes(_lines(t.part, PLANE)),
        "abbreviations": P.parse_abbreviations(_lines(t.supplier, ABBREV)), "pairs": P.parse_pairs(_pair_lines(t)),
        "ratings": P.parse_ratings(_lines(t.lineitem, RATING)), "movies": P.parse_movies(_lines(t.part, MOVIE)),
        "vectors": P.parse_vectors(_lines(t.embeddings, VECTOR)),
    }
    out = None
    for name, parsed in rejected.items():
        d = parsed.rejected.groupBy("reason").count().select(F.lit(name).alias("parser"), "reason", "count")
        out = d if out is None else out.unionByName(d)
    return out


# ---------------------------------------------------------------- dates and numbers (DAT-1 to 5, DAT-7, NUM-1)

@query("parse_dates", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_linenumber <> 3 THEN CAST(year(l_shipdate) AS INTEGER) END AS year,
  CASE WHEN l_linenumber <> 3 THEN CAST(month(l_shipdate) AS INTEGER) END AS month,
  CASE WHEN l_linenumber <> 3 THEN CAST(day(l_shipdate) AS INTEGER) END AS day,
  CASE WHEN l_linenumber <> 5 THEN CAST(l_linenumber + 10 AS INTEGER) END AS hour,
  CASE WHEN l_linenumber <> 5 THEN CAST(l_orderkey % 60 AS INTEGER) END AS minute,
  CASE WHEN l_linenumber <> 5 THEN CASE WHEN l_linenumber % 2 = 0 THEN 7 ELSE 0 END END AS second,
  l_linenumber NOT IN (3, 5) AS both,
  CASE WHEN l_linenumber <> 4 THEN CAST(l_quantity AS DOUBLE) END AS number
FROM lineitem""")
def parse_dates(spark, sf_dir):
    """Dates, times and numbers rendered per line item and parsed back; wrong ones are null."""
    day = F.when(F.col("l_linenumber") == 3, F.lit("13-x-1996")).otherwise(F.date_format("l_shipdate", "MM / dd-yyyy"))
    clock = F.when(F.col("l_linenumber") == 5, F.lit("12")).otherwise(F.concat_ws(
        ":", F.col("l_linenumber") + 10, F.lpad((F.col("l_orderkey") % 60).cast("string"), 2, "0"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("07"))))
    plain = F.when(F.col("l_linenumber") == 3, F.lit("13-x-1996")).otherwise(F.date_format("l_shipdate", "MM/dd/yyyy"))
    number = F.when(F.col("l_linenumber") == 4, F.lit("n/a")).otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")))
    d = Tables(spark, sf_dir).lineitem.select(
        "l_orderkey", "l_linenumber", dt.parse_ymd(day).alias("d"), dt.parse_hms(clock).alias("t"),
        dt.parse_date_time(F.concat(plain, F.lit("  "), clock)).alias("b"), to_double(number).alias("number"))
    return d.select("l_orderkey", "l_linenumber", "d.year", "d.month", "d.day", "t.hour", "t.minute", "t.second",
                    F.col("b").isNotNull().alias("both"), "number")


@query("times_labels", """
SELECT '(-1,-1,-1,-1,' || CAST(l_quantity AS INTEGER) || ',-1,-1,-1,-1,-1,-1)' AS label, count(*) AS count FROM lineitem GROUP BY 1""")
def times_labels(spark, sf_dir):
    """The times of a flight as one label, counted (DAT-7)."""
    from tessera.plans import standins as si
    f = si.line_flights(Tables(spark, sf_dir))
    return f.groupBy(dt.times_label("times").alias("label")).count()


@query("date_order", """
SELECT row_number() OVER (ORDER BY y, m, d) AS place, y AS year, m AS month, d AS day FROM (
  SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m, CAST(day(l_shipdate) AS INTEGER) AS d FROM lineitem)""")
def date_order(spark, sf_dir):
    """The distinct dates in date order with their places (DAT-4); a date range is
    a few thousand rows whatever the number of flights."""
    from tessera.plans import standins as si
    days = si.line_flights(Tables(spark, sf_dir)).select("date").distinct()
    rows = dt.order_by_date(days).select(F.struct("date.year", "date.month", "date.dayOfMonth").alias("d"))
    listed = rows.agg(F.array_sort(F.collect_list("d")).alias("l")).select(F.posexplode("l").alias("p", "d"))
    return listed.select((F.col("p") + 1).cast("long").alias("place"), "d.year", "d.month", F.col("d.dayOfMonth").alias("day"))

