"""SQL fragments shared by the DuckDB oracles: the stand-in datasets written in
plain SQL, mirroring ``standins.py`` column for column."""

FLIGHTS_CTE = """
flights AS (
  SELECT l_orderkey, l_linenumber, l_shipdate,
    {'year': CAST(year(l_shipdate) AS INTEGER),
     'month': CAST(month(l_shipdate) AS INTEGER),
     'dayOfMonth': CAST(day(l_shipdate) AS INTEGER),
     'dayOfWeek': CAST(isodow(l_shipdate) AS INTEGER)} AS "date",
    {'depTime': -1, 'crsDepTime': -1, 'arrTime': -1, 'crsArrTime': -1,
     'actualElapsedTime': CAST(l_quantity AS INTEGER),
     'crsElapsedTime': -1, 'airTime': -1, 'arrDelay': -1, 'depDelay': -1,
     'taxiIn': -1, 'taxiOut': -1} AS times,
    c_mktsegment AS uniqueCarrier,
    l_linenumber AS flightNum,
    'N' || CAST(l_partkey AS VARCHAR) AS tailNum,
    CAST(s_nationkey AS VARCHAR) AS origin,
    CAST(c_nationkey AS VARCHAR) AS dest,
    CAST(floor(l_extendedprice) AS INTEGER) AS distance,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS canceled,
    CASE WHEN l_returnflag = 'R' THEN l_returnflag ELSE '' END AS cancellationCode,
    CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS diverted,
    -1 AS carrierDelay,
    CAST(round(l_discount * 100) AS INTEGER) AS weatherDelay,
    CAST(round(l_tax * 100) AS INTEGER) AS nasDelay,
    -1 AS securityDelay,
    -1 AS lateAircraftDelay
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""

ROUTE_AIRPORTS_CTE = """
route_airports AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS iata, n_name AS airport, r_name AS country
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

AIRPORTS_CTE = """
airports AS (
  SELECT CAST(c_custkey AS VARCHAR) AS iata, c_name AS airport, c_mktsegment AS city,
         n_name AS state, r_name AS country, c_acctbal AS lat,
         CAST(c_nationkey AS DOUBLE) AS long
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

RATINGS_CTE = """
ratings AS (
  SELECT o_custkey AS userId, l_partkey AS movieId,
         CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def exact_avg(expr: str) -> str:
    return f"(CAST(SUM(CAST({expr} AS DECIMAL(38,2))) AS DOUBLE) / COUNT({expr}))"


def exact_sum(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(38,2))) AS DOUBLE)"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"
