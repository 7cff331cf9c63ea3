"""The reference's inputs (airline flights, airports, corpora, tweets, ratings,
vectors) are absent, so each is derived from the driver's tables. Everything
here is lazy; columns a query does not use are pruned before the scan.

flights   lineitem ⋈ orders ⋈ customer ⋈ supplier, one row per line item:
          origin = supplier nation, dest = customer nation (as codes),
          distance = floor(l_extendedprice), actualElapsedTime = l_quantity,
          canceled = (l_returnflag = 'R'), date = l_shipdate.
route airports  nation (+ region): code = nation key, airport = nation name.
airports  customer (+ nation, region): the catalog table of airport rows;
          state = nation name, country = region name, latitude = c_acctbal.
corpus    documents: (doc, text).
posts     documents ⋈ labels: label = quality, sensitive = toxic.
ratings   lineitem ⋈ orders: userId = o_custkey, movieId = l_partkey,
          rating = ceil(l_quantity / 10) in 1..5.
movies    part: movieId = p_partkey, title = p_name, genres = words of p_type.
vectors   embeddings: 64-dimensional features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.tables import Tables

MISSING = -1


def _int(c) -> F.Column:
    return c.cast("int")


def flight_rows(t: Tables, lineitem: DataFrame | None = None, supplier: DataFrame | None = None,
                dealt: int = 0) -> DataFrame:
    """Flights with their line-item keys (``l_orderkey``, ``l_linenumber``).

    ``lineitem`` may be given instead of the table, for example a stream of
    line items joined with the static dimensions, and ``supplier`` likewise. Orders of the
    whole table meet their customers first, so line items are never moved by customer. With ``dealt``
    both are dealt by order key into so many partitions, whatever the session's number."""
    li = t.lineitem if lineitem is None else lineitem
    o, c, s = t.orders, t.customer, t.supplier if supplier is None else supplier
    if lineitem is not None:
        j = (li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, o["o_custkey"] == c["c_custkey"])
             .join(s, li["l_suppkey"] == s["s_suppkey"]))
        return _flight_fields(j)
    oc = o.join(c, o["o_custkey"] == c["c_custkey"])
    if dealt:
        li, oc = li.repartition(dealt, "l_orderkey"), oc.repartition(dealt, "o_orderkey")
    j = (li.join(oc, li["l_orderkey"] == oc["o_orderkey"])
           .join(s, li["l_suppkey"] == s["s_suppkey"]))
    return _flight_fields(j)


def _flight_fields(j: DataFrame) -> DataFrame:
    return j.select(
        *_line_fields(), F.col("c_mktsegment").alias("uniqueCarrier"),
        F.col("s_nationkey").cast("string").alias("origin"),
        F.col("c_nationkey").cast("string").alias("dest"))


def _line_fields() -> list[F.Column]:
    """The flight fields that come from the line item alone."""
    d = F.col("l_shipdate")
    miss = F.lit(MISSING).cast("int")
    canceled = F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("int")
    return [
        F.col("l_orderkey"), F.col("l_linenumber"), d,
        F.struct(F.year(d).alias("year"), F.month(d).alias("month"),
                 F.dayofmonth(d).alias("dayOfMonth"),
                 (F.weekday(d) + 1).alias("dayOfWeek")).alias("date"),
        F.struct(miss.alias("depTime"), miss.alias("crsDepTime"), miss.alias("arrTime"),
                 miss.alias("crsArrTime"),
                 _int(F.col("l_quantity")).alias("actualElapsedTime"),
                 miss.alias("crsElapsedTime"), miss.alias("airTime"), miss.alias("arrDelay"),
                 miss.alias("depDelay"), miss.alias("taxiIn"), miss.alias("taxiOut")).alias("times"),
        F.col("l_linenumber").alias("flightNum"),
        F.concat(F.lit("N"), F.col("l_partkey").cast("string")).alias("tailNum"),
        _int(F.floor(F.col("l_extendedprice"))).alias("distance"),
        canceled.alias("canceled"),
        F.when(canceled == 1, F.col("l_returnflag")).otherwise(F.lit("")).alias("cancellationCode"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).cast("int").alias("diverted"),
        miss.alias("carrierDelay"),
        _int(F.round(F.col("l_discount") * 100)).alias("weatherDelay"),
        _int(F.round(F.col("l_tax") * 100)).alias("nasDelay"),
        miss.alias("securityDelay"),
        miss.alias("lateAircraftDelay"),
    ]


def line_flights(t: Tables, lineitem: DataFrame | None = None) -> DataFrame:
    """Flights without their end points and carrier: every line item has its order,
    customer and supplier, so these fields need no other table."""
    return (t.lineitem if lineitem is None else lineitem).select(*_line_fields())


FLIGHT_COLUMNS = ["date", "times", "uniqueCarrier", "flightNum", "tailNum", "origin", "dest",
                  "distance", "canceled", "cancellationCode", "diverted", "carrierDelay",
                  "weatherDelay", "nasDelay", "securityDelay", "lateAircraftDelay"]


def flights(t: Tables, lineitem: DataFrame | None = None) -> DataFrame:
    """The 16-column flight record."""
    return flight_rows(t, lineitem).select(*FLIGHT_COLUMNS)


def route_airports(t: Tables) -> DataFrame:
    """(iata, airport, country): one row per nation, the route endpoints."""
    n, r = t.nation, t.region
    return (n.join(r, n["n_regionkey"] == r["r_regionkey"])
            .select(F.col("n_nationkey").cast("string").alias("iata"),
                    F.col("n_name").alias("airport"), F.col("r_name").alias("country")))


def airports(t: Tables) -> DataFrame:
    """The airport catalog table, one row per customer (grows with the data)."""
    c, n, r = t.customer, t.nation, t.region
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"])
            .join(r, n["n_regionkey"] == r["r_regionkey"])
            .select(F.col("c_custkey").cast("string").alias("iata"),
                    F.col("c_name").alias("airport"), F.col("c_mktsegment").alias("city"),
                    F.col("n_name").alias("state"), F.col("r_name").alias("country"),
                    F.col("c_acctbal").alias("lat"),
                    F.col("c_nationkey").cast("double").alias("long")))


def corpus(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").cast("string").alias("doc"), "text")


def posts(t: Tables, documents: DataFrame | None = None) -> DataFrame:
    d = t.documents if documents is None else documents
    lab = t.labels
    return (d.join(lab, "doc_id")
            .select("doc_id", F.col("source").alias("user"), "lang",
                    (F.col("toxic") == 1).alias("sensitive"), "text",
                    F.col("quality").cast("double").alias("label")))


def ratings(t: Tables) -> DataFrame:
    li, o = t.lineitem, t.orders
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"])
            .select(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"),
                    F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating")))


def movies(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("movieId"),
                         F.col("p_name").alias("title"),
                         F.split(F.col("p_type"), " ").alias("genres"))


def vectors(t: Tables) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return t.embeddings.select("vec_id", array_to_vector("embedding").alias("features"), "label")
