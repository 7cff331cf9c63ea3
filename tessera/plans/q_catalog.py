"""Catalog statements, ordering by clock times with the first rows on the driver, and chosen
pairs scored by ALS, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.dates import order_by_times
from tessera.operators import catalog, ml, sinks
from tessera.plans import standins as si
from tessera.plans.oracle_sql import AIRPORTS_CTE, with_
from tessera.plans.q_ml import ALS_SEED, ALS_SQL, _in_test
from tessera.plans.registry import query
from tessera.session import shared_dir, shuffles_removed
from tessera.sources.tables import Tables

AIRPORT_COLUMNS = {"iata": "string", "airport": "string", "city": "string", "state": "string",
                   "country": "string", "lat": "double", "long": "double"}


def _airport_table(spark, sf_dir) -> str:
    """An external table over the airports written as delimited files (CAT-1)."""
    path = shared_dir(spark, "airports-csv")
    si.airports(Tables(spark, sf_dir)).select(*AIRPORT_COLUMNS).write.option("sep", "|").csv(path)
    name = "airports_" + path.rsplit("-", 1)[-1]
    columns = ", ".join(f"{c} {t.upper()}" for c, t in AIRPORT_COLUMNS.items())
    for _ in range(2):  # the second finds it and does nothing
        catalog.create_external_table(spark, name, columns, path, options={"sep": "|"})
    return name


@query("catalog_columns", with_(AIRPORTS_CTE) + " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, '{t}' AS data_type, COUNT({c}) AS n, COUNT(DISTINCT {c}) AS n_distinct FROM airports"
    for c, t in AIRPORT_COLUMNS.items()))
def catalog_columns(spark, sf_dir):
    """What DESCRIBE says of each column of the external table (CAT-6), with the values
    counted through the table; the table must be among those of SHOW TABLES (CAT-5)."""
    name = _airport_table(spark, sf_dir)
    if catalog.show_tables(spark).where(F.col("tableName") == name).count() != 1:
        raise RuntimeError(f"{name} is not listed")
    # distinct values first, per column, by partial aggregates: a value is moved once a task
    cells = spark.table(name).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(c).cast("string").alias("v")) for c in AIRPORT_COLUMNS])).alias("x")).select("x.*")
    sizes = cells.groupBy("col_name", "v").count().groupBy("col_name").agg(
        F.sum(F.when(F.col("v").isNotNull(), F.col("count")).otherwise(0)).alias("n"), F.count("v").alias("n_distinct"))
    return catalog.describe(spark, name).select("col_name", "data_type").join(sizes, "col_name").select(
        "col_name", "data_type", "n", "n_distinct")


@query("catalog_dropped_table", with_(AIRPORTS_CTE) + """
SELECT country, state, COUNT(*) AS count FROM airports GROUP BY country, state""")
def catalog_dropped_table(spark, sf_dir):
    """Airports counted by SQL through a table that was dropped and created again
    over the same files, which dropping leaves in place (CAT-7)."""
    name = _airport_table(spark, sf_dir)
    path = spark.table(name).inputFiles()[0].rsplit("/", 1)[0]
    catalog.drop_table(spark, name)
    if spark.catalog.tableExists(name):
        raise RuntimeError(f"{name} is still there")
    columns = ", ".join(f"{c} {t.upper()}" for c, t in AIRPORT_COLUMNS.items())
    catalog.create_external_table(spark, name, columns, path, options={"sep": "|"})
    return spark.sql(f"SELECT country, state, COUNT(*) AS count FROM {name} GROUP BY country, state")


FIRST_TIMES = 20


@query("times_order", f"""
SELECT row_number() OVER (ORDER BY a, b, c, d) AS place, a AS depTime, b AS crsDepTime, c AS arrTime, d AS crsArrTime FROM (
  SELECT DISTINCT CAST(l_quantity AS INTEGER) % 24 * 100 AS a, l_linenumber AS b, CAST(l_suppkey % 24 * 100 AS INTEGER) AS c,
         CAST(l_orderkey % 60 AS INTEGER) AS d FROM lineitem)
ORDER BY place LIMIT {FIRST_TIMES}""")
def times_order(spark, sf_dir):
    """The first clock times (set by a rule on the line items) in the order of the four
    compared fields, with their places, brought to the driver (DAT-5, LIM-2, SNK-8)."""
    times = Tables(spark, sf_dir).lineitem.select(F.struct(
        (F.col("l_quantity").cast("int") % 24 * 100).alias("depTime"), F.col("l_linenumber").alias("crsDepTime"),
        (F.col("l_suppkey") % 24 * 100).cast("int").alias("arrTime"), (F.col("l_orderkey") % 60).cast("int").alias("crsArrTime")).alias("times"))
    first = sinks.head(order_by_times(times.distinct()), FIRST_TIMES)
    return spark.createDataFrame([(i + 1, *r["times"]) for i, r in enumerate(first)],
                                 "place long, depTime int, crsDepTime int, arrTime int, crsArrTime int")


PAIR_ITEMS = 4


@query("als_chosen_pairs", ALS_SQL + f"""
SELECT CAST(u AS INTEGER) AS userId, CAST(movieId AS INTEGER) AS movieId, known AS scored, TRUE AS as_factors
FROM (SELECT MIN(userId) AS u FROM train),
     (SELECT movieId, TRUE AS known FROM (SELECT DISTINCT movieId FROM train ORDER BY movieId LIMIT {PAIR_ITEMS})
      UNION ALL SELECT MAX(movieId) + 1, FALSE FROM pairs)""")
def als_chosen_pairs(spark, sf_dir):
    """One user with a few parts, and a part that nobody rated, scored by ALS (ML-4): whether
    there is a score, and whether it is the product of the pair's factors."""
    path = shared_dir(spark, "ratings-pairs")
    with shuffles_removed(spark):
        si.ratings(Tables(spark, sf_dir)).groupBy("userId", "movieId").agg(F.avg("rating").alias("rating")).write.parquet(path)
    pairs = spark.read.parquet(path)
    train = pairs.where(f"NOT {_in_test('userId', 'movieId')}")
    model = ml.fit_als(train, seed=ALS_SEED)
    user = train.agg(F.min("userId")).first()[0]
    items = [r["movieId"] for r in train.select("movieId").distinct().orderBy("movieId").limit(PAIR_ITEMS).collect()]
    items.append(pairs.agg(F.max("movieId")).first()[0] + 1)
    scored = ml.score_pairs(spark, model, [(user, i) for i in items])
    x = model.userFactors.select(F.col("id").alias("userId"), F.col("features").alias("x"))
    y = model.itemFactors.select(F.col("id").alias("movieId"), F.col("features").alias("y"))
    product = F.aggregate(F.zip_with("x", "y", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda a, b: a + b)
    return scored.join(x, "userId", "left").join(y, "movieId", "left").select(
        "userId", "movieId", (~F.isnan("prediction")).alias("scored"),
        F.coalesce(F.abs(F.col("prediction") - product) < 1e-4, F.isnan("prediction")).alias("as_factors"))
