"""Dense number ids for codes of any type.

Ids are places in the order of the distinct codes, from 0 and without gaps, so two
codes never share one and they fit 32 bits as long as the codes do. Codes are
range-sorted and stored with the task and the row of the sort; a task's first id
is the number of codes in the tasks before it. Null codes have no id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.joins import broadcast_if_small
from tessera.session import shared_dir

ROW_BITS = 33  # of monotonically_increasing_id, the row within its task


def dense_ids(codes: DataFrame, code: str, name: str = "id") -> DataFrame:
    """Rows (code, id): every distinct non-null value of ``code``, numbered in order.

    One shuffle makes the codes distinct and one sorts them by range. The table of
    first ids has a row per task."""
    spark = codes.sparkSession
    path = shared_dir(spark, "codes")
    (codes.select(F.col(code)).where(F.col(code).isNotNull()).distinct().sort(code)
     .withColumn("_at", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path) \
        .withColumn("_task", F.shiftright("_at", ROW_BITS)) \
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    tasks = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1))
    first = tasks.select("_task", F.coalesce(before, F.lit(0)).alias("_first"))
    return rows.join(broadcast_if_small(first), "_task") \
        .select(code, (F.col("_first") + F.col("_row")).alias(name))


def encode(df: DataFrame, ids: DataFrame, column: str, code: str, number: str, name: str = "id") -> DataFrame:
    """``df`` with the id of ``column`` as ``number``; rows without an id keep a null."""
    key = ids.select(F.col(code).alias("_code"), F.col(name).alias(number))
    return df.join(key, df[f"`{column}`"] == F.col("_code"), "left").drop("_code")


INT_IDS = 1 << 31


def encode_ratings(ratings: DataFrame, user: str = "userId", item: str = "movieId") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings with dense ids ``user_no`` and ``item_no`` that fit the 32 bits ALS takes,
    and the two dictionaries; users and items beyond 2^31 are an error."""
    users, items = dense_ids(ratings, user), dense_ids(ratings, item)
    top = max(d.agg(F.max("id")).first()[0] or 0 for d in (users, items))
    if top >= INT_IDS:
        raise ValueError(f"{top + 1} ids do not fit 32 bits")
    r = encode(encode(ratings, users, user, user, "user_no"), items, item, item, "item_no")
    return r.withColumn("user_no", F.col("user_no").cast("int")).withColumn("item_no", F.col("item_no").cast("int")), users, items
