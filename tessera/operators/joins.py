"""Join helpers.

Broadcasting is only safe for a side whose size is bounded. ``broadcast_if_small``
measures the side's bytes first and otherwise leaves the choice to Catalyst and AQE, which compare measured
sizes with ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and fall back to a
sort-merge join (with skew splitting) beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import shared_dir

MAX_BROADCAST_BYTES = 32 << 20


def _width(field: T.StructField) -> Column:
    """Bytes of a value: 16 at most for those of fixed size, else its length; nested
    values count as their JSON text."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return F.lit(16)


def bytes_at_most(df: DataFrame, max_bytes: int) -> bool:
    """Whether the rows of ``df``, as the lengths of their values plus a row's overhead,
    come to at most ``max_bytes``. One aggregate over ``df``, which reads the columns of
    variable size only: store a costly frame first."""
    size = sum((_width(f) for f in df.schema.fields), F.lit(64)).cast("long")
    return (df.agg(F.sum(size).alias("b")).first()["b"] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when df has at most ``max_bytes`` bytes, else df unchanged."""
    return F.broadcast(df) if bytes_at_most(df, max_bytes) else df


def anti_join_small(df: DataFrame, exclude: DataFrame, on: str) -> DataFrame:
    """Rows of df whose key is not in ``exclude``. The key set is stored once,
    measured, and broadcast if it is small; else the join is a shuffled one."""
    spark = df.sparkSession
    path = shared_dir(spark, "exclude")
    exclude.select(on).distinct().write.parquet(path)
    return df.join(broadcast_if_small(spark.read.parquet(path)), on, "left_anti")


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Store ``df`` as a catalog table bucketed (and sorted) by ``key`` under
    ``path`` on shared storage, and return it. Two tables bucketed the same
    way on their join key are joined without a shuffle of either side; for
    the flight stand-in that removes the largest exchange (line items with
    orders on the order key)."""
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


BUCKET_ROWS = 20_000_000
MAX_KEY_ROWS = 5_000_000


def buckets_for(rows: int, at_least: int = 8, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets of about ``bucket_rows`` rows, a power of two, so that tables of
    different sizes have counts that divide each other."""
    return max(at_least, 1 << max(0, -(-rows // bucket_rows) - 1).bit_length())


def heaviest_key(df: DataFrame, key: str) -> int:
    """The most rows that a value of ``key`` has, null not counted."""
    k = F.col(f"`{key}`")
    return df.where(k.isNotNull()).groupBy(k).count().agg(F.max("count")).first()[0] or 0


def store_for_joins(df: DataFrame, name: str, key: str, buckets: int, path: str, partition_by=(),
                    heaviest: int | None = None, max_key_rows: int = MAX_KEY_ROWS) -> DataFrame:
    """Store ``df`` once as the table ``name``, partitioned by ``partition_by`` and
    bucketed by ``key``: a filter on a partition column reads its folders only, and a
    join or an aggregate on the key with a table of as many buckets moves no row.

    Rows are dealt out by bucket first, so that a bucket is one file a partition (rows that
    come dealt by the key into as many partitions are not moved again).
    All rows of a key are in one bucket. A key with more than ``max_key_rows`` rows (null not
    counted: it joins with nothing) would make one long task of every join, so the table is then stored
    without buckets and Spark shuffles it, splitting the hot key where it can. ``heaviest``
    is the rows of the heaviest key, if known from a cheaper frame."""
    if (heaviest_key(df, key) if heaviest is None else heaviest) > max_key_rows:
        writer = df.write
    else:
        writer = df.repartition(buckets, F.col(f"`{key}`")).write.bucketBy(buckets, key).sortBy(key)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


#: text of a partition of ``dealt_by_document``
DOCUMENT_PART_BYTES = 32 << 20


def dealt_by_document(docs: DataFrame, doc: str, text: str, part_bytes: int = DOCUMENT_PART_BYTES) -> DataFrame:
    """``docs`` dealt by ``doc`` into partitions of about ``part_bytes`` of text. The tokens
    cut from them are then counted per document where they are: texts move, which
    are several times smaller than their tokens with keys, and a task's table of counts has the
    words of one partition, whatever the size of the input's files. One aggregate over
    the texts measures them."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, -(-size // part_bytes))
    return docs.repartition(n, doc)
