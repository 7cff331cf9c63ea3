"""The driver's Parquet tables. Reads are lazy: Catalyst prunes the columns a
query does not use and pushes filters into the scan."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


# Tables whose per-row work is heavy (tokenizing text), with the key to spread
# them by. Light per-row work (the line-item joins) is cheaper unspread.
SPREAD_KEYS = {"documents": "doc_id"}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder, in whatever store holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


#: inputs over so many bytes are never spread
SPREAD_BYTES = 256 << 20


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-repartition a small scan by ``keys``: a file with one row group is read
    by one task. Only the planner's size estimate (the files' bytes) is
    looked at, and above ``SPREAD_BYTES`` the scan is returned as it is, so
    the shuffle it adds is at most that, on any cluster. The rows are the same
    either way. Filters and column pruning still reach the scan."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(size)) > SPREAD_BYTES:
        return df
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


class Tables:
    """Attribute access to the tables of one scale-factor folder: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            df = read_table(self.spark, self.sf_dir, name)
            if name in SPREAD_KEYS:
                df = spread(df, SPREAD_KEYS[name])
            return df
        raise AttributeError(name)

    def register_views(self, names=TABLES) -> None:
        for n in names:
            read_table(self.spark, self.sf_dir, n).createOrReplaceTempView(n)
