"""Sinks (SNK-1..8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.fixed_values import ETL_PARTITION_FORMATS, ETL_SEPARATOR
from tessera.functions.strings import tuple_string
from tessera.operators.joins import broadcast_if_small
from tessera.session import shared_dir


def write_tuples(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One ``(a,b,...)`` text line per row (SNK-1); ``overwrite`` replaces an
    earlier output (SNK-2)."""
    df.select(tuple_string(*df.columns).alias("value")).write.mode(mode).text(path)


def parquet_roundtrip(df: DataFrame, path: str, n: int = 100, order_by=None) -> DataFrame:
    """Write the first ``n`` rows (in ``order_by`` order, so they are fixed)
    as Parquet and read them back (SNK-3)."""
    head = df.orderBy(*order_by) if order_by else df
    head.limit(n).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def date_partitions(date_struct: str = "date") -> list:
    """Zero-padded ``depYear``, ``depMonth``, ``depDay`` strings."""
    d = F.col(date_struct)
    fy, fm, fd = ETL_PARTITION_FORMATS
    return [F.format_string(fy, d["year"]).alias("depYear"),
            F.format_string(fm, d["month"]).alias("depMonth"),
            F.format_string(fd, d["dayOfMonth"]).alias("depDay")]


ETL_COLUMNS = ["depTime", "arrTime", "uniqueCarrier", "flightNum", "origin", "dest"]
DATE_COLS = ["depYear", "depMonth", "depDay"]


def etl_rows(flights: DataFrame) -> DataFrame:
    """The ETL projection: six fields plus the three partition columns."""
    return flights.select(F.col("times.depTime").alias("depTime"),
                          F.col("times.arrTime").alias("arrTime"),
                          "uniqueCarrier", "flightNum", "origin", "dest", *date_partitions())


ROWS_PER_FILE = 1_000_000


def dealt_by_date(rows: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> tuple[DataFrame, DataFrame]:
    """(rows dealt out for a write by date, the dates with their file counts).

    A date gets ceil(rows / rows_per_file) files, each written by its own task: the
    rows of a hot date, equal rows included, are spread by a salt of their
    place in the input, and a quiet date is one file. The dates (one row each)
    are stored once. The partition count is explicit, a task per ``rows_per_file``
    rows: AQE would coalesce a small input into one task that writes every date."""
    spark = rows.sparkSession
    path = shared_dir(spark, "date-sizes")
    (rows.groupBy(*DATE_COLS).agg(F.count(F.lit(1)).alias("_n"))
     .select(*DATE_COLS, "_n", F.ceil(F.col("_n") / F.lit(rows_per_file)).cast("int").alias("_files"))
     .write.parquet(path))
    dates = spark.read.parquet(path)
    total = dates.agg(F.sum("_n")).first()[0] or 0
    n = max(spark.sparkContext.defaultParallelism, -(-total // rows_per_file))
    dealt = (rows.withColumn("_place", F.xxhash64(F.monotonically_increasing_id()))
             .join(broadcast_if_small(dates.drop("_n")), DATE_COLS)
             .withColumn("_salt", F.pmod("_place", "_files"))
             .repartition(n, *DATE_COLS, "_salt").drop("_files", "_place", "_salt"))
    return dealt, dates


def write_by_date(flights: DataFrame, path: str, mode: str = "append", rows_per_file: int = ROWS_PER_FILE) -> None:
    """``|``-separated rows in one directory per date (SNK-4):
    ``depYear=YYYY/depMonth=MM/depDay=DD``. One job for all dates."""
    (dealt_by_date(etl_rows(flights), rows_per_file)[0]
     .write.mode(mode).option("sep", ETL_SEPARATOR).partitionBy(*DATE_COLS).csv(path))


ETL_SCHEMA = ("depTime INT, arrTime INT, uniqueCarrier STRING, flightNum INT, origin STRING, "
              "dest STRING, depYear STRING, depMonth STRING, depDay STRING")


def read_by_date(spark, path: str) -> DataFrame:
    """Read the ETL output back; the explicit schema keeps the partition
    values as zero-padded strings (a streamed output also has ``batch``)."""
    return spark.read.schema(ETL_SCHEMA).option("sep", ETL_SEPARATOR).csv(path)


def preview(df: DataFrame, n: int = 100, out=print, msg: str = "") -> None:
    """Print the row count and the first ``n`` rows (SNK-6)."""
    out(f"{msg} ({df.count()} rows)" if msg else f"{df.count()} rows")
    for r in df.limit(n).collect():
        out(str(r))


def show(df: DataFrame, n: int = 20, truncate: bool = True) -> None:
    """SNK-7."""
    df.show(n, truncate=truncate)


def head(df: DataFrame, n: int) -> list:
    """First ``n`` rows to the driver (SNK-8, LIM-2); bounded by n."""
    return df.limit(n).collect()
