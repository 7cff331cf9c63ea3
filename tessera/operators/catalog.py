"""Catalog tables (CAT-1..7) with Spark's own DDL. Works on the in-memory
catalog; ``ROW FORMAT`` DDL would need Hive support, so delimited tables are
declared ``USING csv`` with a separator option."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _opts(options: dict) -> str:
    if not options:
        return ""
    body = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
    return f"OPTIONS ({body})"


def create_external_table(spark: SparkSession, name: str, columns: str, location: str,
                          fmt: str = "csv", options: dict | None = None,
                          partitioned_by: list[str] | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS over existing files (CAT-1/2). Dropping it
    leaves the files in place."""
    part = f"PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} "
              f"{_opts(options or {})} {part} LOCATION '{location}'")


def add_partition(spark: SparkSession, name: str, spec: dict, location: str | None = None) -> None:
    """ALTER TABLE ... ADD IF NOT EXISTS PARTITION (CAT-3)."""
    body = ", ".join(f"{k}='{v}'" for k, v in spec.items())
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({body}){loc}")


def _spec(spec: dict) -> str:
    return "PARTITION (" + ", ".join(f"{k}='{v}'" for k, v in spec.items()) + ")"


def add_partitions(spark: SparkSession, name: str, specs: list[dict], locations: list[str] | None = None) -> None:
    """Add many partitions in one statement (CAT-3); those that are there stay.
    Without ``locations`` each is the usual directory below the table's."""
    if specs:
        at = [f" LOCATION '{x}'" for x in locations] if locations else [""] * len(specs)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(_spec(s) + x for s, x in zip(specs, at)))


def drop_partitions(spark: SparkSession, name: str, specs: list[dict]) -> None:
    """Drop many partitions in one statement; an external table's files stay."""
    if specs:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(map(_spec, specs)))


def recover_partitions(spark: SparkSession, name: str) -> None:
    """Register every partition directory found under the table location."""
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    """SHOW PARTITIONS (CAT-4); ``.count()`` gives how many."""
    return spark.sql(f"SHOW PARTITIONS {name}")


def show_tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def describe(spark: SparkSession, name: str, mode: str = "") -> DataFrame:
    """DESCRIBE [EXTENDED|FORMATTED] (CAT-6)."""
    mode = mode.upper()
    if mode not in ("", "EXTENDED", "FORMATTED"):
        raise ValueError(mode)
    return spark.sql(f"DESCRIBE {mode} {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
