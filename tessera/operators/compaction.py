"""Compaction of a partitioned ETL's files (STM-6, SNK-4).

A streaming ETL leaves a file per batch and date, and a table partitioned by batch
and date over them. ``compact`` merges the batches up to a given one into a
generation: a folder with ceil(rows / rows_per_file) files a date at most. Readers use a view,
the union of the newest generation and of the batches after it. Replacing the view is the
only step that readers see, and it is one statement of the catalog: they see all of a
generation or nothing of it.

A generation's folder and manifest (date, folder, rows) are named by the last batch
they hold, and the view carries that number as a property. A job that dies before it
replaces the view leaves files that nobody reads; run again, it overwrites them. A
generation that is published already is not made again. Dates without rows in the new
batches are not rewritten: the new generation's partitions point to the old folder.

Batches up to ``upto`` must be complete (committed in the stream's checkpoint). The
driver handles the partitions as the catalog does, one entry per date; rows stay in tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixed_values import ETL_SEPARATOR
from tessera.operators import catalog
from tessera.operators.joins import broadcast_if_small
from tessera.operators.sinks import DATE_COLS, ETL_COLUMNS, ETL_SCHEMA, ROWS_PER_FILE, dealt_by_date

UPTO = "compacted.upto"


def compacted_upto(spark: SparkSession, view: str) -> int | None:
    """The last batch in the generation that ``view`` shows; None before the first."""
    if not spark.catalog.tableExists(view):
        return None
    have = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {view}").collect()}
    return int(have[UPTO]) if UPTO in have else None


def generation_table(view: str, upto: int) -> str:
    return f"{view}_upto_{upto}"


def _manifest(spark: SparkSession, out_path: str, upto: int) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{out_path.rstrip('/')}/manifest={upto}")


_MANIFEST = ", ".join(f"{c} STRING" for c in DATE_COLS) + ", folder INT, n BIGINT"


def write_generation(spark: SparkSession, table: str, view: str, out_path: str, upto: int,
                     rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write the files and the manifest of the generation up to batch ``upto``."""
    last, out = compacted_upto(spark, view), out_path.rstrip("/")
    new = spark.table(table).where(F.col("batch") <= upto)
    if last is not None:
        new = new.where(F.col("batch") > last)
    rows, kept = new.select(*ETL_COLUMNS, *DATE_COLS), None
    if last is not None:
        parts = catalog.show_partitions(spark, table)
        field = lambda n: F.regexp_extract("partition", f"(?:^|/){n}=([^/]*)", 1)
        batch = field("batch").cast("int")
        touched = parts.where((batch > last) & (batch <= upto)).select(*[field(c).alias(c) for c in DATE_COLS]).distinct()
        before = _manifest(spark, out, last)
        kept = before.join(broadcast_if_small(touched), DATE_COLS, "left_anti")
        old = spark.table(generation_table(view, last)).select(*ETL_COLUMNS, *DATE_COLS)
        rows = rows.unionByName(old.join(broadcast_if_small(touched), DATE_COLS, "left_semi").select(*rows.columns))
    dealt, dates = dealt_by_date(rows, rows_per_file)
    dealt.write.mode("overwrite").option("sep", ETL_SEPARATOR).partitionBy(*DATE_COLS).csv(f"{out}/upto={upto}")
    manifest = dates.select(*DATE_COLS, F.lit(upto).alias("folder"), F.col("_n").alias("n"))
    if kept is not None:
        manifest = manifest.unionByName(kept)
    manifest.write.mode("overwrite").parquet(f"{out}/manifest={upto}")


def publish_generation(spark: SparkSession, table: str, view: str, out_path: str, upto: int) -> None:
    """Let ``view`` show the written generation and the batches after it."""
    out, name = out_path.rstrip("/"), generation_table(view, upto)
    catalog.drop_table(spark, name)  # of an attempt that was not published; files stay
    catalog.create_external_table(spark, name, ETL_SCHEMA, f"{out}/upto={upto}",
                                  options={"sep": ETL_SEPARATOR}, partitioned_by=DATE_COLS)
    entries = [(dict(zip(DATE_COLS, r)), r["folder"]) for r in _manifest(spark, out, upto).collect()]
    catalog.add_partitions(spark, name, [spec for spec, _ in entries], [
        f"{out}/upto={folder}/" + "/".join(f"{k}={v}" for k, v in spec.items()) for spec, folder in entries])
    columns = ", ".join(ETL_COLUMNS + DATE_COLS)
    spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('{UPTO}' = '{upto}') AS "
              f"SELECT {columns} FROM {name} UNION ALL SELECT {columns} FROM {table} WHERE batch > {upto}")


def compact(spark: SparkSession, table: str, view: str, out_path: str, upto: int,
            rows_per_file: int = ROWS_PER_FILE) -> bool:
    """Merge the batches of ``table`` up to ``upto`` into files of ``rows_per_file`` rows
    below ``out_path`` and let ``view`` show them; False if ``view`` holds them already."""
    last = compacted_upto(spark, view)
    if last is not None and last >= upto:
        return False
    write_generation(spark, table, view, out_path, upto, rows_per_file)
    publish_generation(spark, table, view, out_path, upto)
    return True


def retire(spark: SparkSession, table: str, view: str) -> int:
    """Take the batches that ``view`` has compacted out of the partitions of ``table``, so
    that its catalog entry stays small; returns how many partitions went. The files of
    this external table stay until their folders (``batch=<id>``) are deleted, which is safe once no reader holds an older view."""
    last = compacted_upto(spark, view)
    if last is None:
        return 0
    rows = catalog.show_partitions(spark, table).collect()
    specs = [dict(p.split("=", 1) for p in r["partition"].split("/")) for r in rows]
    specs = [s for s in specs if int(s["batch"]) <= last]
    catalog.drop_partitions(spark, table, specs)
    return len(specs)
