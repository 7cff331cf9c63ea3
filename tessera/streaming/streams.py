"""Streaming pipelines.

Sources are file streams (the reference's sockets are replaced: a file
source is replayable, so a restarted query resumes from its checkpoint).
Sinks are either the file sink (exactly-once through its metadata log) or
``foreachBatch`` writing one partition per ``batch_id`` with dynamic
partition overwrite, so a replayed batch replaces its own output instead of
adding to it.
"""

from __future__ import annotations

import threading

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tessera.fixed_values import ETL_SEPARATOR, NUMBER_SEPARATOR
from tessera.functions.strings import contains_any, explode_split
from tessera.operators import catalog
from tessera.operators.sinks import DATE_COLS, ETL_SCHEMA, ROWS_PER_FILE, dealt_by_date, etl_rows


def file_stream(spark: SparkSession, path: str, fmt: str = "text", schema=None,
                glob: str | None = None, max_files_per_trigger: int | None = None,
                **options) -> DataFrame:
    """A stream of new files under ``path`` (SRC-19/20). ``fmt`` is any file
    format (text, json, csv, parquet); non-text formats need a schema."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def parse_numbers(lines: DataFrame, col: str = "value") -> DataFrame:
    """Whitespace-separated integers -> one row per number ``n``, plus
    ``ok``: tokens that are not integers are kept with ``ok = false`` so the
    caller can count them (the reference's job died on the first one)."""
    tok = explode_split(lines, F.trim(F.col(col)), NUMBER_SEPARATOR, alias="t", drop_empty=True)
    return tok.select(F.col("t").try_cast("int").alias("n"), F.col("t").try_cast("int").isNotNull().alias("ok"))


def per_batch_value_counts(numbers: DataFrame, out_path: str, checkpoint: str,
                           trigger: dict | None = None, col: str = "n") -> StreamingQuery:
    """Counts of each value within each micro-batch, no state carried between
    batches (STM-2). Output: ``(n, count, batch_id)`` partitioned by
    ``batch_id``, rejected tokens counted under a null ``n``; a replayed batch
    overwrites its own partition."""

    w = numbers.writeStream.foreachBatch(value_counts_writer(out_path, col)).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """Replace what batch ``batch_id`` has under ``path`` by ``rows``: a batch that is run
    again after a failure leaves nothing of its first attempt."""
    (rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def value_counts_writer(path: str, col: str = "n"):
    """The ``foreachBatch`` function of ``per_batch_value_counts``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(F.when(F.col("ok"), F.col(col)).alias("n")).agg(F.count(F.lit(1)).alias("count"))
        write_batch(counts, batch_id, path)

    return write


def nb_scores_writer(model: dict, path: str, buckets: int | None = None, doc: str = "doc_id", text: str = "text",
                     label: str = "label"):
    """A ``foreachBatch`` function that scores each batch with a Naive Bayes model trained
    in batch (``ml.fit_nb_terms``) and writes (doc, label, prediction) under ``path`` (STM-7, ML-12)."""
    from tessera.operators import ml

    def write(batch: DataFrame, batch_id: int) -> None:
        terms = ml.count_terms(batch, doc, text, label, buckets)
        write_batch(ml.predict_nb_terms(model, terms), batch_id, path)

    return write


def run_batches(rows: DataFrame, write, source: str, checkpoint: str, batch, batches: int, schema=None,
                transform=None, max_restarts: int = 0) -> list[int]:
    """Feed ``rows`` to ``write(batch, batch_id)`` in ``batches`` micro-batches whose rows are
    fixed by a rule: ``batch`` gives the number of a row's batch.

    Each batch's rows are appended to the folder ``source`` by as many tasks as Spark takes,
    and one run of the stream over the same ``checkpoint`` picks up exactly the new files. A
    run that fails is started again up to ``max_restarts`` times in all (STM-3, STM-8): the
    checkpoint has the batch's files, so the same rows come back under the same id.
    Returns the ids of the batches that failed."""
    spark = rows.sparkSession
    schema = schema or rows.schema
    failed: list[int] = []
    for b in range(batches):
        rows.where(batch == b).write.mode("append").parquet(source)
        while True:
            stream = file_stream(spark, source, "parquet", schema=schema)
            stream = transform(stream) if transform else stream
            q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
            try:
                run_available(q)
                break
            except (StreamingQueryException, RuntimeError):
                if len(failed) >= max_restarts:
                    raise
                failed.append(b)
    return failed


def write_etl_batch(rows: DataFrame, out_path: str, batch_id: int,
                    rows_per_file: int = ROWS_PER_FILE, table: str | None = None) -> None:
    """Write one batch of ETL rows under ``batch=/depYear=/depMonth=/depDay=``
    (``sinks.dealt_by_date`` spreads hot dates over tasks). Each batch writes
    below its own ``batch=<id>`` directory, so a replayed batch replaces exactly
    its own output. With ``table``, the batch's dates are added to that
    table's partitions (one row per date of the batch reaches the driver)."""
    rows = rows.persist()
    try:
        dealt, dates = dealt_by_date(rows, rows_per_file)
        (dealt.write.mode("overwrite").option("sep", ETL_SEPARATOR)
         .partitionBy(*DATE_COLS).csv(f"{out_path.rstrip('/')}/batch={batch_id}"))
        if table:
            catalog.add_partitions(rows.sparkSession, table, [
                {"batch": batch_id, **r.asDict()} for r in dates.select(*DATE_COLS).collect()])
    finally:
        rows.unpersist()


ETL_TABLE_COLUMNS = ETL_SCHEMA.replace("depYear", "batch INT, depYear", 1)


def create_etl_table(spark: SparkSession, table: str, out_path: str) -> None:
    """The external table over an ETL output, partitioned by batch and date."""
    catalog.create_external_table(spark, table, ETL_TABLE_COLUMNS, out_path, options={"sep": ETL_SEPARATOR},
                                  partitioned_by=["batch", *DATE_COLS])


def flight_etl(flights: DataFrame, out_path: str, checkpoint: str,
               trigger: dict | None = None, rows_per_file: int = ROWS_PER_FILE,
               table: str | None = None) -> StreamingQuery:
    """Streaming ETL (STM-6): parsed flights -> ``|``-separated rows in one
    directory per date. One write per micro-batch covers every date in it
    (the reference ran one job per date), and adds the dates to the partitions of
    ``table`` (see ``create_etl_table``)."""

    return (flights.writeStream.foreachBatch(etl_writer(out_path, rows_per_file, table)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def etl_writer(out_path: str, rows_per_file: int = ROWS_PER_FILE, table: str | None = None):
    """The ``foreachBatch`` function of ``flight_etl``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_etl_batch(etl_rows(batch), out_path, batch_id, rows_per_file, table)

    return write


def filter_posts(posts: DataFrame, keywords, lang: str = "en") -> DataFrame:
    """Posts in ``lang``, not marked sensitive, mentioning a keyword (FLT-8, SRC-20)."""
    return posts.where((F.col("lang") == lang) & ~F.col("sensitive")
                       & contains_any("text", keywords))


def score_posts(posts: DataFrame, model, labels, keywords, text: str = "text") -> DataFrame:
    """Filter a post stream and score it with a batch-trained hashed Naive
    Bayes model (STM-7, ML-12): ``(prediction, text)`` plus the input keys."""
    from tessera.operators.ml import predict_nb_hashed
    return predict_nb_hashed(model, labels, filter_posts(posts, keywords), text)


def run_available(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query to drain its input and stop; raise
    its error if it failed (STM-5, STM-8)."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def run_for(query: StreamingQuery, seconds: float) -> StreamingQuery:
    """Run for at most ``seconds``, then stop (STM-4)."""
    if not query.awaitTermination(seconds):
        query.stop()
    return query


class TerminationWatcher(StreamingQueryListener):
    """Records terminated queries and their errors (STM-5); register with
    ``spark.streams.addListener``."""

    def __init__(self):
        self.terminated = {}
        self.event = threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.terminated[str(event.id)] = event.exception
        self.event.set()
