"""Streams and sinks over the driver's tables: per-batch value counts, the
partitioned flight ETL, post scoring, and a Parquet round trip. The streaming
queries read the tables as file streams (``availableNow``), write to the
shared folder, and return what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import streaming as st
from tessera.fixed_values import ETL_PARTITION_FORMATS
from tessera.operators import catalog, compaction, ml, relational as rel, sinks
from tessera.plans import standins as si
from tessera.plans.oracle_sql import FLIGHTS_CTE, with_
from tessera.plans.q_ml import HASHED_SQL, NB_BUCKETS, POST_KEYWORDS, _sql_contains_any
from tessera.plans.registry import query
from tessera.session import shared_dir
from tessera.sources.tables import Tables, is_folder, read_table, table_path


def number_line():
    """The numbers stream stand-in: ``"<user_id> <event_type>"`` per event;
    the second token is not a number and counts as a reject."""
    return F.format_string("%d %s", "user_id", "event_type").alias("value")


def number_lines(events):
    return events.select(number_line())


VALUE_COUNTS_SQL = """
SELECT TRY_CAST(t AS INTEGER) AS n, COUNT(*) AS count FROM (
  SELECT unnest(string_split_regex(trim(CAST(user_id AS VARCHAR) || ' ' || event_type), '\\s+')) AS t
  FROM events)
GROUP BY 1"""


@query("value_counts", VALUE_COUNTS_SQL)
def value_counts(spark, sf_dir):
    """Count of each number in the lines; non-numbers grouped under null."""
    nums = st.parse_numbers(number_lines(Tables(spark, sf_dir).events))
    return nums.groupBy(F.when(F.col("ok"), F.col("n")).alias("n")).agg(F.count(F.lit(1)).alias("count"))


STREAM_BATCH_BYTES = 1 << 30


def _stream_table(spark, sf_dir, name):
    """A table as a stream of its files. A table that is a folder is streamed as that folder;
    one that is a file has to be chosen by name from its parent, as a stream takes folders
    only. A batch has files of ``STREAM_BATCH_BYTES``, one at least."""
    schema, path = read_table(spark, sf_dir, name).schema, table_path(sf_dir, name)
    folder = is_folder(spark, path)
    return st.file_stream(spark, path if folder else sf_dir, "parquet", schema=schema,
                          glob=None if folder else f"{name}.parquet", maxBytesPerTrigger=STREAM_BATCH_BYTES)


@query("stream_value_counts", VALUE_COUNTS_SQL)
def stream_value_counts(spark, sf_dir):
    """Per-batch counts from a stream of the events table, summed over batches."""
    out, ck = shared_dir(spark, "value-counts"), shared_dir(spark, "value-counts-ck")
    nums = st.parse_numbers(number_lines(_stream_table(spark, sf_dir, "events")))
    st.run_available(st.per_batch_value_counts(nums, out, ck, {"availableNow": True}))
    return (spark.read.parquet(out).groupBy("n")
            .agg(F.sum("count").cast("long").alias("count")))


COUNT_BATCHES = 3

BATCH_COUNTS_SQL = f"""
SELECT batch_id, TRY_CAST(t AS INTEGER) AS n, COUNT(*) AS count FROM (
  SELECT user_id % {COUNT_BATCHES} AS batch_id,
         unnest(string_split_regex(trim(CAST(user_id AS VARCHAR) || ' ' || event_type), '\\s+')) AS t
  FROM events)
GROUP BY 1, 2"""


def _counted_batches(spark, sf_dir, wrap=lambda write: write, max_restarts=0):
    """The lines of the events in three batches by user, counted batch by batch;
    returns the path of the counts and the batches that failed."""
    src, out, ck = (shared_dir(spark, n) for n in ("batches-in", "batch-counts", "batch-counts-ck"))
    events = Tables(spark, sf_dir).events
    lines = events.select("user_id", number_line())
    failed = st.run_batches(lines, wrap(st.value_counts_writer(out)), src, ck, F.col("user_id") % COUNT_BATCHES,
                            COUNT_BATCHES, transform=st.parse_numbers, max_restarts=max_restarts)
    return out, failed


@query("stream_batch_counts", BATCH_COUNTS_SQL)
def stream_batch_counts(spark, sf_dir):
    """(batch_id, n, count) of three micro-batches (STM-1, STM-2)."""
    return spark.read.parquet(_counted_batches(spark, sf_dir)[0]).select(F.col("batch_id").cast("long").alias("batch_id"), "n", "count")


def _half_then_fail(batch_ids):
    """Make a writer fail once in each of the given batches, after it has written the
    half of the batch's rows."""
    todo = set(batch_ids)

    def wrap(write):
        def first_half(batch, batch_id):
            if batch_id in todo:
                todo.discard(batch_id)
                write(batch.where(F.pmod(F.xxhash64(*batch.columns), F.lit(2)) == 0), batch_id)
                raise RuntimeError(f"batch {batch_id} fails after half of its rows")
            write(batch, batch_id)

        return first_half

    return wrap


@query("stream_recovered_counts", BATCH_COUNTS_SQL.replace("SELECT batch_id,", "SELECT batch_id, batch_id >= 1 AS had_failed,", 1))
def stream_recovered_counts(spark, sf_dir):
    """The same after failures: the second and the third batch write half of their rows and
    fail, and the stream is started again from its checkpoint (STM-3, STM-5, STM-8).
    Every row is counted once, as in a run without failures."""
    out, failed = _counted_batches(spark, sf_dir, _half_then_fail([1, 2]), max_restarts=2)
    return spark.read.parquet(out).select(F.col("batch_id").cast("long").alias("batch_id"), F.col("batch_id").isin(failed).alias("had_failed"), "n", "count")


@query("stream_nb_predictions", HASHED_SQL + f"""
SELECT CAST(d.doc % {COUNT_BATCHES} AS BIGINT) AS batch_id, d.doc AS doc_id, d.label, best.prediction
FROM d JOIN best ON d.doc = best.doc""")
def stream_nb_predictions(spark, sf_dir):
    """Labelled documents arrive in three batches and are scored by the hashed Naive
    Bayes model trained in batch, the second batch failing once (ML-12, STM-7):
    the predictions, equal to those of the batch query."""
    src, out, ck = (shared_dir(spark, n) for n in ("posts-in", "nb-scores", "nb-scores-ck"))
    p = si.posts(Tables(spark, sf_dir)).select("doc_id", "text", "label")
    model = ml.fit_nb_terms(ml.count_terms(p, buckets=NB_BUCKETS), NB_BUCKETS)
    st.run_batches(p, _half_then_fail([1])(st.nb_scores_writer(model, out, NB_BUCKETS)), src, ck,
                   F.col("doc_id") % COUNT_BATCHES, COUNT_BATCHES, max_restarts=1)
    return spark.read.parquet(out).select(F.col("batch_id").cast("long").alias("batch_id"), F.col("doc").alias("doc_id"), "label", "prediction")


ETL_COUNTS_SQL = with_(FLIGHTS_CTE) + """
SELECT strftime(l_shipdate, '%Y') AS depYear, strftime(l_shipdate, '%m') AS depMonth,
       strftime(l_shipdate, '%d') AS depDay, COUNT(*) AS count
FROM flights GROUP BY ALL"""


@query("etl_partition_counts", ETL_COUNTS_SQL)
def etl_partition_counts(spark, sf_dir):
    """Rows per date partition of the flight ETL (batch form). Counted by the
    integer date fields; only the counted rows are formatted."""
    f = si.line_flights(Tables(spark, sf_dir))
    counts = f.groupBy(F.col("date.year").alias("y"), F.col("date.month").alias("m"),
                       F.col("date.dayOfMonth").alias("d")).count()
    fy, fm, fd = ETL_PARTITION_FORMATS
    return counts.select(F.format_string(fy, "y").alias("depYear"),
                         F.format_string(fm, "m").alias("depMonth"),
                         F.format_string(fd, "d").alias("depDay"), "count")


ETL_BATCHES = 2


def _etl_table(spark, sf_dir, fail=()) -> str:
    """Line items arrive as a stream in two batches by order key, are joined with the static
    orders, customers and suppliers, and are written per date, batch by batch;
    returns the name of the partitioned table over the output."""
    t = Tables(spark, sf_dir)
    src, out, ck = (shared_dir(spark, n) for n in ("flights-in", "flights-etl", "flights-etl-ck"))
    lines = t.lineitem
    table = "flights_" + out.rsplit("-", 1)[-1]
    st.create_etl_table(spark, table, out)
    failed = st.run_batches(lines, _half_then_fail(fail)(st.etl_writer(out, table=table)), src, ck,
                            F.col("l_orderkey") % ETL_BATCHES, ETL_BATCHES,
                            transform=lambda stream: si.flights(t, lineitem=stream), max_restarts=len(fail))
    if sorted(failed) != sorted(fail):
        raise RuntimeError(f"batches that failed: {failed}")
    return table


@query("stream_etl_partition_counts", ETL_COUNTS_SQL)
def stream_etl_partition_counts(spark, sf_dir):
    """Rows per date of the ETL table."""
    return spark.table(_etl_table(spark, sf_dir)).groupBy("depYear", "depMonth", "depDay").count()


@query("etl_table_partitions", with_(FLIGHTS_CTE) + """
SELECT DISTINCT strftime(l_shipdate, '%Y') AS depYear, strftime(l_shipdate, '%m') AS depMonth, strftime(l_shipdate, '%d') AS depDay FROM flights""")
def etl_table_partitions(spark, sf_dir):
    """The dates among the partitions that the ETL's batches have added to its table."""
    parts = catalog.show_partitions(spark, _etl_table(spark, sf_dir))
    field = lambda n: F.regexp_extract("partition", f"{n}=([^/]*)", 1).alias(n)
    return parts.select(field("depYear"), field("depMonth"), field("depDay")).distinct()


ETL_ROWS_SQL = with_(FLIGHTS_CTE) + """
SELECT times.depTime AS depTime, times.arrTime AS arrTime, uniqueCarrier, CAST(flightNum AS INTEGER) AS flightNum, origin, dest,
       strftime(l_shipdate, '%Y') AS depYear, strftime(l_shipdate, '%m') AS depMonth, strftime(l_shipdate, '%d') AS depDay
FROM flights"""


@query("etl_table_rows", ETL_ROWS_SQL)
def etl_table_rows(spark, sf_dir):
    """All fields of all rows of the ETL table, read back through the catalog."""
    return spark.table(_etl_table(spark, sf_dir)).select(*sinks.ETL_COLUMNS, *sinks.DATE_COLS)


@query("etl_recovered_rows", ETL_ROWS_SQL)
def etl_recovered_rows(spark, sf_dir):
    """The ETL table after its second batch wrote half of its rows, failed and was run
    again from the checkpoint (STM-3, STM-8): each row once."""
    return spark.table(_etl_table(spark, sf_dir, fail=(1,))).select(*sinks.ETL_COLUMNS, *sinks.DATE_COLS)


@query("etl_compacted_rows", ETL_ROWS_SQL.replace("FROM flights", ", CAST(1 AS BIGINT) AS date_files FROM flights"))
def etl_compacted_rows(spark, sf_dir):
    """The ETL's rows after its two batches were compacted, read through the view, with the
    number of files that hold the row's date: one, as no date fills a second
    (``sinks.ROWS_PER_FILE`` rows); before, each date has a file per batch."""
    table, out = _etl_table(spark, sf_dir), shared_dir(spark, "flights-compacted")
    view = table + "_all"
    compaction.compact(spark, table, view, out, ETL_BATCHES - 1)
    rows = spark.table(view).withColumn("file", F.input_file_name())
    files = rows.groupBy(*sinks.DATE_COLS).agg(F.countDistinct("file").alias("date_files"))
    return rows.drop("file").join(files, sinks.DATE_COLS).select(*sinks.ETL_COLUMNS, *sinks.DATE_COLS, "date_files")


@query("etl_batch_rows", ETL_ROWS_SQL)
def etl_batch_rows(spark, sf_dir):
    """The same in batch form: written by date in one job and read back (SNK-4, PRJ-8)."""
    path = shared_dir(spark, "flights-by-date")
    sinks.write_by_date(si.flights(Tables(spark, sf_dir)), path)
    return sinks.read_by_date(spark, path).select(*sinks.ETL_COLUMNS, *sinks.DATE_COLS)


ETL_DAY = (1996, 3, 15)


@query("flights_of_day", with_(FLIGHTS_CTE) + f"""
SELECT l_orderkey, l_linenumber, origin, dest, distance FROM flights
WHERE "date".year = {ETL_DAY[0]} AND "date".month = {ETL_DAY[1]} AND "date".dayOfMonth = {ETL_DAY[2]}""")
def flights_of_day(spark, sf_dir):
    """One day's flights by equality on the three nested date fields (FLT-5)."""
    f = si.flight_rows(Tables(spark, sf_dir))
    return rel.on_date(f, *ETL_DAY).select("l_orderkey", "l_linenumber", "origin", "dest", "distance")


@query("stream_post_scores", f"""
SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS label, d.text, TRUE AS known_label
FROM documents d JOIN labels l USING (doc_id)
WHERE d.lang = 'en' AND l.toxic = 0 AND {_sql_contains_any('d.text', POST_KEYWORDS)}""")
def stream_post_scores(spark, sf_dir):
    """Posts arrive as a stream of documents joined with the static labels,
    are filtered and scored by a Naive Bayes model trained in batch; whether each
    prediction is one of the labels."""
    t = Tables(spark, sf_dir)
    model, labels = ml.fit_nb_hashed(si.posts(t), "text", "label")
    posts = si.posts(t, documents=_stream_table(spark, sf_dir, "documents"))
    scored = st.score_posts(posts, model, labels, POST_KEYWORDS).select("doc_id", "label", "prediction", "text")
    out, ck = shared_dir(spark, "post-scores"), shared_dir(spark, "post-scores-ck")
    q = (scored.writeStream.format("parquet").option("checkpointLocation", ck)
         .trigger(availableNow=True).start(out))
    st.run_available(q)
    return spark.read.parquet(out).select("doc_id", "label", "text", F.col("prediction").isin(labels).alias("known_label"))


ROUNDTRIP_N = 100


@query("parquet_roundtrip", f"""
SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS description FROM supplier
ORDER BY code LIMIT {ROUNDTRIP_N}""")
def parquet_roundtrip(spark, sf_dir):
    """The first 100 carriers (suppliers) by code, written as Parquet and read back."""
    carriers = Tables(spark, sf_dir).supplier.select(
        F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("description"))
    return sinks.parquet_roundtrip(carriers, shared_dir(spark, "carriers"), ROUNDTRIP_N, ["code"])


@query("parquet_roundtrip_customers", f"""
SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS description FROM customer
ORDER BY code LIMIT {ROUNDTRIP_N}""")
def parquet_roundtrip_customers(spark, sf_dir):
    """The same of the customers, of whom there are more than 100 at any size (LIM-1, SNK-3)."""
    customers = Tables(spark, sf_dir).customer.select(
        F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("description"))
    return sinks.parquet_roundtrip(customers, shared_dir(spark, "customers"), ROUNDTRIP_N, ["code"])


# ---------------------------------------------------------------- file sources over written tables

@query("text_file_word_count", """
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest(CASE WHEN lower(line) = '' THEN [''] WHEN regexp_full_match(lower(line), '(?:\\W+)+')
                THEN []::VARCHAR[] ELSE string_split_regex(regexp_replace(lower(line), '(?:\\W+)+$', ''), '\\W+') END) AS word
  FROM (SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[] ELSE string_split_regex(
          regexp_replace(text, '(\\r\\n|\\n|\\r)\\z', ''), '\\r\\n|\\n|\\r') END) AS line FROM documents))
GROUP BY word""")
def text_file_word_count(spark, sf_dir):
    """The corpus written as text files, read back line by line (SRC-1) and
    word-counted: equal to the word count over the documents' lines (a
    document ending in a line break would add one empty line)."""
    from tessera.operators import text as tx
    from tessera.sources.files import read_lines
    path = shared_dir(spark, "corpus-text")
    Tables(spark, sf_dir).documents.select("text").write.text(path)
    return tx.word_count(read_lines(spark, path), "value")


@query("csv_header_roundtrip", """
SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def csv_header_roundtrip(spark, sf_dir):
    """Suppliers written as CSV with a header and read back with inferred
    types (SRC-3)."""
    from tessera.sources.files import read_csv
    path = shared_dir(spark, "supplier-csv")
    Tables(spark, sf_dir).supplier.write.option("header", True).csv(path)
    df = read_csv(spark, path, header=True, infer=True)
    return df.select(F.col("s_suppkey").cast("int").alias("s_suppkey"), "s_name",
                     F.col("s_nationkey").cast("int").alias("s_nationkey"),
                     F.col("s_acctbal").cast("double").alias("s_acctbal"))


@query("csv_positional_roundtrip", """
SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation""")
def csv_positional_roundtrip(spark, sf_dir):
    """Nations written as CSV without a header, read back with inferred types
    and named by position (SRC-4)."""
    from tessera.sources.files import read_csv
    path = shared_dir(spark, "nation-csv")
    Tables(spark, sf_dir).nation.write.csv(path)
    return read_csv(spark, path, header=False, infer=True, names=["key", "name", "region"])


@query("json_roundtrip", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def json_roundtrip(spark, sf_dir):
    """Customers written as JSON lines and read back with an inferred schema
    and corrupt-record handling (SRC-5/6); the good rows, in table types."""
    from tessera.sources.files import read_json_lines, split_corrupt
    path = shared_dir(spark, "customer-json")
    Tables(spark, sf_dir).customer.write.json(path)
    good, _bad = split_corrupt(read_json_lines(spark, path))
    return good.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name",
                       F.col("c_nationkey").cast("int").alias("c_nationkey"),
                       F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment")


@query("json_rejects", """
SELECT c_custkey % 17 = 0 AS rejected, COUNT(*) AS count, CAST(SUM(CASE WHEN c_custkey % 17 = 0 THEN 0 ELSE c_custkey END) AS BIGINT) AS keys
FROM customer GROUP BY 1""")
def json_rejects(spark, sf_dir):
    """Customers as JSON lines of which every 17th is cut off, read with an explicit
    schema (no inference pass): good and rejected lines apart (SRC-5, SRC-6, FLT-4)."""
    from tessera.sources.files import read_json_lines, split_corrupt
    path = shared_dir(spark, "customer-json-bad")
    c = Tables(spark, sf_dir).customer
    line = F.to_json(F.struct("c_custkey", "c_name", "c_acctbal"))
    cut = F.when(F.col("c_custkey") % 17 == 0, F.expr("substring(j, 1, length(j) - 5)")).otherwise(F.col("j"))
    c.select("c_custkey", line.alias("j")).select(cut.alias("value")).write.text(path)
    schema = c.select("c_custkey", "c_name", "c_acctbal").schema
    good, bad = split_corrupt(read_json_lines(spark, path, schema))
    tally = lambda d, r, k: d.groupBy(F.lit(r).alias("rejected")).agg(
        F.count(F.lit(1)).alias("count"), F.coalesce(F.sum(k), F.lit(0)).cast("long").alias("keys"))
    return tally(good, False, F.col("c_custkey")).unionByName(tally(bad, True, F.lit(0)))
