"""Streams on file sources with availableNow triggers and checkpoints."""

import os

from pyspark.sql import functions as F

from tessera import streaming as st
from tessera.operators import ml, sinks
from tessera.sources import parsers as P

from test_parsers import FLIGHTS


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_per_batch_counts_and_restart(spark, tmp):
    src, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    write(os.path.join(src, "a.txt"), "1 2 2\n\nx\n")
    lines = st.file_stream(spark, src, "text", max_files_per_trigger=1)
    q = st.per_batch_value_counts(st.parse_numbers(lines), out, ck, {"availableNow": True})
    st.run_available(q)
    got = {(r["batch_id"], r["n"]): r["count"] for r in spark.read.parquet(out).collect()}
    assert got == {(0, 1): 1, (0, 2): 2, (0, None): 1}
    # a new file and a restart on the same checkpoint: only the new rows are counted
    write(os.path.join(src, "b.txt"), "2 3\n")
    lines = st.file_stream(spark, src, "text", max_files_per_trigger=1)
    st.run_available(st.per_batch_value_counts(st.parse_numbers(lines), out, ck, {"availableNow": True}))
    got = {(r["batch_id"], r["n"]): r["count"] for r in spark.read.parquet(out).collect()}
    assert got[(1, 2)] == 1 and got[(1, 3)] == 1 and (1, 1) not in got


def test_flight_etl(spark, tmp):
    src, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    write(os.path.join(src, "f.csv"), "\n".join(FLIGHTS) + "\n")
    lines = st.file_stream(spark, src, "text")
    good, _ = P.parse_flights(lines)
    st.run_available(st.flight_etl(good, out, ck, {"availableNow": True}, rows_per_file=1))
    back = sinks.read_by_date(spark, out)
    parts = sorted((r["depYear"], r["depMonth"], r["depDay"], r["count"])
                   for r in back.groupBy("depYear", "depMonth", "depDay").count().collect())
    # the last fixture line ends in empty fields, so it is too short and rejected
    assert parts == [("2008", "01", "03", 1), ("2008", "01", "04", 1), ("2008", "01", "05", 1)]
    row = back.where(F.col("flightNum") == 335).first()
    assert (row["depTime"], row["origin"], row["dest"]) == (1003, "SEA", "LAX")
    raw = open(os.path.join(out, "batch=0", "depYear=2008", "depMonth=01", "depDay=03",
                            [f for f in os.listdir(os.path.join(out, "batch=0", "depYear=2008",
                                                                "depMonth=01", "depDay=03"))
                             if f.startswith("part-")][0])).read()
    assert raw.strip() == "1003|1211|AS|335|SEA|LAX"


def test_score_posts_stream(spark, tmp):
    train = spark.createDataFrame([("good great crash fix", 4.0), ("bad awful crash", 0.0)],
                                  "text string, label double")
    model, labels = ml.fit_nb_hashed(train, num_features=1 << 10)
    src = os.path.join(tmp, "posts")
    os.makedirs(src)
    write(os.path.join(src, "p.json"), "\n".join([
        '{"user": "a", "lang": "en", "sensitive": false, "text": "great crash fix"}',
        '{"user": "b", "lang": "fr", "sensitive": false, "text": "bad crash"}',
        '{"user": "c", "lang": "en", "sensitive": true, "text": "bad crash"}',
        '{"user": "d", "lang": "en", "sensitive": false, "text": "awful computer crash"}',
        '{"user": "e", "lang": "en", "sensitive": false, "text": "nothing here"}']) + "\n")
    posts = st.file_stream(spark, src, "json",
                           schema="user string, lang string, sensitive boolean, text string")
    scored = st.score_posts(posts, model, labels, ["programming", "computer", "crash"])
    q = (scored.select("prediction", "text").writeStream.format("memory").queryName("scored")
         .trigger(availableNow=True).start())
    st.run_available(q)
    got = {r["text"]: r["prediction"] for r in spark.sql("SELECT * FROM scored").collect()}
    assert got == {"great crash fix": 4.0, "awful computer crash": 0.0}


def test_failure_surfaces(spark, tmp):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    write(os.path.join(src, "a.txt"), "1\n")
    watcher = st.TerminationWatcher()
    spark.streams.addListener(watcher)

    def boom(df, i):
        raise ValueError("batch failed")

    q = (st.file_stream(spark, src, "text").writeStream.foreachBatch(boom)
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    try:
        st.run_available(q)
        raised = False
    except Exception:
        raised = True
    assert raised
    spark.streams.removeListener(watcher)


def test_run_for_stops(spark, tmp):
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    q = (st.file_stream(spark, src, "text").writeStream.format("memory").queryName("idle")
         .trigger(processingTime="1 second").start())
    st.run_for(q, 2)
    assert not q.isActive


def test_run_batches_recovers_and_gives_up(spark, tmp):
    rows = spark.range(60).select(F.col("id").cast("string").alias("value"), F.lit(True).alias("ok"), (F.col("id") % 4).alias("n"))
    out, src, ck = (os.path.join(tmp, x) for x in ("out", "in", "ck"))
    writer, calls = st.value_counts_writer(out), []

    def flaky(batch, batch_id):
        calls.append(batch_id)
        if calls.count(batch_id) < 3 and batch_id == 1:
            writer(batch.limit(3), batch_id)     # part of the batch is out before the failure
            raise RuntimeError("lost")
        writer(batch, batch_id)

    failed = st.run_batches(rows, flaky, src, ck, F.pmod(F.col("value").cast("int"), F.lit(3)), 3, max_restarts=2)
    assert failed == [1, 1] and calls == [0, 1, 1, 1, 2]
    got = {(r["batch_id"], r["n"]): r["count"] for r in spark.read.parquet(out).collect()}
    assert got == {(b, n): 5 for b in range(3) for n in range(4)}

    def broken(batch, batch_id):
        raise RuntimeError("always")

    try:
        st.run_batches(rows, broken, src + "2", ck + "2", F.lit(0), 1, max_restarts=1)
    except Exception as e:
        assert "always" in str(e)
    else:
        raise AssertionError("a stream that keeps failing has to be reported")


def test_a_table_streams_as_one_file_and_as_a_folder(spark, tmp):
    from tessera.plans.q_stream import _stream_table
    spark.range(40).repartition(4).write.parquet(os.path.join(tmp, "a", "t.parquet"))
    os.makedirs(os.path.join(tmp, "b"))
    spark.range(40).coalesce(1).write.parquet(os.path.join(tmp, "one"))
    part = [f for f in os.listdir(os.path.join(tmp, "one")) if f.startswith("part-")][0]
    os.link(os.path.join(tmp, "one", part), os.path.join(tmp, "b", "t.parquet"))
    for form in ("a", "b"):
        q = (_stream_table(spark, os.path.join(tmp, form), "t").writeStream.format("memory").queryName(f"table_{form}")
             .trigger(availableNow=True).start())
        st.run_available(q)
        assert [r[0] for r in spark.sql(f"SELECT id FROM table_{form} ORDER BY id").collect()] == list(range(40))
