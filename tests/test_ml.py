"""Models on small separable inline data, with seeds."""

import math
import re
import time
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators import ml

from conftest import SF001


def test_kmeans(spark):
    pts = [[0.0, 0.0, 0.0], [0.1, 0.1, 0.1], [0.2, 0.2, 0.2],
           [9.0, 9.0, 9.0], [9.1, 9.1, 9.1], [9.2, 9.2, 9.2]]
    df = spark.createDataFrame([(Vectors.dense(p),) for p in pts], ["features"])
    model = ml.fit_kmeans(df, k=2, max_iter=10, seed=1)
    c = sorted(r["center"] for r in ml.centers(spark, model).collect())
    assert [round(x, 6) for x in c[0]] == [0.1, 0.1, 0.1]
    assert [round(x, 6) for x in c[1]] == [9.1, 9.1, 9.1]
    test = spark.createDataFrame([(Vectors.dense([0.3, 0.3, 0.3]),), (Vectors.dense([8.0, 8.0, 8.0]),)],
                                 ["features"])
    p = [r["prediction"] for r in model.transform(test).collect()]
    assert p[0] != p[1]


def test_als_and_false_positives(spark):
    rows = [(u, m, 5.0 if (u + m) % 2 == 0 else 1.0) for u in range(8) for m in range(8)]
    r = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    model = ml.fit_als(r, rank=4, max_iter=10, seed=7)
    pred = model.transform(r)
    assert pred.count() == 64
    movies = spark.createDataFrame([(m, f"Movie {m}") for m in range(8)], "movieId int, title string")
    fp = ml.false_positives(pred, movies)
    assert set(fp.columns) == {"userId", "movieId", "title", "rating", "prediction"}
    # an unseen user gets NaN and is not reported
    cold = spark.createDataFrame([(99, 1, 1.0)], "userId int, movieId int, rating double")
    nan_pred = model.transform(cold)
    assert math.isnan(nan_pred.first()["prediction"])
    nan_pred = nan_pred.withColumn("prediction", F.lit(float("nan")))
    assert ml.false_positives(nan_pred, movies).count() == 0
    s = ml.ratings_summary(r).first().asDict()
    assert s == {"num_ratings": 64, "num_users": 8, "num_movies": 8}


TRAIN = [("happy good great day", 4.0), ("good great fun", 4.0), ("sad bad awful day", 0.0),
         ("bad terrible sad", 0.0), ("plain day normal", 2.0), ("normal plain", 2.0)]


def test_nb_hashed_labels(spark):
    df = spark.createDataFrame(TRAIN, "text string, label double")
    model, labels = ml.fit_nb_hashed(df, num_features=1 << 10)
    assert labels == [0.0, 2.0, 4.0]
    out = ml.predict_nb_hashed(model, labels, df).collect()
    assert [r["prediction"] for r in out] == [r["label"] for r in out]


def brute_nb(train, test, a=1.0):
    vocab = {w for t, _ in train for w in t.split(" ")}
    classes = sorted({lab for _, lab in train})
    nd = Counter(lab for _, lab in train)
    wc = {c: Counter() for c in classes}
    for t, lab in train:
        wc[lab].update(t.split(" "))
    out = []
    for t in test:
        best = None
        for c in classes:
            tot = sum(wc[c].values())
            s = math.log(nd[c] / len(train))
            for w in t.split(" "):
                if w in vocab:
                    s += math.log(wc[c][w] + a) - math.log(tot + a * len(vocab))
            if best is None or s > best[0] + 1e-12:
                best = (s, c)
        out.append(best[1])
    return out


def test_nb_exact(spark):
    df = spark.createDataFrame([(i, t, lab) for i, (t, lab) in enumerate(TRAIN)],
                               "doc_id long, text string, label double")
    model = ml.fit_nb_exact(df, "doc_id", "text", "label")
    tests = ["great fun day", "awful sad", "plain normal day", "unknown words only"]
    tdf = spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string")
    got = {r["doc"]: r["prediction"] for r in ml.predict_nb_exact(model, tdf).collect()}
    want = brute_nb(TRAIN, tests)
    # the last document has no known word: prior only, ties to the smaller label
    assert [got[i] for i in range(4)] == want


def test_als_residuals_tell_a_solved_model(spark):
    rows = [(u, m, float((u * 7 + m * 3) % 5 + 1)) for u in range(12) for m in range(9) if (u + m) % 4]
    r = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    model = ml.fit_als(r, rank=3, max_iter=4, seed=7)
    got = ml.als_residuals(model, r).collect()
    assert len(got) == 12 and {x["userId"]: x["n"] for x in got}[0] == sum(1 for u, m, _ in rows if u == 0)
    assert max(x["residual"] for x in got) < 1e-4

    class Constant:
        rank = 3
        userFactors = model.userFactors.select("id", F.array(*[F.lit(0.5)] * 3).alias("features"))
        itemFactors = model.itemFactors.select("id", F.array(*[F.lit(0.5)] * 3).alias("features"))

    assert min(x["residual"] for x in ml.als_residuals(Constant, r).collect()) > 1e-2


def brute_lloyd(points, centers, rounds):
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p: min(range(len(centers)), key=lambda c: (dist(p, centers[c]), c))
    for _ in range(rounds):
        own = [near(p) for p in points]
        for c in range(len(centers)):
            mine = [p for p, o in zip(points, own) if o == c]
            if mine:
                centers = [*centers[:c], [(2 * sum(x) + len(mine)) // (2 * len(mine)) for x in zip(*mine)], *centers[c + 1:]]
    return [near(p) for p in points], centers


def test_lloyd(spark):
    pts = [[(i * 37) % 101 - 50, (i * 53) % 89 - 40] for i in range(60)] + [[5, 5]] * 9
    first = [pts[0], pts[1], pts[2], [10**6, 10**6]]  # the last centre gets no point and stays
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pts)] + [(999, None)], "id long, x array<long>").repartition(3)
    for rounds in (0, 1, 6):
        out, centers = ml.lloyd(df, first, rounds)
        want, moved = brute_lloyd(pts, first, rounds)
        got = {r["id"]: r["cluster"] for r in out.collect()}
        assert [got[i] for i in range(len(pts))] == want and got[999] is None and centers == moved
    assert ml.first_centers(df, 2, "id", "x") == pts[:2]
    assert ml.lloyd(df.where("1 = 0"), [], 3)[0].count() == 0


def test_nb_hashed_terms_equal_brute_force(spark):
    import hashlib
    bucket = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 16
    df = spark.createDataFrame([(i, t, lab) for i, (t, lab) in enumerate(TRAIN)] + [(50, None, 2.0), (51, "", None)],
                               "doc_id long, text string, label double")
    t = ml.count_terms(df, buckets=16)
    got = {r["doc"]: r["prediction"] for r in ml.predict_nb_terms(ml.fit_nb_terms(t, 16), t).collect()}
    train = [(x, lab) for x, lab in TRAIN] + [(None, 2.0)]
    classes = sorted({lab for _, lab in train})
    for i, text in [*enumerate(x for x, _ in TRAIN), (50, None), (51, "")]:
        words = [] if text is None else text.split(" ")
        def score(c):
            own = Counter(bucket(w) for x, lab in train if lab == c and x is not None for w in x.split(" "))
            total = sum(own.values())
            return (math.log(sum(lab == c for _, lab in train) / len(train))
                    + sum(math.log(own[bucket(w)] + 1) - math.log(total + 16) for w in words))
        best = max(score(c) for c in classes)
        assert got[i] == min(c for c in classes if score(c) > best - 1e-9)


def test_als_sums_do_not_move_and_hot_users_are_summed_in_parts(spark):
    r = spark.range(400).select((F.col("id") % 13).cast("int").alias("userId"), (F.col("id") % 31).cast("int").alias("movieId"),
                                (F.col("id") % 5 + 1).cast("double").alias("rating"))
    r = r.unionByName(r.where("userId = 5").withColumn("movieId", (F.col("movieId") + 40)))
    model = ml.fit_als(r, max_iter=2)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plain = ml.als_residuals(model, r)
        above = plain._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[0]
        assert "Exchange" not in above
        split = ml.als_residuals(model, r, max_user_rows=40)
        rows = lambda d: {x["userId"]: (x["n"], round(x["residual"], 9)) for x in d.collect()}
        assert rows(plain) == rows(split) and len(rows(plain)) == 13
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def kept_shuffles(spark, at_most=0, seconds=20):
    """The shuffles whose files are on disk; files go in the background, so wait for ``at_most``."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    end = time.time() + seconds
    while True:
        left = set(re.findall(r"shuffle_(\d+)_", blocks.getAllFiles().mkString(" ")))
        if len(left) <= at_most or time.time() > end:
            return left
        time.sleep(0.2)


def test_als_keeps_the_shuffles_of_one_iteration(spark):
    r = spark.range(600).select((F.col("id") % 23).cast("int").alias("userId"), (F.col("id") % 31).cast("int").alias("movieId"),
                                (F.col("id") % 5 + 1).cast("double").alias("rating"))
    old = kept_shuffles(spark, seconds=0)
    models = [ml.fit_als(r, max_iter=2)]   # kept: its shuffles stay as long as it does
    first = kept_shuffles(spark, seconds=2) - old
    models.append(ml.fit_als(r, max_iter=8))
    second = kept_shuffles(spark, at_most=len(old) + 2 * len(first)) - old - first
    assert 0 < len(second) <= len(first)
    # checkpoints are no part of the result: Spark's default keeps but one
    plain = ALS(userCol="userId", itemCol="movieId", ratingCol="rating", rank=10, maxIter=8, seed=42).fit(r)
    factors = lambda m: {x["id"]: list(x["features"]) for x in m.userFactors.collect()}
    got, want = factors(models[1]), factors(plain)
    assert got.keys() == want.keys() and all(abs(a - b) < 1e-5 for k in got for a, b in zip(got[k], want[k]))


@pytest.mark.parametrize("name", ["als_normal_equations", "als_predict", "als_chosen_pairs"])
def test_stored_ratings_leave_no_shuffle(spark, monkeypatch, name):
    class Fit(Exception):
        pass

    def fit(*_, **__):
        raise Fit

    monkeypatch.setattr(ml, "fit_als", fit)
    old = kept_shuffles(spark, seconds=0)
    with pytest.raises(Fit):
        E.queries()[name](spark, SF001)
    assert not kept_shuffles(spark, at_most=len(old)) - old
