"""Module 5 models on the stand-ins: ALS on ratings, k-means on embeddings,
Naive Bayes on labelled documents, and the post filter of the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.strings import contains_any
from tessera.operators import ml
from tessera.operators.ids import encode_ratings
from tessera.plans import standins as si
from tessera.plans.oracle_sql import RATINGS_CTE, with_
from tessera.plans.q_text import sql_java_split
from tessera.plans.registry import query
from tessera.session import shared_dir, shuffles_removed
from tessera.sources.tables import Tables

# The reference's stream keywords are fixed_values.STREAM_KEYWORDS (its input
# was on-topic posts). Keywords for the stand-in posts (invented prose):
POST_KEYWORDS = ("this", "from", "with")

ALS_SEED = 42
KMEANS_K = 3
KMEANS_SEED = 1


@query("ratings_summary", with_(RATINGS_CTE) + """
SELECT COUNT(*) AS num_ratings, COUNT(DISTINCT userId) AS num_users,
       COUNT(DISTINCT movieId) AS num_movies FROM ratings""")
def ratings_summary(spark, sf_dir):
    path = shared_dir(spark, "ratings-ids")   # each column is a scan of its own: joined once
    si.ratings(Tables(spark, sf_dir)).select("userId", "movieId").write.parquet(path)
    return ml.ratings_summary(spark.read.parquet(path))


@query("ratings_encoded", with_(RATINGS_CTE) + """
SELECT CAST(dense_rank() OVER (ORDER BY userId) - 1 AS INTEGER) AS user_no,
       CAST(dense_rank() OVER (ORDER BY movieId) - 1 AS INTEGER) AS item_no, rating FROM ratings""")
def ratings_encoded(spark, sf_dir):
    """Ratings with gapless ids of users and parts, which fit the 32 bits ALS takes (HSH-1)."""
    r, _, _ = encode_ratings(si.ratings(Tables(spark, sf_dir)))
    return r.select("user_no", "item_no", "rating")


def _in_test(user: str, item: str) -> str:
    """The key rule that puts a rating into the test part, in SQL."""
    return f"({user} * 31 + {item}) % 10 = 0"


ALS_SQL = with_(RATINGS_CTE, """
pairs AS (SELECT userId, movieId, AVG(rating) AS rating FROM ratings GROUP BY userId, movieId)""", f"""
train AS (SELECT * FROM pairs WHERE NOT {_in_test('userId', 'movieId')})""", f"""
test AS (SELECT * FROM pairs WHERE {_in_test('userId', 'movieId')})""")


@query("als_predict", ALS_SQL + """
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE userId IN (SELECT userId FROM train) AND movieId IN (SELECT movieId FROM train)) AS n_scored
FROM test""")
def als_predict(spark, sf_dir):
    """Held-out ratings (by a rule on the keys) scored by ALS (rank 10, 10 iterations):
    how many there are, and how many got a score. A user or part that the
    training part does not have gets none."""
    t = Tables(spark, sf_dir)
    path = shared_dir(spark, "ratings")   # both parts read it: written once
    with shuffles_removed(spark):
        si.ratings(t).groupBy("userId", "movieId").agg(F.avg("rating").alias("rating")).write.parquet(path)
    r = spark.read.parquet(path)
    model = ml.fit_als(r.where(f"NOT {_in_test('userId', 'movieId')}"), seed=ALS_SEED)
    scored = model.transform(r.where(_in_test("userId", "movieId")))
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(~F.isnan("prediction"), 1)).alias("n_scored"))


ALS_BOUND = 1e-4


@query("als_normal_equations", ALS_SQL + f"""
SELECT userId, COUNT(*) AS n_ratings, TRUE AS solved FROM train GROUP BY userId""")
def als_normal_equations(spark, sf_dir):
    """For every user of the training part: their ratings, and whether the fitted
    factors solve the user's regularised normal equations (ML-1, ML-2)."""
    path = shared_dir(spark, "ratings-train")
    with shuffles_removed(spark):
        (si.ratings(Tables(spark, sf_dir)).groupBy("userId", "movieId").agg(F.avg("rating").alias("rating"))
         .where(f"NOT {_in_test('userId', 'movieId')}").write.parquet(path))
    train = spark.read.parquet(path)
    r = ml.als_residuals(ml.fit_als(train, seed=ALS_SEED), train)
    return r.select("userId", F.col("n").alias("n_ratings"), (F.col("residual") <= ALS_BOUND).alias("solved"))


@query("false_positives", with_(RATINGS_CTE) + """
SELECT userId, movieId, p_name AS title, rating, CAST((userId + movieId) % 6 AS DOUBLE) AS prediction
FROM ratings JOIN part ON movieId = p_partkey
WHERE rating <= 1 AND (userId + movieId) % 6 >= 4 AND movieId % 7 <> 0""")
def false_positives(spark, sf_dir):
    """Ratings <= 1 predicted >= 4, with the part name, on predictions set by a rule
    on the keys; a NaN prediction (every seventh part) is none."""
    t = Tables(spark, sf_dir)
    nan = F.lit(float("nan"))
    pred = si.ratings(t).withColumn("prediction", F.when(F.col("movieId") % 7 == 0, nan).otherwise(
        ((F.col("userId") + F.col("movieId")) % 6).cast("double")))
    return ml.false_positives(pred, si.movies(t))


def _kmeans(spark, sf_dir):
    v = si.vectors(Tables(spark, sf_dir))
    return v, ml.fit_kmeans(v, k=KMEANS_K, max_iter=10, seed=KMEANS_SEED)


@query("kmeans_assign", "SELECT COUNT(*) AS n_points, CAST(0 AS BIGINT) AS n_misassigned FROM embeddings")
def kmeans_assign(spark, sf_dir):
    """Every vector assigned to a centre; how many have a nearer one (none)."""
    from pyspark.ml.functions import vector_to_array
    v, model = _kmeans(spark, sf_dir)
    x = vector_to_array("features")
    scored = model.transform(v).select("prediction", x.alias("x"))

    def distance(center):
        c = F.array(*[F.lit(float(y)) for y in center])
        return F.aggregate(F.zip_with("x", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, d: acc + d)

    d = F.array(*[distance(c) for c in model.clusterCenters()])
    wrong = F.get(d, F.col("prediction")) > F.array_min(d) + F.lit(1e-9)
    return scored.agg(F.count(F.lit(1)).alias("n_points"), F.count(F.when(wrong, 1)).alias("n_misassigned"))


@query("kmeans_centers", f"SELECT unnest(range({KMEANS_K}))::INTEGER AS cluster, (SELECT len(embedding) FROM embeddings LIMIT 1) AS n_dims, TRUE AS inside")
def kmeans_centers(spark, sf_dir):
    """The centres: their dimensions, and whether each lies within the vectors' bounds."""
    v, model = _kmeans(spark, sf_dir)
    e = Tables(spark, sf_dir).embeddings
    bounds = e.select(F.posexplode("embedding").alias("dim", "x")).groupBy("dim").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    c = ml.centers(spark, model).select("cluster", F.posexplode("center").alias("dim", "x"))
    return c.join(bounds, "dim").groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n_dims"), F.min((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))).alias("inside"))


LLOYD_ROUNDS = 5
LLOYD_SCALE = 1_000_000


def _lloyd_sql(rounds: int) -> str:
    """The rounds of ``ml.lloyd`` as common table expressions."""
    near = """
a{i} AS (
  SELECT vec_id, x, arg_min(cluster, (d, cluster)) AS cluster FROM (
    SELECT vec_id, x, cluster, list_sum(list_transform(range(1, len(x) + 1), lambda j: (x[j] - c[j]) * (x[j] - c[j]))) AS d
    FROM p, c{i}) GROUP BY vec_id, x)"""
    move = """
s{i} AS (
  SELECT cluster, j, CAST(2 * sum(x[j]) + count(*) AS BIGINT) AS t, 2 * count(*) AS m
  FROM a{i}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM p) + 1)) AS j) GROUP BY cluster, j),
c{n} AS (
  SELECT c{i}.cluster, coalesce(v, c) AS c FROM c{i} LEFT JOIN (
    SELECT cluster, list((t - ((t % m) + m) % m) // m ORDER BY j) AS v FROM s{i} GROUP BY cluster) USING (cluster))"""
    parts = [f"""
p AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * {LLOYD_SCALE} + 0.5) AS BIGINT)) AS x FROM embeddings)""", f"""
c0 AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cluster, x AS c FROM p ORDER BY vec_id LIMIT {KMEANS_K})"""]
    for i in range(rounds):
        parts += [near.format(i=i), move.format(i=i, n=i + 1)]
    return "WITH " + ",".join([*parts, near.format(i=rounds)])


def _lloyd(spark, sf_dir):
    path = shared_dir(spark, "vectors")
    (Tables(spark, sf_dir).embeddings.select("vec_id", ml.grid(F.col("embedding"), LLOYD_SCALE).alias("x"))
     .write.parquet(path))
    points = spark.read.parquet(path)
    return ml.lloyd(points, ml.first_centers(points, KMEANS_K, "vec_id", "x"), LLOYD_ROUNDS)


@query("kmeans_lloyd_assign", _lloyd_sql(LLOYD_ROUNDS) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster FROM a{LLOYD_ROUNDS}""")
def kmeans_lloyd_assign(spark, sf_dir):
    """The cluster of every vector after five rounds from the vectors of the three
    smallest ids (ML-6, ML-8)."""
    return _lloyd(spark, sf_dir)[0].select("vec_id", "cluster")


@query("kmeans_lloyd_centers", _lloyd_sql(LLOYD_ROUNDS) + f"""
SELECT CAST(cluster AS INTEGER) AS cluster, CAST(j AS INTEGER) AS dim, c[j + 1] / {LLOYD_SCALE}.0::DOUBLE AS value
FROM (SELECT cluster, c, unnest(range(len(c))) AS j FROM c{LLOYD_ROUNDS})""")
def kmeans_lloyd_centers(spark, sf_dir):
    """Every value of every centre (ML-7)."""
    points, centers = _lloyd(spark, sf_dir)
    rows = [(i, c) for i, c in enumerate(centers)]
    return (spark.createDataFrame(rows, "cluster int, c array<long>")
            .select("cluster", F.posexplode("c").alias("dim", "v"))
            .select("cluster", "dim", (F.col("v") / F.lit(float(LLOYD_SCALE))).alias("value")))


NB_BUCKETS = 1 << 12


def nb_sql(posts: str, term: str, vocabulary: str, unseen: str) -> str:
    """Multinomial Naive Bayes in SQL; ``posts`` gives (doc, text, label) rows."""
    return f"""
WITH d AS ({posts}),
tok AS (SELECT doc, label, {term} AS word FROM (SELECT doc, label, unnest({sql_java_split('text', ' ')}) AS w FROM d)),
wc AS (SELECT label, word, COUNT(*) AS cnt FROM tok GROUP BY label, word),
vv AS (SELECT {vocabulary} AS v FROM wc),
cls AS (SELECT label, COUNT(*) AS ndocs FROM d GROUP BY label),
tot AS (SELECT label, SUM(cnt) AS total FROM wc GROUP BY label),
nn AS (SELECT SUM(ndocs) AS n FROM cls),
params AS (SELECT cls.label, ln(ndocs) - ln(n) AS prior, ln(coalesce(total, 0) + 1.0 * v) AS denom
           FROM cls LEFT JOIN tot USING (label) CROSS JOIN vv CROSS JOIN nn),
tf AS (SELECT doc, word, COUNT(*) AS tf FROM tok {unseen} GROUP BY doc, word),
len AS (SELECT d.doc, coalesce(SUM(tf), 0) AS l FROM d LEFT JOIN tf ON tf.doc = d.doc GROUP BY d.doc),
base AS (SELECT doc, label, prior - l * denom AS base FROM len CROSS JOIN params),
sparse AS (SELECT doc, wc.label, SUM(tf * ln(cnt + 1.0)) AS extra FROM tf JOIN wc USING (word) GROUP BY doc, wc.label),
score AS (SELECT b.doc, b.label, b.base + coalesce(s.extra, 0) AS score
          FROM base b LEFT JOIN sparse s ON b.doc = s.doc AND b.label = s.label),
best AS (SELECT doc, label AS prediction FROM (
           SELECT *, row_number() OVER (PARTITION BY doc ORDER BY score DESC, label) AS rn FROM score) WHERE rn = 1)
"""


HASHED_SQL = nb_sql("SELECT doc_id AS doc, text, CAST(quality AS DOUBLE) AS label FROM documents JOIN labels USING (doc_id)",
                    f"CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {NB_BUCKETS}", str(NB_BUCKETS), "")


@query("nb_hashed_predictions", HASHED_SQL + """
SELECT d.doc AS doc_id, d.label, best.prediction FROM d JOIN best ON d.doc = best.doc""")
def nb_hashed_predictions(spark, sf_dir):
    """Naive Bayes over hashed terms: the prediction for every labelled document
    (ML-9, ML-10, ML-11)."""
    t = ml.count_terms(si.posts(Tables(spark, sf_dir)), buckets=NB_BUCKETS)
    return ml.predict_nb_terms(ml.fit_nb_terms(t, NB_BUCKETS), t).withColumnRenamed("doc", "doc_id")


@query("nb_predict_hashed", """
SELECT doc_id, CAST(quality AS DOUBLE) AS label, TRUE AS known_label FROM documents JOIN labels USING (doc_id)""")
def nb_predict_hashed(spark, sf_dir):
    """Every labelled document scored by the hashed Naive Bayes: its id, label and
    whether the prediction is one of the labels."""
    p = si.posts(Tables(spark, sf_dir))
    model, labels = ml.fit_nb_hashed(p, "text", "label")
    return ml.predict_nb_hashed(model, labels, p, "text").select(
        "doc_id", "label", F.col("prediction").isin(labels).alias("known_label"))


NB_SQL = nb_sql("SELECT doc_id AS doc, text, CAST(quality AS DOUBLE) AS label FROM documents JOIN labels USING (doc_id)",
                "w", "COUNT(DISTINCT word)", "") + """
SELECT d.doc AS doc_id, d.label, best.prediction FROM d JOIN best ON d.doc = best.doc"""


@query("nb_predict", NB_SQL)
def nb_predict(spark, sf_dir):
    """Exact multinomial Naive Bayes (smoothing 1) on the labelled documents."""
    t = ml.count_terms(si.posts(Tables(spark, sf_dir)))
    return ml.predict_nb_terms(ml.fit_nb_terms(t), t).withColumnRenamed("doc", "doc_id")


def _sql_contains_any(col, words):
    return "(" + " OR ".join(f"contains(lower({col}), '{w}')" for w in words) + ")"


@query("post_filter", f"""
SELECT d.doc_id, d.source AS "user", d.text, CAST(l.quality AS DOUBLE) AS label
FROM documents d JOIN labels l USING (doc_id)
WHERE d.lang = 'en' AND l.toxic = 0 AND {_sql_contains_any('d.text', POST_KEYWORDS)}""")
def post_filter(spark, sf_dir):
    """English, non-sensitive posts that mention any keyword."""
    p = si.posts(Tables(spark, sf_dir))
    return (p.where((F.col("lang") == "en") & ~F.col("sensitive")
                    & contains_any("text", POST_KEYWORDS))
            .select("doc_id", "user", "text", "label"))
