"""Machine learning (ML-1..12) through ``pyspark.ml``, plus an exact
multinomial Naive Bayes written with DataFrame aggregates and joins.

Fitting runs in Spark ML (ALS is block-partitioned, k-means aggregates per
partition); only model parameters reach the driver, never data rows. The
label lists collected here are the distinct class labels, bounded by the
number of classes.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixed_values import WORD_SEPARATOR
from tessera.functions.strings import java_split
from tessera.operators.joins import MAX_KEY_ROWS, dealt_by_document
from tessera.session import ensure_checkpoint_dir, shuffles_removed


# ---------------------------------------------------------------- ALS (ML-1..5)

def fit_als(ratings: DataFrame, user: str = "userId", item: str = "movieId",
            rating: str = "rating", rank: int = 10, max_iter: int = 10, seed: int = 42,
            cold_start: str = "nan"):
    """Collaborative filtering, rank 10 and 10 iterations as in the reference.

    Every iteration shuffles all factors to the blocks that need them. ALS removes these
    shuffles when it checkpoints the item factors, so it does that after each
    iteration: the disk holds the factors of one iteration in place of all, and the fit is the same."""
    ensure_checkpoint_dir(ratings.sparkSession)
    als = ALS(userCol=user, itemCol=item, ratingCol=rating, rank=rank, maxIter=max_iter,
              seed=seed, coldStartStrategy=cold_start, checkpointInterval=1)
    return als.fit(ratings)


def als_residuals(model, ratings: DataFrame, user: str = "userId", item: str = "movieId",
                  rating: str = "rating", reg: float = 0.1, max_user_rows: int = MAX_KEY_ROWS) -> DataFrame:
    """How well the fitted user factors solve their normal equations: one row
    per user with ``n`` ratings, (user, n, residual).

    Explicit ALS ends by solving, for each user with factors x and items with
    factors y, sum((x.y - r) y) + reg * n * x = 0. ``residual`` is the length of the left
    side over the length of sum(r y). Ratings move by item, for its factors, and by user,
    for the sums; the rows of sums do not move. Users with more than ``max_user_rows``
    ratings (few, at most the ratings over that number) would gather in one task: their factors are
    broadcast and each task sums its part first. AQE splits a hot item."""
    dims = range(model.rank)
    x = model.userFactors.select(F.col("id").alias(user), F.col("features").alias("_x"))
    y = model.itemFactors.select(F.col("id").alias(item), F.col("features").alias("_y"))
    num = lambda c, i: F.col(c)[i].cast("double")
    dot = sum((num("_x", i) * num("_y", i) for i in dims), F.lit(0.0))
    with shuffles_removed(ratings.sparkSession):
        hot = [u[0] for u in ratings.groupBy(user).count().where(F.col("count") > max_user_rows).select(user).collect()]

    def sums_of(part, factors):
        r = part.select(user, item, F.col(rating).cast("double").alias("_r")).join(y, item).drop(item).join(factors, user) \
            .select(user, "_x", "_y", "_r", (dot - F.col("_r")).alias("_e"))
        return r.groupBy(user).agg(
            F.count(F.lit(1)).alias("n"),
            *[F.max(num("_x", i)).alias(f"_x{i}") for i in dims],
            *[F.sum(F.col("_e") * num("_y", i)).alias(f"_g{i}") for i in dims],
            *[F.sum(F.col("_r") * num("_y", i)).alias(f"_b{i}") for i in dims])

    is_hot = F.col(user).isin(hot)
    sums = sums_of(ratings.where(~is_hot), x).unionByName(
        sums_of(ratings.where(is_hot), F.broadcast(x.where(is_hot)))) if hot else sums_of(ratings, x)
    length = lambda parts: F.sqrt(sum((p * p for p in parts), F.lit(0.0)))
    left = length([F.col(f"_g{i}") + F.lit(reg) * F.col("n") * F.col(f"_x{i}") for i in dims])
    right = length([F.col(f"_b{i}") for i in dims])
    return sums.select(user, "n", (left / F.greatest(right, F.lit(1e-12))).alias("residual"))


def false_positives(predictions: DataFrame, movies: DataFrame, max_rating: float = 1.0,
                    min_prediction: float = 4.0) -> DataFrame:
    """Ratings at most ``max_rating`` predicted at least ``min_prediction``,
    with the title (ML-3). NaN predictions (unknown user or item) are left
    out: Spark orders NaN above every number, so ``NaN >= 4`` is true."""
    p, m = predictions.alias("p"), movies.alias("m")
    return (p.join(m, F.col("p.movieId") == F.col("m.movieId"))
            .where((F.col("rating") <= max_rating) & (F.col("prediction") >= min_prediction)
                   & ~F.isnan("prediction"))
            .select("userId", F.col("p.movieId").alias("movieId"), "title", "rating", "prediction"))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: ``num_rows`` and the distinct non-null values of each column.

    Several count(distinct) in one aggregate make Spark copy every row once per column
    and shuffle all copies. Here each column is reduced on its own, by a scan of
    that column alone with a partial step, and only the totals meet; ``num_rows`` comes
    with the first. Store ``df`` first if it is costly."""
    parts = []
    for c in columns:
        per_value = df.groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_value.agg(F.count("v").alias("d"), F.sum("n").alias("n")).select(F.lit(c).alias("c"), "d", "n"))
    totals = parts[0]
    for p in parts[1:]:
        totals = totals.unionByName(p)
    return totals.agg(F.coalesce(F.max("n"), F.lit(0)).alias("num_rows"),
                      *[F.max(F.when(F.col("c") == c, F.col("d"))).alias(c) for c in columns])


def ratings_summary(ratings: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """Rows, distinct users and distinct items (ML-5)."""
    d = distinct_counts(ratings, [user, item])
    return d.select(F.col("num_rows").alias("num_ratings"), F.col(user).alias("num_users"), F.col(item).alias("num_movies"))


def score_pairs(spark: SparkSession, model, pairs, user: str = "userId",
                item: str = "movieId") -> DataFrame:
    """Predicted ratings for chosen (user, item) pairs (ML-4)."""
    return model.transform(spark.createDataFrame(list(pairs), f"{user} int, {item} int"))


# ---------------------------------------------------------------- k-means (ML-6..8)

def fit_kmeans(vectors: DataFrame, k: int = 3, max_iter: int = 10, seed: int = 1,
               features: str = "features"):
    return KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features).fit(vectors)


def centers(spark: SparkSession, model) -> DataFrame:
    """(cluster, center) for the k centres of a fitted model (ML-7)."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def grid(vector, scale: int = 1_000_000):
    """A vector's values as whole numbers of 1/``scale``, halves upwards."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale + F.lit(0.5)).cast("long"))


def first_centers(points: DataFrame, k: int, id_col: str, vector: str) -> list[list[int]]:
    """The vectors of the ``k`` smallest ids (fewer if there are fewer)."""
    return [list(r[0]) for r in points.where(F.col(vector).isNotNull()).orderBy(id_col).limit(k).select(vector).collect()]


def nearest(vector, centers: list[list[int]]):
    """The number of the nearest centre by squared distance, the first of equals; null for
    a null vector. Whole numbers, so the sums are exact in any order."""
    d = F.array(*[F.aggregate(F.zip_with(vector, F.array(*[F.lit(v).cast("long") for v in c]),
                                         lambda a, b: (a - b) * (a - b)),
                              F.lit(0).cast("long"), lambda s, x: s + x) for c in centers])
    return F.when(vector.isNotNull(), F.array_position(d, F.array_min(d)) - 1).cast("int")


def lloyd(points: DataFrame, centers: list[list[int]], iterations: int, vector: str = "x") -> tuple[DataFrame, list[list[int]]]:
    """Lloyd's k-means as DataFrame aggregates (ML-6..8): ``iterations`` rounds from the
    given centres, fewer once they stay where they are.

    ``vector`` holds whole numbers (see ``grid``), and centres are rounded to whole
    numbers after each round, so the result depends on the rows alone, not on how they
    are partitioned or in which order they are summed. A round is one scan and one
    hash aggregate with a sum per dimension; k rows of sums reach the driver. A centre
    that no point is nearest to stays. Store ``points`` first if they are costly.
    Returns the points with their ``cluster`` and the final centres."""
    dims = range(len(centers[0]) if centers else 0)
    for _ in range(iterations if centers else 0):
        sums = points.select(nearest(F.col(vector), centers).alias("cluster"), vector).where("cluster IS NOT NULL") \
            .groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(vector)[i]).alias(f"s{i}") for i in dims])
        moved = list(centers)
        for r in sums.collect():
            moved[r["cluster"]] = [(2 * r[f"s{i}"] + r["n"]) // (2 * r["n"]) for i in dims]
        if moved == centers:
            break
        centers = moved
    return points.withColumn("cluster", nearest(F.col(vector), centers) if centers else F.lit(None).cast("int")), centers


# ---------------------------------------------------------------- Naive Bayes, hashed (ML-9..12)

MAX_CLASSES = 1000


def class_labels(df: DataFrame, label: str = "label") -> list[float]:
    """The sorted distinct labels (one value per class). A column with more than
    ``MAX_CLASSES`` values is not a class label and is an error."""
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("l")).distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values")
    return sorted(r[0] for r in rows)


def _index_of(label_col, labels):
    return (F.array_position(F.array(*[F.lit(float(x)) for x in labels]),
                             label_col.cast("double")) - 1).cast("double")


def fit_nb_hashed(docs: DataFrame, text: str = "text", label: str = "label",
                  num_features: int = 1 << 18, smoothing: float = 1.0):
    """HashingTF over words split on one space (no lowercasing) + multinomial
    Naive Bayes. Labels (for example 0/2/4) are mapped to class indexes for
    training and back on prediction. Returns (model, labels)."""
    labels = class_labels(docs, label)
    train = docs.select(java_split(F.col(text), WORD_SEPARATOR).alias("words"),
                        _index_of(F.col(label), labels).alias("_y"))
    pipe = Pipeline(stages=[
        HashingTF(inputCol="words", outputCol="features", numFeatures=num_features),
        NaiveBayes(featuresCol="features", labelCol="_y", smoothing=smoothing,
                   modelType="multinomial"),
    ])
    return pipe.fit(train), labels


def predict_nb_hashed(model, labels, docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``prediction``, the predicted label itself (not its index)."""
    scored = model.transform(docs.withColumn("words", java_split(F.col(text), WORD_SEPARATOR)))
    lab = F.array(*[F.lit(float(x)) for x in labels])
    return (scored.withColumn("prediction", F.element_at(lab, F.col("prediction").cast("int") + 1))
            .drop("words", "features", "rawPrediction", "probability"))


# ---------------------------------------------------------------- Naive Bayes, exact (ML-10b)

def md5_bucket(term, buckets: int):
    """A term's bucket: the first eight hex digits of its MD5, modulo ``buckets``. Unlike
    Spark's own term hash it is one that SQL and any other program have too."""
    return F.conv(F.substring(F.md5(term.cast("binary")), 1, 8), 16, 10).cast("long") % buckets


def count_terms(docs: DataFrame, doc: str = "doc_id", text: str = "text", label: str | None = "label",
                buckets: int | None = None) -> DataFrame:
    """Stored rows (doc, label, term, tf, docs): the words of ``text`` split on one space,
    or their buckets. All of a Naive Bayes model and its predictions derive from
    them, so texts are cut once, dealt by document. ``docs`` adds up to the document's rows; a null text
    has one row with a null term."""
    from tessera.session import shared_dir
    y = F.col(label).cast("double") if label else F.lit(None).cast("double")
    words = dealt_by_document(docs.select(F.col(doc).alias("doc"), y.alias("label"), F.col(text).alias("t")), "doc", "t")
    each = words.select("doc", "label", F.posexplode_outer(java_split(F.col("t"), WORD_SEPARATOR)).alias("at", "w"))
    term = F.col("w") if buckets is None else md5_bucket(F.col("w"), buckets)
    path = shared_dir(docs.sparkSession, "nb-terms")
    (each.select("doc", "label", term.alias("term"), (F.coalesce("at", F.lit(0)) == 0).cast("int").alias("d"))
     .groupBy("doc", "label", "term").agg(F.count("term").alias("tf"), F.sum("d").alias("docs"))
     .write.parquet(path))
    return docs.sparkSession.read.parquet(path)


def fit_nb_terms(terms: DataFrame, buckets: int | None = None, smoothing: float = 1.0) -> dict:
    """Multinomial Naive Bayes from ``count_terms``.

    log P(t|c) = ln(count(c,t) + a) - ln(total(c) + a*V), V the distinct terms or, for
    hashed ones, ``buckets``. The (class, term) table stays distributed; a row per class
    (prior, log denominator) is brought to the driver."""
    from tessera.session import shared_dir
    spark = terms.sparkSession
    known = terms.where(F.col("label").isNotNull())
    class_labels(known)  # bounds the per-class rows below
    path = shared_dir(spark, "nb-counts")
    known.where(F.col("term").isNotNull()).groupBy("label", "term").agg(F.sum("tf").alias("cnt")).write.parquet(path)
    counts = spark.read.parquet(path)
    v = buckets or counts.select(F.count_distinct("term")).first()[0]
    per_class = {r["label"]: (r["n"], r["total"]) for r in known.groupBy("label").agg(
        F.sum("docs").alias("n"), F.sum("tf").alias("total")).collect()}
    n = sum(x[0] for x in per_class.values())
    log_a = math.log(smoothing)
    classes = [{"label": float(c), "prior": math.log(nd) - math.log(n), "floor": log_a - math.log(total + smoothing * v)}
               for c, (nd, total) in sorted(per_class.items())]
    # per term, the value of every class: floor(c) plus ln(cnt + a) - ln(a) where seen in c
    seen = counts.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct(
        "label", (F.log(F.col("cnt") + F.lit(smoothing)) - F.lit(log_a)).alias("g")))).alias("m"))
    values = seen.select("term", F.array(*[
        F.lit(c["floor"]) + F.coalesce(F.col("m")[F.lit(c["label"])], F.lit(0.0)) for c in classes]).alias("terms"))
    return {"classes": classes, "terms": values, "hashed": buckets is not None}


def predict_nb_terms(model: dict, terms: DataFrame) -> DataFrame:
    """(doc, label, prediction) of the documents of ``count_terms``: argmax over classes of
    prior + sum of tf * value(class, term), ties to the smaller label. An unknown
    word is ignored; a bucket that training left empty counts as seen zero times. One
    join on the term and one hash aggregate, a column of sums per class."""
    classes = model["classes"]
    j = terms.join(model["terms"], "term", "left")
    other = lambda c: F.when(F.col("term").isNotNull(), F.lit(c["floor"])).otherwise(0.0) if model["hashed"] else F.lit(0.0)
    sums = [F.sum(F.col("tf") * F.coalesce(F.col("terms")[i], other(c))).alias(f"_s{i}") for i, c in enumerate(classes)]
    per_doc = j.groupBy("doc", "label").agg(*sums)
    scores = [F.col(f"_s{i}") + F.lit(c["prior"]) for i, c in enumerate(classes)]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    pick = F.lit(None).cast("double")
    for s, c in reversed(list(zip(scores, classes))):  # the first (smallest) class with the top score
        pick = F.when(s == top, F.lit(c["label"])).otherwise(pick)
    return per_doc.select("doc", "label", pick.alias("prediction"))


def fit_nb_exact(docs: DataFrame, doc: str = "doc_id", text: str = "text",
                 label: str = "label", smoothing: float = 1.0) -> dict:
    """Multinomial Naive Bayes over the exact vocabulary (ML-10b)."""
    return fit_nb_terms(count_terms(docs, doc, text, label), smoothing=smoothing)


def predict_nb_exact(model: dict, docs: DataFrame, doc: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """(doc, prediction) of each document."""
    return predict_nb_terms(model, count_terms(docs, doc, text, None)).select("doc", "prediction")
