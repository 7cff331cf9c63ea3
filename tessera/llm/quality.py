"""Quality rules with risk-controlled thresholds.

Counts of each text (words, symbols, repeated lines and windows, ...) give one
score per rule, high meaning bad. Cutoffs are chosen per stratum on texts
labelled good, split by a hash of the text into two holdouts (copies of a text are in
the same one and count once, so the second is independent of the first):

* on the first, a level (share, margin) of ``LEVELS`` takes for each rule the
  smallest cutoff of its grid that rejects at most that share of the good
  documents, and adds the margin in grid steps;
* on the second, the levels are tested from the mildest to the strictest: a level
  holds if the exact binomial test rejects "the rules together reject ``risk`` or
  more of the good documents". The tests of one stratum form a fixed sequence that
  ends at the first failure, so they need no correction among themselves; across
  strata the error ``delta`` is divided by their number, and a stratum whose levels all
  hold hands its part on to the others (Holm). Of the levels that hold, that which
  rejects most texts labelled bad is taken, the mildest of equals.

The first holdout has one text in ``FIRST``: it only proposes cutoffs. The second has
to prove them; at a risk of 0.02 it takes about 220 good texts of a stratum none of
which is rejected.

With probability 1 - ``delta`` the rules then reject less than ``risk`` of the good
documents in every stratum. A stratum whose labels cannot prove that has no
cutoffs, and only the base rules apply to it.

Defined cases. A null text has no words and fails the base rules, as does any text
under 20 words. Null strata are one stratum. Documents without a label do not
count in the fit; a document with several labels is good if all are. Without
labels, or with an empty table, there are no cutoffs. Repeated rows are judged
each. Extra columns may have any name.

Scale: counting is map-side and done once (``keep`` stores the rows with their counts and
moves no text), the fit aggregates one row per labelled document and
rule into (stratum, rule, bin) counts before any shuffle, cutoffs are one row per
stratum and stay a DataFrame; they are broadcast after a check of their size.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import col, stored, table, trim_memory
from tessera.llm.registry import query

WINDOW = 8
RISK = 0.02
DELTA = 0.05
FIRST = 4
LEVELS = ((0.0, 40), (0.0, 20), (0.0, 10), (0.0, 5), (0.0, 0), (0.0005, 0), (0.001, 0), (0.002, 0), (0.004, 0))
GRID = 200  # cutoffs per rule, even steps up to the rule's largest cutoff
BLOCK_WORDS = 150_000
SLICE_ROWS = 500
SYMBOLS = "#*$%&|<>"  # fixed by the contract
COUNTS = ("n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper "
          "n_echo n_long n_distinct").split()


def repeated_words(texts_words: list[list[bytes]], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: words in windows found twice or more, words equal to the one
    before, distinct words. Exact: windows are compared through ranks of ranks."""
    n = len(texts_words)
    lens = np.fromiter(map(len, texts_words), np.int64, n)
    total = int(lens.sum())
    vocab: dict[bytes, int] = defaultdict()
    vocab.default_factory = vocab.__len__
    ids = np.fromiter((vocab[w] for ws in texts_words for w in ws), np.int64, total)
    doc = np.repeat(np.arange(n), lens)
    same_doc = doc[1:] == doc[:-1]
    echo = np.bincount(doc[1:][(ids[1:] == ids[:-1]) & same_doc], minlength=n)
    distinct = np.bincount(np.unique(doc * max(len(vocab), 1) + ids) // max(len(vocab), 1), minlength=n)
    if total <= window:
        return np.zeros(n, np.int64), echo, distinct
    # rank of the 2^k words from each place on; built up to the window's length
    rank, have, made = ids, 1, None
    bits = window
    place = 0
    while bits:
        if bits & 1:
            part = rank[place:] if place else rank
            if made is None:
                made = part
            else:
                m = min(len(made), len(part))
                made = np.unique(made[:m] * (int(part.max(initial=0)) + 1) + part[:m], return_inverse=True)[1]
            place += have
        bits >>= 1
        if bits:
            m = len(rank) - have
            if m <= 0:
                return np.zeros(n, np.int64), echo, distinct
            rank = np.unique(rank[:m] * (int(rank.max()) + 1) + rank[have:have + m], return_inverse=True)[1]
            have *= 2
    starts = np.arange(len(made))
    starts = starts[doc[starts] == doc[starts + window - 1]]  # inside one text
    if not len(starts):
        return np.zeros(n, np.int64), echo, distinct
    key = doc[starts] * (int(made.max()) + 1) + made[starts]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = starts[counts[inverse] > 1]
    edge = np.bincount(twice, minlength=total + 1) - np.bincount(twice + window, minlength=total + 1)
    covered = np.cumsum(edge[:total]) > 0
    return np.bincount(doc[covered], minlength=n), echo, distinct


def count_block(texts: list[str]) -> dict[str, np.ndarray]:
    """The counts of each text, as arrays."""
    words = [t.encode().split() for t in texts]  # bytes: ASCII white space only
    out: dict[str, list] = {c: [] for c in COUNTS}
    for t, ws in zip(texts, words):
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        out["n_words"].append(len(ws))
        out["word_chars"].append(len(t) - sum(map(t.count, " \t\n\x0b\x0c\r")))
        out["n_symbols"].append(sum(map(t.count, SYMBOLS)))
        out["n_lines"].append(len(lines))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        out["n_upper"].append(sum(map(bytes.isupper, ws)))
        out["n_long"].append(sum(map((30).__lt__, map(len, ws))))
    out["n_repeat_words"], out["n_echo"], out["n_distinct"] = repeated_words(words)
    return {c: np.asarray(v, np.int64) for c, v in out.items()}


def counts(text: Column) -> Column:
    """The counts of a text as a struct of longs."""

    @F.arrow_udf("struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">")
    def of(texts: pa.Array) -> pa.Array:
        blocks = [dict.fromkeys(COUNTS, np.zeros(0, np.int64))]
        for at in range(0, len(texts), SLICE_ROWS):  # a batch's texts are never all in Python at once
            block, size = [], 0
            for t in texts.slice(at, SLICE_ROWS).to_pylist():
                block.append(t or "")
                size += len(block[-1])
                if size > 6 * BLOCK_WORDS:
                    blocks.append(count_block(block))
                    block, size = [], 0
            blocks.append(count_block(block))
        trim_memory()
        return pa.StructArray.from_arrays([pa.array(np.concatenate([b[c] for b in blocks])) for c in COUNTS], names=COUNTS)

    return of(text)


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


def scores(c: Column) -> list[tuple[str, float, Column]]:
    """(rule, its largest cutoff, score) of the counts struct; high is bad."""
    per_word = lambda n: F.coalesce(F.try_divide(c[n], c["n_words"]), F.lit(0.0))
    return [
        ("symbols", 2.0, per_word("n_symbols")),
        ("dup_lines", 1.0, F.coalesce(F.try_divide(c["n_dup_lines"], c["n_lines"]), F.lit(0.0))),
        ("repeats", 0.5, per_word("n_repeat_words")),
        ("upper", 1.0, per_word("n_upper")),
        ("echo", 1.0, per_word("n_echo")),
        ("word_length", 40.0, per_word("word_chars")),
        ("long_words", 1.0, per_word("n_long")),
        ("few_words", 1.0, F.lit(1.0) - F.coalesce(F.try_divide(c["n_distinct"], c["n_words"]), F.lit(1.0))),
    ]


def bins(c: Column) -> Column:
    """Per rule, how many steps of its grid the score exceeds."""
    steps = [F.least(F.lit(GRID + 1), F.ceil(s * GRID / top)).cast("int") for _, top, s in scores(c)]
    return F.array(*steps)


def _stratum(docs: DataFrame, strata: list[str]) -> Column:
    """The named columns that ``docs`` has, as one string; null is a stratum."""
    own = [F.coalesce(F.concat(F.lit("="), col(docs, s).cast("string")), F.lit("")) for s in strata if s in docs.columns]
    return F.concat_ws("\x1f", *own) if own else F.lit("")


def binomial_tail(n: int, k: int, p: float) -> float:
    """P(Bin(n, p) <= k), exact up to float rounding."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
            for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def fit(features: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA,
        id_col: str = "doc_id", good_col: str = "quality") -> DataFrame:
    """Cutoffs: rows (stratum, level, cuts), a row per stratum that has any.

    ``features``: rows (id, stratum, text_key, failed, bins), of the labelled documents at
    least. ``cuts`` are grid steps by rule; a document whose step exceeds any is rejected."""
    marks = labels.groupBy(col(labels, id_col).alias("id")).agg(F.min(col(labels, good_col)).alias("good")) \
        .where("good in (0, 1)")
    held = features.where(~F.col("failed")).join(marks, "id").groupBy("stratum", "text_key") \
        .agg(F.first("bins").alias("bins"), F.min("good").alias("good")) \
        .select("stratum", "bins", "good", F.least(F.pmod("text_key", F.lit(FIRST)), F.lit(1)).alias("half"))
    held = stored(held, "quality-held")
    n_rules = len(scores(F.struct(*[F.lit(0).alias(c) for c in COUNTS])))
    hist = held.where("half = 0 and good = 1").select("stratum", F.posexplode("bins").alias("rule", "bin")) \
        .groupBy("stratum", "rule", "bin").agg(F.count("*").alias("n"))
    by_rule = W.partitionBy("stratum", "rule")
    shares = hist.select(
        "stratum", "rule", "bin",
        (F.sum("n").over(by_rule.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1))
         / F.sum("n").over(by_rule)).alias("above"))
    shares = shares.withColumn("above", F.coalesce("above", F.lit(0.0)))
    # the smallest step that rejects at most the level's share
    levels = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.lit(q).alias("q"), F.lit(m).alias("margin"))
                                 for i, (q, m) in enumerate(LEVELS)]))
    cuts = shares.select("*", levels.alias("l")).where(F.col("above") <= F.col("l.q")) \
        .groupBy("stratum", "l.level", "l.margin", "rule").agg(F.min("bin").alias("cut")) \
        .groupBy("stratum", "level").agg(F.array_sort(F.collect_list(
            F.struct("rule", (F.col("cut") + F.col("margin")).alias("cut")))).alias("c")) \
        .where(F.size("c") == n_rules).select("stratum", "level", F.col("c.cut").alias("cuts"))
    # second holdout: patterns of bins are counted before they meet the cutoffs
    patterns = held.where("half = 1").groupBy("stratum", "bins", "good").agg(F.count("*").alias("n"))
    out = rejected(F.col("bins"), F.col("cuts"))
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    tests = patterns.join(cuts, "stratum").groupBy("stratum", "level", "cuts").agg(
        total(F.col("good") == 1).alias("n"), total((F.col("good") == 1) & out).alias("k"),
        total((F.col("good") == 0) & out).alias("caught"))

    @F.pandas_udf("double")
    def p_value(n: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(a), int(b), risk) for a, b in zip(n, k)], dtype="float64")

    n_strata = held.select("stratum").distinct().count() or 1
    seq = W.partitionBy("stratum").orderBy("level")
    p = stored(tests.withColumn("p", p_value("n", "k")).withColumn("worst", F.max("p").over(seq))
               .withColumn("tested", F.row_number().over(seq)).where(F.col("tested") == F.col("level") + 1), "quality-tests")
    # Holm: strata in the order of their last level's p; one row per stratum
    ends = W.orderBy("all")
    done = p.where(F.col("level") == len(LEVELS) - 1).select("stratum", F.col("worst").alias("all")) \
        .withColumn("rest", F.lit(n_strata) - F.row_number().over(ends) + 1) \
        .withColumn("fails", F.sum((F.col("all") > delta / F.col("rest")).cast("int")).over(ends)) \
        .where("fails = 0").count()
    ok = p.where(F.col("worst") <= delta / max(1, n_strata - done))
    return ok.groupBy("stratum").agg(F.max_by(F.struct("level", "cuts"), F.struct("caught", -F.col("level"))).alias("s")) \
        .select("stratum", "s.level", "s.cuts")


def rejected(steps: Column, cuts: Column) -> Column:
    return F.exists(F.zip_with(steps, cuts, lambda b, c: b > c), lambda x: x)


def with_cuts(rows: DataFrame, cuts: DataFrame, stratum: str, max_bytes: int = 64 << 20) -> DataFrame:
    """Left join of ``rows`` with the stratum's cutoffs; broadcast if their
    measured size allows it."""
    size = cuts.agg(F.sum(F.octet_length("stratum") + 4 * F.size("cuts") + 64).alias("b")).first()["b"] or 0
    c = cuts.select(F.col("stratum").alias(stratum), F.col("cuts").alias(stratum + "_cuts"))
    return rows.join(F.broadcast(c) if size <= max_bytes else c, stratum, "left")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             strata: list[str] = ["lang"]) -> DataFrame:  # noqa: B006
    """Stored rows (id, stratum, text_key, counts, failed, bins) of all documents."""
    d = docs.select(col(docs, id_col).alias("id"), _stratum(docs, strata).alias("stratum"),
                    F.xxhash64(col(docs, text_col)).alias("text_key"), counts(col(docs, text_col)).alias("counts"))
    c = F.col("counts")
    return stored(d, "quality").select("*", base_failed(c).alias("failed"), bins(c).alias("bins"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          strata: list[str] = ["lang"], risk: float = RISK, delta: float = DELTA) -> DataFrame:  # noqa: B006
    """One row per document: (id, stratum, counts, failed, kept)."""
    f = features(docs, id_col, text_col, strata)
    cuts = stored(fit(f, labels, risk, delta), "quality-cuts")
    out = F.coalesce(rejected(F.col("bins"), F.col("stratum_cuts")), F.lit(False))
    return with_cuts(f, cuts, "stratum").select("id", "stratum", "counts", "failed", (~F.col("failed") & ~out).alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         strata: list[str] = ["lang"], risk: float = RISK, delta: float = DELTA) -> DataFrame:  # noqa: B006
    """``docs`` with its own columns, without the documents that the rules reject."""
    rows = stored(docs.select(
        F.struct(*[col(docs, c) for c in docs.columns]).alias("row"), col(docs, id_col).alias("id"),
        _stratum(docs, strata).alias("stratum"), F.xxhash64(col(docs, text_col)).alias("text_key"),
        counts(col(docs, text_col)).alias("counts")), "quality-rows")
    c = F.col("counts")
    f = rows.select("id", "stratum", "text_key", base_failed(c).alias("failed"), bins(c).alias("bins"))
    cuts = stored(fit(f, labels, risk, delta), "quality-cuts")
    out = F.coalesce(rejected(bins(c), F.col("stratum_cuts")), F.lit(False))
    return with_cuts(rows, cuts, "stratum").where(~base_failed(c) & ~out).select("row.*")


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; cutoffs fitted per language."""
    j = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    base = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
    return j.select(F.col("id").alias("doc_id"), *[F.col(f"counts.{c}").alias(c) for c in base],
                    F.col("failed").alias("base_failed"), "kept")
