"""Benchmark decontamination with DataFrame functions only.

The benchmark is normalised (A-Z lower-cased, words are runs of ASCII letters,
digits and non-ASCII characters) and cut into windows of ``window`` consecutive
words; an item with fewer words is one window. Each distinct window gets a
64-bit hash. Documents are scanned window by window, the hashes are probed
against the benchmark's hash set (broadcast once its size is proven, else joined
by a shuffle of hashes and places alone), and every probe that matches is verified by
comparing the words themselves, so hash collisions do no harm.

A document word is hit if it lies in any occurrence of a window. A document is
contaminated if it has hits and they are at least 1/``share`` of its words.

Defined cases. Null or word-less texts have no words and are never contaminated.
Null or word-less items have no window; an item without an id still marks words
but is not listed or counted. Repeated documents each get their own row; rows
with equal id and text get equal results. Ids may be null. Extra columns of the
inputs are ignored by ``scan`` and kept by ``decontaminate``, whatever their
names. Empty tables give empty results.

Scale: with a broadcast benchmark, one scan of the documents; texts are never
shuffled. What moves is one row per document and one per occurrence of a window, keyed
by document, so a hot passage costs its occurrences and no more. The group of one
document is bounded by its own word count. Beyond ``max_broadcast_bytes`` the documents
are scanned twice, and 28 bytes per window and the texts' words once are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, col, fresh, stored, table
from tessera.llm.registry import query

WINDOW = 13
SHARE = 20
# fixed by the contract: what separates words (before and after lower-casing)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PARTS = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"


def words_of(text: Column) -> Column:
    """The normalised words of a text; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), SEPARATORS), "")


def benchmark_windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """Rows (len, h, gram, item): every window of every item."""
    w = benchmark.select(col(benchmark, item_col).alias("item"), words_of(col(benchmark, text_col)).alias("words")) \
        .where(F.size("words") > 0) \
        .withColumn("len", F.least(F.size("words"), F.lit(window)))
    at = F.sequence(F.lit(1), F.size("words") - F.col("len") + 1)
    return w.select("item", "len", "words", F.explode(at).alias("at")) \
        .select("item", "len", F.slice("words", F.col("at"), F.col("len")).alias("gram")) \
        .withColumn("h", F.xxhash64("gram"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k, text): k is the text's hash, so id and k name equal rows."""
    text = col(docs, text_col)
    return docs.select(col(docs, id_col).alias("id"), F.xxhash64(text).alias("k"), text.alias("text"))


def _windows(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """``docs`` (with ``words``) by window: adds (len, at); a document with no window
    of a length has one row of that length, ``at`` null."""
    if len(lengths) == 1:
        w = docs.withColumn("len", F.lit(lengths[0]))
    else:
        w = docs.select("*", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("len"))
    starts = F.when(F.size("words") >= F.col("len"), F.sequence(F.lit(1), F.size("words") - F.col("len") + 1))
    return w.select("*", F.explode_outer(starts).alias("at"))


def _with_words(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("rid"), "id", "k", words_of(F.col("text")).alias("words")) \
        .withColumn("n_words", F.size("words").cast("long"))


def _probe(docs: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """One scan of all windows against a broadcast hash set. Rows (rid, id, k, n_words,
    at, len, h, found, gram): one with null ``h`` or a match per document, and one per
    match of a window's hash. Everything from the scan to the probe is one generated stage."""
    w = _windows(_with_words(docs), lengths) \
        .withColumn("found", F.slice("words", F.coalesce("at", F.lit(1)), F.col("len"))) \
        .withColumn("probe", F.when(F.col("at").isNotNull(), F.xxhash64("found")))
    one_per_doc = (F.col("len") == min(lengths)) & (F.coalesce("at", F.lit(1)) == 1)
    return w.join(F.broadcast(grams), F.col("probe") == grams["h"], "left") \
        .where(F.col("h").isNotNull() | one_per_doc) \
        .select("rid", "id", "k", "n_words", "at", "len", "h",
                F.when(F.col("h").isNotNull(), F.col("found")).alias("found"), "gram")


def _probe_shuffled(docs: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """The rows of ``_probe`` for a benchmark too large to broadcast, in two steps. First
    hashes only: what is shuffled per window is its hash, place and document's key, and
    documents without a window send nothing. Then the matches go back to their documents,
    where the words are cut out again, and meet the benchmark's words for the check;
    documents without a match are dealt by their row, so they do not meet in one task."""
    probes = _windows(docs.select("id", "k", words_of(F.col("text")).alias("words")), lengths).where("at is not null") \
        .select("id", "k", "at", "len", F.xxhash64(F.slice("words", F.col("at"), F.col("len"))).alias("h"))
    met = probes.join(grams.select("h").distinct(), "h") \
        .groupBy(F.col("id").alias("met_id"), F.col("k").alias("met_k")).agg(F.collect_set(F.struct("at", "len", "h")).alias("met"))
    rows = _with_words(docs).join(met, F.col("id").eqNullSafe(F.col("met_id")) & (F.col("k") == F.col("met_k")), "left") \
        .select("rid", "id", "k", "n_words", "words", F.explode_outer("met").alias("m")) \
        .select("rid", "id", "k", "n_words", "m.at", "m.len", "m.h",
                F.when(F.col("m").isNotNull(), F.slice("words", F.coalesce("m.at", F.lit(1)), F.coalesce("m.len", F.lit(1)))).alias("found"))
    known = grams.select(F.col("h").alias("gram_h"), "gram", F.lit(True).alias("is_gram"))
    same = (F.coalesce("h", "rid") == F.col("gram_h")) & (F.col("h").isNotNull() == F.col("is_gram"))
    return rows.join(known, same, "left").select("rid", "id", "k", "n_words", "at", "len", "h", "found", "gram")


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
         share: int = SHARE, max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """One row per document: (id, k, n_words, spans, n_hit, items, contaminated).

    ``spans`` are (at, len) in words, 1-based; ``items`` the ids, as strings.
    ``id`` and ``k`` (the text's hash) name a document's rows."""
    wins = benchmark_windows(benchmark, item_col, item_text_col, window)
    size = wins.agg(F.collect_set("len").alias("lens"),
                    F.sum(F.size("gram") * 24 + F.octet_length(F.array_join("gram", "")) + 64).alias("bytes")).first()
    small = (size["bytes"] or 0) <= max_broadcast_bytes
    mark, probe = (F.broadcast, _probe) if small else ((lambda d: d), _probe_shuffled)
    # the probe's few rows are used twice below and come from a scan of all texts: stored
    rows = stored(probe(_keyed(docs, id_col, text_col), wins.select("h", "gram").distinct(),
                        sorted(size["lens"]) or [window]), "decontam-probe")
    hit = F.col("found") == F.col("gram")  # the words themselves, not their hash
    span = F.when(hit, F.struct("at", "len"))
    per_doc = rows.groupBy("rid", "id", "k", "n_words").agg(F.array_sort(F.collect_set(span)).alias("spans"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate("spans", zero, lambda acc, s: F.struct(
        F.greatest(acc["end"], s["at"] + s["len"] - 1).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), s["at"] + s["len"] - 1 - F.greatest(acc["end"], s["at"] - 1))).alias("n")))
    items = rows.where(hit).select("rid", "h", "gram").distinct() \
        .join(mark(wins.select("h", "gram", "item").distinct()), ["h", "gram"]) \
        .groupBy("rid").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    return per_doc.withColumn("n_hit", covered["n"].cast("long")) \
        .join(items, "rid", "left") \
        .select("id", "k", "n_words", "spans", "n_hit",
                F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"))


def _without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words of ``spans`` and what follows each such word
    up to the next one."""
    parts = F.regexp_extract_all(text, F.lit(PARTS), F.lit(1))
    lead = F.when(text.rlike("^" + WORD_ANY_CASE), F.lit(0)).otherwise(F.lit(1))
    # part i (0-based) belongs to word floor((i - lead) / 2) + 1; a leading separator to word 0
    word = lambda i: F.floor((i - lead) / 2) + 1
    kept = F.filter(parts, lambda p, i: ~F.exists(spans, lambda s: (word(i) >= s["at"]) & (word(i) < s["at"] + s["len"])))
    return F.array_join(kept, "")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  share: int = SHARE, remove: str = "documents", max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` with its own columns, without contamination.

    ``remove="documents"`` drops contaminated documents; ``remove="spans"``
    keeps them and cuts the hit words out of their texts."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: documents or spans, not {remove!r}")
    bad = scan(docs, benchmark, id_col, text_col, item_col, item_text_col, window, share, max_broadcast_bytes) \
        .where("contaminated").dropDuplicates(["id", "k"])
    i, k, s = fresh(docs, "bad_id", "bad_k", "bad_spans")
    bad = bad.select(F.col("id").alias(i), F.col("k").alias(k), F.col("spans").alias(s))
    text = col(docs, text_col)
    same = col(docs, id_col).eqNullSafe(bad[i]) & F.xxhash64(text).eqNullSafe(bad[k])
    if remove == "documents":
        return docs.join(bad, same, "left_anti")
    cut = F.when(bad[i].isNull() & bad[k].isNull(), text).otherwise(_without_spans(text, bad[s]))
    return docs.join(bad, same, "left").select(
        *[cut.alias(c) if c == text_col else col(docs, c) for c in docs.columns])


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
b2 AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b2)),
lens AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT rid, dw.n, i, item_id FROM dw JOIN win ON dw.n = win.n AND dw.gram = win.gram),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit
        FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(it, ',' ORDER BY it) AS s
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS it FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""


@query("op5_benchmark_decontamination", SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark, windows of 13 words."""
    r = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return r.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
