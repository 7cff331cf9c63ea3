"""Text analytics (TXT-1..6): word count, corpus crawl, inverted indexes.

Tokens come from ``java_split`` so they equal the reference's, empty tokens
included (``drop_empty`` removes them). Counting is a hash aggregate with a
map-side combine, so a very common word is pre-summed in every task before the
shuffle. Postings are kept as rows ``(word, doc, n)``; ranking them within a
word uses one range-partitioned global sort, which splits a hot word over many
tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.fixed_values import (
    CRAWL_LINE_BREAK, INDEX_SPLIT, INDEX_TOKEN_CHAR, POSTING_FORMAT, POSTING_SEPARATOR, TOKENIZER_LEAKS, WORD_SPLIT,
)
from tessera.functions.strings import as_col, explode_split, java_trim, split_lines
from tessera.operators.joins import anti_join_small
from tessera.session import shared_dir


def lines_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents -> one row per line (``value``), cut like a Hadoop text reader."""
    return docs.select(F.explode(split_lines(F.col(text_col))).alias("value"))


def words(df: DataFrame, text_col: str = "value", pattern: str = WORD_SPLIT,
          lowercase: bool = True, drop_empty: bool = False, keep=()) -> DataFrame:
    """One row per token: ``keep`` columns + ``word``."""
    t = F.lower(F.col(text_col)) if lowercase else F.col(text_col)
    return explode_split(df, t, pattern, keep, "word", drop_empty)


def word_count(df: DataFrame, text_col: str = "value", drop_empty: bool = False) -> DataFrame:
    """(word, count) over all records: lowercase, split on ``\\W+`` (TXT-1)."""
    return words(df, text_col, drop_empty=drop_empty).groupBy("word").count()


def normalize_text(c) -> F.Column:
    """``text.trim.replaceAll("\\s*\\n\\s*", " ")``: one line per document."""
    return F.regexp_replace(java_trim(as_col(c)), CRAWL_LINE_BREAK, " ")


def crawl(files: DataFrame, path_col: str = "path", text_col: str = "text",
          base: str | None = None) -> DataFrame:
    """(id, text) per document (TXT-2): id is the path after ``base`` when the
    path contains it, else the whole path; text becomes a single line."""
    p = as_col(path_col)
    if base:
        rel = F.substring_index(p, base, -1)
        ident = F.when(F.instr(p, base) > 0, rel).otherwise(p)
    else:
        ident = p
    return files.select(java_trim(ident).alias("id"), normalize_text(text_col).alias("text"))


def index_tokens(docs: DataFrame, doc_col: str = "doc", text_col: str = "text",
                 lowercase: bool = True, normalize_quotes: bool = False) -> DataFrame:
    """(word, doc) per token of ``trim(text).split("[^\\w']")``."""
    t = F.lower(F.col(text_col)) if lowercase else F.col(text_col)
    if normalize_quotes:
        t = F.translate(t, "’", "'")
    return explode_split(docs, java_trim(t), INDEX_SPLIT, [F.col(doc_col).alias("doc")])


def documents_with_tokens(docs: DataFrame, text_col: str = "text") -> int:
    """Documents that ``index_tokens`` gives at least one token, without cutting
    them: all but null ones and those made of separators only."""
    t = java_trim(F.lower(F.col(text_col)))
    return docs.where((t == "") | t.rlike(INDEX_TOKEN_CHAR)).count()


def postings(tokens: DataFrame, stop_words: DataFrame | None = None) -> DataFrame:
    """(word, doc, n): occurrences of each word per document (TXT-3).

    ``stop_words`` (column ``word``) is removed before counting with a
    broadcast anti join when the list is small (TXT-5)."""
    if stop_words is not None:
        tokens = anti_join_small(tokens, stop_words, "word")
    return tokens.groupBy("word", "doc").agg(F.count(F.lit(1)).alias("n"))


def remove_words(df: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Rows whose ``word`` is not a stop word (broadcast anti join when small).
    Filtering postings equals filtering tokens before counting."""
    return anti_join_small(df, stop_words, "word")


def sorted_postings(post: DataFrame) -> DataFrame:
    """Postings ordered by word, then count descending, then doc (TXT-4/5)."""
    return post.orderBy("word", F.desc("n"), "doc")


def rank_postings(post: DataFrame) -> DataFrame:
    """Add ``rank`` (1-based) of each posting within its word by (n desc, doc).

    One way for every word: the postings are range-sorted by (word, n desc,
    doc), so a hot word spans several partitions and no task gathers a word.
    Each task numbers the postings of a word as they pass, and the sorted rows are written once.
    A word that began in an earlier partition is the first of its partition, so
    the offsets have a row per partition at most, from its first and last row; no posting is moved again."""
    spark = post.sparkSession
    path = shared_dir(spark, "postings")
    rows = sorted_postings(post).select("word", "doc", "n")
    schema = T.StructType([*rows.schema.fields, T.StructField("_pid", T.IntegerType()),
                           T.StructField("_at", T.LongType()), T.StructField("_edge", T.BooleanType())])
    rows.mapInArrow(_numbered, schema).write.parquet(path)
    s = spark.read.parquet(path)
    # the edges are the first row of a task and the last of each of its batches, among them the task's last
    edge = s.where("_edge").groupBy("_pid").agg(F.min("word").alias("_first"), F.max(F.struct("word", "_at")).alias("_last"))
    ends = edge.select(F.col("_pid").alias("_p"), F.col("_last.word").alias("word"), F.col("_last._at").alias("_n"))
    starts = edge.select("_pid", F.col("_first").alias("word"))
    before = (starts.join(ends, "word").where(F.col("_p") < F.col("_pid")).groupBy("_pid", "word")
              .agg(F.sum("_n").alias("_before")))
    return (s.join(F.broadcast(before), ["_pid", "word"], "left")
            .select("word", (F.coalesce("_before", F.lit(0)) + F.col("_at")).alias("rank"), "doc", "n"))


def _numbered(batches):
    """Sorted postings of a task with ``_pid``, the task's partition, ``_at``, the 1-based place
    of a posting among those of its word in the task, and ``_edge`` (see ``rank_postings``)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark import TaskContext
    pid, word, seen, first = TaskContext.get().partitionId(), None, 0, True
    for b in batches:
        rows = b.num_rows
        if not rows:
            continue
        w = b.column(0)
        new = np.ones(rows, bool)       # rows at which a word begins
        new[1:] = pc.fill_null(pc.not_equal(w.slice(1), w.slice(0, rows - 1)), True).to_numpy(zero_copy_only=False)
        if not first and w[0].as_py() == word:
            new[0] = False
        places = np.arange(rows)
        starts = np.maximum.accumulate(np.where(new, places, -seen))
        at = places - starts + 1
        edge = np.zeros(rows, bool)
        edge[-1] = True
        edge[0] |= first
        word, seen, first = w[rows - 1].as_py(), int(at[-1]), False
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(rows, pid, np.int32)), pa.array(at), pa.array(edge)],
                                         [*b.schema.names, "_pid", "_at", "_edge"])


def postings_lines(ranked: DataFrame, per_line: int = 1000) -> DataFrame:
    """The reference's text form ``(doc,n), (doc,n), ...`` per word, cut into
    lines of at most ``per_line`` postings: (word, part, postings)."""
    part = F.floor((F.col("rank") - 1) / per_line).cast("int")
    item = F.struct(F.col("rank"), F.format_string(POSTING_FORMAT, F.col("doc"), F.col("n")).alias("s"))
    return (ranked.groupBy("word", part.alias("part"))
            .agg(F.array_sort(F.collect_list(item)).alias("_items"))
            .select("word", "part",
                    F.array_join(F.transform("_items", lambda x: x["s"]), POSTING_SEPARATOR).alias("postings")))


def stop_words_frame(spark: SparkSession, words_list) -> DataFrame:
    """A one-column (``word``) DataFrame from a list of stop words."""
    return spark.createDataFrame([(w,) for w in dict.fromkeys(words_list)], "word string")


def load_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """Stop words from a text file, one per line (lines starting ``#`` skipped)."""
    return (spark.read.text(path).where(~F.col("value").startswith("#"))
            .select(F.col("value").alias("word")).distinct())


def frequent_words(post: DataFrame, ndocs, min_doc_fraction: float = 0.5) -> DataFrame:
    """Stop words by rule: words found in at least ``min_doc_fraction`` of the
    documents, plus the tokenizer leaks. ``post`` holds one row per
    (word, doc). The result has at most 1/fraction times the mean number of
    distinct words per document. ``ndocs`` is the document total, a number or a
    column (a scalar subquery over the documents)."""
    common = (post.groupBy("word").agg(F.count(F.lit(1)).alias("_df"))
              .where(F.col("_df") >= (F.lit(ndocs) if isinstance(ndocs, int) else ndocs) * F.lit(min_doc_fraction))
              .select("word"))
    leaks = post.sparkSession.createDataFrame([(w,) for w in TOKENIZER_LEAKS], "word string")
    return common.unionByName(leaks).distinct()
