"""Text queries over the corpus stand-in (documents): word counts, crawl,
inverted indexes (programs of modules 1 and 2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.fixed_values import TOKENIZER_LEAKS
from tessera.operators import sinks
from tessera.operators import text as tx
from tessera.operators.joins import dealt_by_document
from tessera.plans.registry import query
from tessera.session import shared_dir
from tessera.sources.files import read_lines, read_listed_files, write_whole_files
from tessera.sources.parsers import parse_pairs
from tessera.sources.tables import Tables, read_table

STOP_DOC_FRACTION = 0.5     # stop words by rule: in at least half the documents
LINE_POSTINGS = 1000        # postings per output line


# ---------------------------------------------------------------- SQL helpers

def sql_java_split(s: str, pat: str) -> str:
    """Java ``String.split`` in DuckDB: drop trailing empty tokens."""
    pat = pat.replace("'", "''")
    return (f"(CASE WHEN {s} = '' THEN [''] "
            f"WHEN regexp_full_match({s}, '(?:{pat})+') THEN []::VARCHAR[] "
            f"ELSE string_split_regex(regexp_replace({s}, '(?:{pat})+$', ''), '{pat}') END)")


def sql_java_trim(s: str) -> str:
    return f"regexp_replace({s}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


SQL_SPACE = "[ \\t\\n\\x0B\\f\\r]"


def sql_normalize(s: str) -> str:
    return f"regexp_replace({sql_java_trim(s)}, '{SQL_SPACE}*\\n{SQL_SPACE}*', ' ', 'g')"


SQL_LINES = ("(CASE WHEN text = '' THEN []::VARCHAR[] ELSE string_split_regex("
             "regexp_replace(text, '(\\r\\n|\\n|\\r)\\z', ''), '\\r\\n|\\n|\\r') END)")

DOCS_CTE = f"""docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS doc, {sql_normalize('text')} AS text FROM documents)"""

TOKENS_CTE = DOCS_CTE + f""",
tok AS (
  SELECT unnest({sql_java_split(sql_java_trim('lower(text)'), "[^\\w']")}) AS word, doc FROM docs)"""

POSTINGS_CTE = TOKENS_CTE + """,
post AS (SELECT word, doc, COUNT(*) AS n FROM tok GROUP BY word, doc)"""

STOP_CTE = TOKENS_CTE + f""",
post_all AS (SELECT word, doc FROM tok GROUP BY word, doc),
stop AS (
  SELECT word FROM post_all GROUP BY word
  HAVING COUNT(*) >= (SELECT COUNT(DISTINCT doc) FROM post_all) * {STOP_DOC_FRACTION}
  UNION SELECT unnest(['', '''', '_'])),
post AS (
  SELECT word, doc, COUNT(*) AS n FROM tok
  WHERE word NOT IN (SELECT word FROM stop) GROUP BY word, doc)"""


# ---------------------------------------------------------------- word count

@query("word_count", f"""
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest({sql_java_split('lower(text)', '\\W+')}) AS word FROM documents)
GROUP BY word""")
def word_count(spark, sf_dir):
    """Word count with each document as one record."""
    return tx.word_count(Tables(spark, sf_dir).documents, "text")


@query("word_count_lines", f"""
SELECT word, COUNT(*) AS count FROM (
  SELECT unnest({sql_java_split('lower(line)', '\\W+')}) AS word FROM (
    SELECT unnest({SQL_LINES}) AS line FROM documents))
GROUP BY word""")
def word_count_lines(spark, sf_dir):
    """Word count over text lines, as when the corpus is read as a text file."""
    return tx.word_count(tx.lines_of(Tables(spark, sf_dir).documents, "text"), "value")


# ---------------------------------------------------------------- crawl

@query("crawl_normalize", f"""
SELECT CAST(doc_id AS VARCHAR) AS id, {sql_normalize('text')} AS text FROM documents""")
def crawl_normalize(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents.select(F.col("doc_id").cast("string").alias("path"), "text")
    return tx.crawl(docs, "path", "text")


@query("crawl_files", f"""
SELECT CAST(doc_id AS VARCHAR) AS id, {sql_normalize('text')} AS text FROM documents""")
def crawl_files(spark, sf_dir):
    """Documents written as files, one a row, in a bounded number of folders by tasks that
    record the paths; the listed files are read whole and crawled: the id is the part
    of the path after a base (SRC-2, STR-7, TXT-2). The driver lists no folder."""
    paths = write_whole_files(Tables(spark, sf_dir).documents, shared_dir(spark, "corpus-files"), "doc_id", "text")
    found = tx.crawl(read_listed_files(paths, spark.sparkContext.defaultParallelism), base="/doc=")
    return found.select(F.substring_index("id", "@", 1).alias("id"), "text")


@query("tuple_lines", f"""
SELECT word, CAST(COUNT(*) AS VARCHAR) AS count FROM (
  SELECT unnest({sql_java_split('lower(text)', '\\W+')}) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def tuple_lines(spark, sf_dir):
    """Word counts written as ``(word,count)`` lines, written again over the first
    output, and parsed back (SNK-1, SNK-2, SRC-13)."""
    path = shared_dir(spark, "counts-text")
    counts = tx.word_count(Tables(spark, sf_dir).documents, "text", drop_empty=True)
    sinks.write_tuples(counts.limit(3), path)     # a leftover that the next write replaces
    sinks.write_tuples(counts, path)
    return parse_pairs(read_lines(spark, path)).good.toDF("word", "count")


# ---------------------------------------------------------------- inverted indexes

def _postings(spark, sf_dir):
    """(word, doc, n) of the crawled corpus: counted by the numeric document id,
    which becomes the text id of the crawl afterwards. Only texts are moved."""
    docs = dealt_by_document(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return (tx.postings(tx.index_tokens(docs.select(F.col("doc_id").alias("doc"), tx.normalize_text("text").alias("text"))))
            .select("word", F.col("doc").cast("string").alias("doc"), "n"))


def _doc_total(spark, sf_dir):
    """Documents that have a token: all but those of separators only."""
    docs = Tables(spark, sf_dir).documents.select(tx.normalize_text("text").alias("text"))
    return tx.documents_with_tokens(docs)


@query("inverted_index_postings", "WITH " + POSTINGS_CTE + "\nSELECT word, doc, n FROM post")
def inverted_index_postings(spark, sf_dir):
    return _postings(spark, sf_dir)


@query("inverted_index", "WITH " + POSTINGS_CTE + """
SELECT word, row_number() OVER (PARTITION BY word ORDER BY n DESC, doc) AS rank, doc, n
FROM post""")
def inverted_index(spark, sf_dir):
    """Postings ranked within each word by count, then document."""
    return tx.rank_postings(_postings(spark, sf_dir))


@query("inverted_index_lines", "WITH " + POSTINGS_CTE + f""",
ranked AS (SELECT word, row_number() OVER (PARTITION BY word ORDER BY n DESC, doc) AS rank,
                  doc, n FROM post)
SELECT word, CAST(floor((rank - 1) / {LINE_POSTINGS}) AS INTEGER) AS part,
       string_agg('(' || doc || ',' || CAST(n AS VARCHAR) || ')', ', ' ORDER BY rank) AS postings
FROM ranked GROUP BY ALL""")
def inverted_index_lines(spark, sf_dir):
    ranked = tx.rank_postings(_postings(spark, sf_dir))
    return tx.postings_lines(ranked, LINE_POSTINGS)


@query("inverted_index_stopwords", "WITH " + STOP_CTE + """
SELECT word, row_number() OVER (PARTITION BY word ORDER BY n DESC, doc) AS rank, doc, n
FROM post""")
def inverted_index_stopwords(spark, sf_dir):
    """Ranked postings without stop words; stop words = words in at least half
    of the documents plus the tokenizer leaks."""
    # the postings feed the document frequencies and the ranking: written once
    path = shared_dir(spark, "postings-all")
    _postings(spark, sf_dir).write.parquet(path)
    post_all = spark.read.parquet(path)
    stop = tx.frequent_words(post_all, _doc_total(spark, sf_dir), STOP_DOC_FRACTION)
    return tx.rank_postings(tx.remove_words(post_all, stop))


STOP_FILE_LETTERS = 4       # the list in the file: benchmark words of at most so many letters


@query("inverted_index_stop_file", "WITH " + TOKENS_CTE + f""",
stop AS (
  SELECT DISTINCT word FROM (
    SELECT unnest({sql_java_split(sql_java_trim('lower(text)'), "[^\\w']")}) AS word FROM benchmark)
  WHERE length(word) <= {STOP_FILE_LETTERS}
  UNION SELECT unnest(['', '''', '_'])),
post AS (
  SELECT word, doc, COUNT(*) AS n FROM tok
  WHERE word NOT IN (SELECT word FROM stop) GROUP BY word, doc)
SELECT word, row_number() OVER (PARTITION BY word ORDER BY n DESC, doc) AS rank, doc, n
FROM post""")
def inverted_index_stop_file(spark, sf_dir):
    """Ranked postings without the words of a list in a text file, one per line, which is
    read by its path (TXT-5, TXT-6). The file stands in for the fixed list: the short words of
    the benchmark's texts and the tokenizer leaks, under a line of comment."""
    short = (tx.index_tokens(Tables(spark, sf_dir).benchmark, "item_id")
             .where(F.length("word") <= STOP_FILE_LETTERS).select("word").distinct())
    path = shared_dir(spark, "stop-words")
    (tx.stop_words_frame(spark, ["# short words", *TOKENIZER_LEAKS]).union(short)
     .select(F.col("word").alias("value")).write.text(path))
    return tx.rank_postings(tx.remove_words(_postings(spark, sf_dir), tx.load_stop_words(spark, path)))


@query("stop_words_by_rule", "WITH " + STOP_CTE + "\nSELECT word FROM stop")
def stop_words_by_rule(spark, sf_dir):
    return tx.frequent_words(_postings(spark, sf_dir), _doc_total(spark, sf_dir), STOP_DOC_FRACTION)
