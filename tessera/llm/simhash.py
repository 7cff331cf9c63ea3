"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's fingerprint has a bit set where over half of its shingles' 64-bit hashes
have it. To link fingerprints within ``radius`` bits, every distinct fingerprint
emits all variants within half the radius (rounded up): two fingerprints within
the radius share a variant. Variants are shuffled, the fingerprints that meet in
a variant form pairs, pairs are made distinct and verified by their bit distance.

Documents with one fingerprint are one node, so a group of exact copies, however
large, emits one ball; a variant can only be reached from its own ball (65
fingerprints for radius 2), which bounds every bucket without a cap. Components
come from alternating large-star and small-star steps over the links, each step
stored in the shared folder; nothing but a row count and a checksum reaches the
driver.

Defined cases. Null, empty and word-less texts have fingerprint zero and link
like any other. A text with fewer words than a shingle is one shingle. Repeated
rows and equal ids are kept (``groups``) or reduced to one row (``deduplicate``);
a null id is a row like any other and loses to any id as a group's
representative. Extra columns may have any name. Empty tables give empty results.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh, stored, table
from tessera.llm.registry import query

SHINGLE = 3
RADIUS = 2
SEED = 42


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of one text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    digest = functools.partial(xxhash.xxh64_intdigest, seed=seed)
    if len(words) <= shingle:
        return digest(b" ".join(words))
    parts = zip(*(itertools.islice(words, i, None) for i in range(shingle)))
    hashes = np.fromiter(map(digest, map(b" ".join, parts)), np.uint64, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):  # the bit matrix of a long text stays small
        block = hashes[i:i + 4096].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """The fingerprint as a (signed) long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64))

    return of(text)


def masks(half: int) -> list[int]:
    """All 64-bit masks with at most ``half`` bits, as signed longs."""
    out = []
    for n in range(half + 1):
        for bits in itertools.combinations(range(64), n):
            m = sum(1 << b for b in bits)
            out.append(m - (1 << 64) if m >> 63 else m)
    return out


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct pairs (a < b) of the fingerprints in column ``fp`` that differ
    in 1 to ``radius`` bits."""
    distinct = prints.select("fp").distinct()
    if radius == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where(F.lit(False))
    ball = F.explode(F.array(*[F.lit(m).cast("long") for m in masks((radius + 1) // 2)]))
    variants = distinct.select("fp", ball.alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("variant"))
    earlier = F.collect_list("fp").over(
        W.partitionBy("variant").orderBy("fp").rowsBetween(W.unboundedPreceding, -1))
    return variants.select(earlier.alias("earlier"), F.col("fp").alias("b")) \
        .where(F.size("earlier") > 0) \
        .select(F.explode("earlier").alias("a"), "b").distinct() \
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Connected components of the links (a, b): rows (node, root), the root
    being the smallest node; nodes without a link are absent."""
    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    # edges are kept as (a > b) or (a, root)
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "cc")
    before = state(e)
    if not before[0]:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(max_rounds):
        s = both(e)  # large star: larger neighbours go to the smallest of the neighbourhood
        m = s.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = s.join(m, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        m = large.groupBy("a").agg(F.min("b").alias("m"))  # small star: smaller neighbours and the node itself
        j = large.join(m, "a")
        small = j.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")) \
            .select("e.a", "e.b").where("a <> b").distinct()
        e = stored(small, "cc")
        after = state(e)
        if after == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
    raise RuntimeError(f"components: no fixed point in {max_rounds} rounds")


def _roots(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, first): the smallest key among all rows that reach ``fp``. ``prints``
    has (key, fp); null ids sort last."""
    per_print = prints.groupBy("fp").agg(F.min("key").alias("key"))
    cc = components(links(per_print, radius))
    rooted = per_print.join(cc, per_print["fp"] == cc["node"], "left") \
        .select("fp", "key", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("key").alias("first"))
    return rooted.select("fp", "root").join(first, "root").select("fp", "first")


def _prints(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int) -> DataFrame:
    """Stored rows (key, fp) of all documents; key is (no id, id, text's hash)."""
    text, i = col(docs, text_col), col(docs, id_col)
    key = F.struct(i.isNull().alias("none"), i.alias("id"), F.xxhash64(text).alias("k"))
    return stored(docs.select(key.alias("key"), fingerprints(text, shingle, seed).alias("fp")), "simhash")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
           radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """One row per document: (id, fp, component): the smallest id reachable."""
    p = _prints(docs, id_col, text_col, shingle, seed)
    return p.join(_roots(p, radius), "fp").select(
        F.col("key.id").alias("id"), "fp", F.col("first.id").alias("component"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """``docs`` with its own columns, one document of each group: that with the
    smallest id (for equal ids, the smallest text hash; of equal rows, any)."""
    p = _prints(docs, id_col, text_col, shingle, seed)
    (kept,) = fresh(docs, "kept_key")
    stay = _roots(p, radius).select(F.col("first").alias(kept)).distinct()
    text, i = col(docs, text_col), col(docs, id_col)
    key = F.struct(i.isNull().alias("none"), i.alias("id"), F.xxhash64(text).alias("k"))
    return docs.withColumn(kept, key).join(stay, kept, "left_semi").dropDuplicates([kept]).drop(kept)


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, 2 bits."""
    g = groups(table(spark, sf_dir, "documents"))
    return g.select(F.col("id").alias("doc_id"), hex16(F.col("fp")).alias("fingerprint"),
                    F.col("component").alias("component_id"))
