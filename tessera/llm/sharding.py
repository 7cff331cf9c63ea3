"""Sharding by a two-pass external shuffle, with DataFrame functions only.

Pass 1 scatters the rows into (shard, bucket): the shard is a seeded
highest-random-weight hash of the id, so id and shard count decide it, and one
more shard takes rows only into itself. Each shard has as many buckets as keep
a bucket near ``bucket_bytes``; a row's bucket is a seeded hash of the row and
of its place in the input, so equal rows, or one id that holds a third of all
rows, still spread over all buckets of their shard. Pass 2 takes each bucket,
puts it into a fixed order, shuffles it by Fisher-Yates (``shuffle``) and writes
it below its shard. The final slot of a row is its bucket's offset plus its place
in the bucket.

Defined cases. A null text counts no bytes and keeps a null checksum of the empty
text (0); a null id goes to one defined shard. Repeated rows are kept, each with
its own slot. An empty table gives an empty result. All other columns of the
input are kept as they are in ``row``, whatever their types.

Scale: one shuffle of the rows, bounded buckets, and a window over one row per
bucket for the offsets. Sizes and bucket count come from all rows. The written
order depends on the seed, the files and their split sizes. Pass 2's table is
written once and then read, so a lost executor repeats tasks, never a slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import col, table
from tessera.llm.registry import query
from tessera.session import shared_dir

SHARDS = 24
SEED = 20_011
BUCKET_BYTES = 16 << 20


def shard_of(key, shards: int, seed: int = SEED):
    """Highest-random-weight shard of a key: growing ``shards`` by one moves
    rows only into the new shard."""
    weights = [F.xxhash64(key, F.lit(seed), F.lit(s)) for s in range(shards)]
    return (F.array_position(F.array(*weights), F.greatest(*weights)) - 1).cast("int") if shards > 1 \
        else F.lit(0)


def scatter_shuffle(docs: DataFrame, out_dir: str, shards: int = SHARDS, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` shuffled into ``out_dir`` (Parquet, ``shard=``/files) and
    return the written rows: (row, size, crc, grown_shard, bucket, at, shard)."""
    text, key = col(docs, text_col), col(docs, id_col)
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")
    total = docs.agg(F.sum(size).alias("b")).first()["b"] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    place = F.monotonically_increasing_id()
    rows = docs.select(
        F.struct(*[col(docs, c) for c in docs.columns]).alias("row"), size.alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        shard_of(key, shards, seed).alias("shard"), shard_of(key, shards + 1, seed).alias("grown_shard"),
        F.xxhash64(F.lit(seed), key, place).alias("draw"), place.alias("place"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "draw"), F.lit(buckets)).cast("int"))
    # a task gets one bucket, by its number, in a fixed order: the seeded shuffle draws the
    # same permutation again when a task is repeated. Only the draws are sorted, so
    # that columns of any type pass
    cells = shards * buckets
    item = F.struct("row", "size", "crc", "grown_shard")
    draws = F.sort_array(F.transform("keys", lambda k, i: F.struct(k["draw"].alias("d"), k["place"].alias("p"), i.alias("i"))))
    drawn = F.shuffle(F.transform(draws, lambda d: d["i"]), seed)
    filled = rows.withColumn("part", (F.col("shard").cast("long") * buckets + F.col("bucket")).cast("int")) \
        .repartitionById(cells, "part") \
        .groupBy("part", "shard", "bucket") \
        .agg(F.collect_list(F.struct("draw", "place")).alias("keys"), F.collect_list(item).alias("rows")) \
        .select("shard", "bucket", "rows", drawn.alias("drawn")) \
        .select("shard", "bucket", F.transform("drawn", lambda i: F.get("rows", i)).alias("items"))
    out = filled.select("shard", "bucket", F.posexplode("items").alias("at", "item")) \
        .select("bucket", "at", "item.row", "item.size", "item.crc", "item.grown_shard", "shard")
    out.write.partitionBy("shard").parquet(out_dir)
    return docs.sparkSession.read.schema(out.schema).parquet(out_dir)


def with_slots(written: DataFrame, bound: int = 1_000_000) -> DataFrame:
    """Add ``slot``: the gapless place of a row in its shard. The bucket offsets
    are one row per bucket; they are broadcast when at most ``bound`` rows."""
    sizes = written.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    last = written.agg(F.max("bucket").alias("b")).first()["b"]
    if last is not None and (last + 1) * 4096 <= bound:
        offsets = F.broadcast(offsets)
    return written.join(offsets, ["shard", "bucket"]) \
        .withColumn("slot", (F.col("offset") + F.col("at")).cast("long")).drop("offset")


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 under the ``key`` law, written and read back."""
    docs = table(spark, sf_dir, "documents")
    w = with_slots(scatter_shuffle(docs, shared_dir(spark, "op9")))
    return w.select(F.col("row.doc_id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"),
                    F.lit("key").alias("law"), "shard", "slot", "grown_shard")
