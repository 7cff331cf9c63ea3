"""Token-id output: one zstandard frame per document, a shared dictionary.

``write_tokens`` lays a folder out as

    dictionary            the shared zstandard dictionary (bytes)
    data/part-*.ids       header, then the frames of documents in id order
    index/*.parquet       (id, part, file, offset, length, n_tokens, before)

A data file's header is the magic, the SHA-256 of the dictionary and the number of
bytes of an id; a frame holds a document's ids as little-endian unsigned
32-bit integers. The index is the offset index: it finds any document without
reading others (``fetch``). ``before`` counts the tokens earlier in the same file, and
``part`` orders the files, so a document's start among all ids needs one
row per file. The dictionary is trained on the serialized ids of a bounded sample
(``sample_docs`` documents by the hash of their id, at most ``sample_bytes``); it affects sizes only.

Defined cases. A null text is empty and holds the end id only. Null ids come
first; equal ids are ordered by their place in the input, each its own entry. Extra columns are ignored; an empty table gives empty results. A
dictionary that cannot be trained (too little data) is empty, and frames then use
none.

Scale: texts are encoded and compressed where they are read, and one shuffle deals
the frames into ranges of (id, place), so a hot id is split over files; the ranges
come from a scan of the ids alone. A task holds one batch. A task attempt
writes its own file; the index is committed by Spark and names only the files of
successful attempts. Reading goes by ranges of a file's neighbouring frames.
"""

from __future__ import annotations

import bisect
import hashlib
import struct
import uuid

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import col, join_path, make_dir, open_fs, table
from tessera.llm.registry import query
from tessera.llm.word_tokens import encode
from tessera.session import shared_dir

MAGIC = b"TESSIDS1"
HEADER = "<8s32sI"
END_ID = 2
LEVEL = 3
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS = 1_000
SAMPLE_BYTES = 8 << 20


def train(rows: list[bytes], dictionary_bytes: int = DICTIONARY_BYTES, sample_bytes: int = SAMPLE_BYTES) -> bytes:
    """A zstandard dictionary trained on serialized id arrays; empty if there
    are too few."""
    pieces = [r[i:i + 4096] for r in rows for i in range(0, len(r), 4096)]
    step = max(1, -(-sum(map(len, pieces)) // sample_bytes))  # spread over all rows of the sample
    pieces = pieces[::step]
    try:
        return zstandard.train_dictionary(dictionary_bytes, pieces).as_bytes() if len(pieces) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _sample_dictionary(docs: DataFrame, path: str, sample_docs: int, dictionary_bytes: int, sample_bytes: int) -> bytes:
    """Train on the ``sample_docs`` documents whose ids hash lowest, in one task."""
    ids = [r["id"] for r in docs.select("id").where("id is not null")
           .orderBy(F.xxhash64("id"), "id").limit(sample_docs).collect()]
    if not ids:
        return b""

    def run(batches):
        rows = [r for b in batches for r in encode(path, b.column(0).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([train(rows, dictionary_bytes, sample_bytes)], pa.binary())], ["d"])

    picked = docs.where(F.col("id").isin(ids)).select("text").limit(2 * sample_docs)
    got = picked.coalesce(1).mapInArrow(run, "d binary").collect()
    return bytes(got[0]["d"]) if got else b""


def _codec(dictionary: bytes):
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return {"dict_data": d} if d else {}


def write_tokens(docs: DataFrame, out_dir: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int | None = END_ID, sample_docs: int = SAMPLE_DOCS, dictionary_bytes: int = DICTIONARY_BYTES,
                 sample_bytes: int = SAMPLE_BYTES, parts: int | None = None) -> DataFrame:
    """Write the ids of every text in ascending id order, in ``parts`` files (default: as
    many as shuffle partitions); returns the index."""
    spark = docs.sparkSession
    rows = docs.select(col(docs, id_col).alias("id"), col(docs, text_col).alias("text"))
    dictionary = _sample_dictionary(rows, path, sample_docs, dictionary_bytes, sample_bytes)
    make_dir(join_path(out_dir, "data"))
    fs, base = open_fs(out_dir)
    with fs.open_output_stream(join_path(base, "dictionary")) as f:
        f.write(dictionary)
    id_type = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", id_type)] + [
        T.StructField(n, t()) for n, t in (("part", T.IntegerType), ("file", T.StringType), ("offset", T.LongType),
                                           ("length", T.LongType), ("n_tokens", T.LongType), ("before", T.LongType))])
    end = struct.pack("<I", end_id) if end_id is not None else b""

    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumn("place", F.monotonically_increasing_id())
    bounds = _bounds(keyed.select("id", "place"), n)

    def compress(batches):
        squeeze = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, **_codec(dictionary)).compress
        for big in batches:
            for at in range(0, big.num_rows, 2048):
                batch = big.slice(at, 2048)
                ids = [x + end for x in encode(path, batch.column("text").to_pylist())]
                part = [bisect.bisect_right(bounds, (i is not None, i, p)) if i is not None else bisect.bisect_right(bounds, (False, p))
                        for i, p in zip(batch.column("id").to_pylist(), batch.column("place").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("place"), pa.array(part, pa.int32()), pa.array([squeeze(x) for x in ids], pa.binary()),
                     pa.array([len(x) // 4 for x in ids], pa.int64())], ["id", "place", "part", "frame", "n_tokens"])

    framed = keyed.mapInArrow(compress, T.StructType([
        T.StructField("id", id_type), T.StructField("place", T.LongType()), T.StructField("part", T.IntegerType()),
        T.StructField("frame", T.BinaryType()), T.StructField("n_tokens", T.LongType())]))

    def write(batches):
        name, out, at, before = "", None, 0, 0
        fs, base = open_fs(out_dir)
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    name = f"data/part-{batch.column('part')[0].as_py():06d}-{uuid.uuid4().hex}.ids"
                    out = fs.open_output_stream(join_path(base, name), compression=None)
                    head = struct.pack(HEADER, MAGIC, hashlib.sha256(dictionary).digest(), 4)
                    out.write(head)
                    at = len(head)
                frames = batch.column("frame").to_pylist()
                out.write(b"".join(frames))
                lengths = np.fromiter(map(len, frames), np.int64, len(frames))
                tokens = batch.column("n_tokens").to_numpy()
                offsets = at + np.cumsum(lengths) - lengths
                befores = before + np.cumsum(tokens) - tokens
                at, before = at + int(lengths.sum()), before + int(tokens.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("part"), pa.array([name] * len(frames)),
                     pa.array(offsets), pa.array(lengths), pa.array(tokens), pa.array(befores)], schema.names)
        finally:
            if out is not None:
                out.close()

    ordered = framed.repartitionById(n, "part").sortWithinPartitions(F.col("id").asc_nulls_first(), "place")
    index = join_path(out_dir, "index")
    ordered.mapInArrow(write, schema).write.parquet(index)
    return spark.read.schema(schema).parquet(index)


def _bounds(keys: DataFrame, n: int) -> list[tuple]:
    """The first key (id, place) of each of ``n`` ranges but the first, in order; null
    ids come first. Reads only the ids; one row per range reaches the driver."""
    rows = keys.repartitionByRange(n, F.col("id").asc_nulls_first(), "place") \
        .groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct(F.col("id").isNotNull().alias("own"), "id", "place")).alias("k")) \
        .orderBy("p").collect()
    return [(True, r["k"]["id"], r["k"]["place"]) if r["k"]["own"] else (False, r["k"]["place"]) for r in rows[1:]]


def read_tokens(index: DataFrame, out_dir: str) -> DataFrame:
    """(id, n_tokens, part, before, ids) of the documents in ``index`` (all, or
    any selection of its rows), read back from the files and checked against
    the dictionary's hash and the index."""
    fs, base = open_fs(out_dir)
    with fs.open_input_stream(join_path(base, "dictionary")) as f:
        dictionary = f.read()
    schema = T.StructType([index.schema["id"]] + [T.StructField(n, t()) for n, t in (
        ("n_tokens", T.LongType), ("part", T.IntegerType), ("before", T.LongType), ("ids", T.BinaryType))])

    def run(batches):
        fs, base = open_fs(out_dir)
        unpack = zstandard.ZstdDecompressor(**_codec(dictionary)).decompress
        name = f = None
        for big in batches:
            for at in range(0, big.num_rows, 1024):  # a slice's frames are read at once where they are neighbours
                batch = big.slice(at, 1024)
                files, offsets, lengths, tokens = (batch.column(c).to_pylist() for c in ("file", "offset", "length", "n_tokens"))
                ids: list[bytes] = []
                i = 0
                while i < len(files):
                    j = i + 1
                    while j < len(files) and files[j] == files[i] and offsets[j] == offsets[j - 1] + lengths[j - 1]:
                        j += 1
                    if files[i] != name:
                        name = files[i]
                        f = fs.open_input_file(join_path(base, name))
                        magic, digest, width = struct.unpack(HEADER, f.read_at(struct.calcsize(HEADER), 0))
                        if (magic, digest, width) != (MAGIC, hashlib.sha256(dictionary).digest(), 4):
                            raise ValueError(f"{name}: not written with this dictionary")
                    start = offsets[i]
                    block = memoryview(f.read_at(offsets[j - 1] + lengths[j - 1] - start, start))
                    ids += [unpack(block[o - start:o - start + n]) for o, n in zip(offsets[i:j], lengths[i:j])]
                    i = j
                if [len(x) // 4 for x in ids] != tokens:
                    raise ValueError(f"{name}: the index does not fit")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("n_tokens"), batch.column("part"), batch.column("before"),
                     pa.array(ids, pa.binary())], schema.names)

    return index.select("id", "part", "file", "offset", "length", "n_tokens", "before").mapInArrow(run, schema)


def fetch(index: DataFrame, out_dir: str, ids: list) -> DataFrame:
    """The documents with the given ids, by the offset index."""
    return read_tokens(index.where(F.col("id").isin(ids)), out_dir)


def file_starts(index: DataFrame) -> DataFrame:
    """(part, first): ids in all files before a file; one row per file."""
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    return sizes.select("part", F.coalesce(before, F.lit(0)).alias("first"))


@query("op3_token_output")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by word_bpe_49k.json and end id 2, written and read back."""
    out_dir = shared_dir(spark, "op3")
    index = write_tokens(table(spark, sf_dir, "documents"), out_dir, public_tokenizers.path("word_bpe_49k.json"))
    # the ids themselves stay out of the join
    read = read_tokens(index, out_dir).select("id", "part", "before", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return read.join(file_starts(index), "part").select(
        F.col("id").alias("doc_id"), (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
