"""WARC archives: writer with payload deduplication, and a splittable reader.

``write_warc`` writes one gzip member per record. Among records with equal payloads
of at least ``min_bytes`` the one with the largest id is a ``response``; the others
are ``revisit`` records that refer to it and carry no payload. Records keep the full
payload's SHA-1 and length.

``read_warc`` cuts the files into byte ranges. A task scans its range for the gzip
magic, takes a candidate as a record only if it decompresses to a WARC header, and
owns the records that start inside its range; the last of them may end behind
it. After a record the scan goes on at its end, so bytes inside a member are only
candidates before the first record of a range, and there a header must decode.
A UTF-8 payload cannot contain the magic itself.

Defined cases. A null payload is empty and takes part in deduplication (empty
payloads are equal). Rows with equal id and equal payload are all records
of the largest id, so all are responses. A null id counts as the smallest and is
written as an empty record id; if every id of a payload is null, all are responses.
Null urls have no target header and read back as null. Extra columns are ignored;
an empty table gives no files and no records.

Scale: digests are aggregated per task before they are shuffled. Digests that
occur once need no lookup; those of several records are a small table that is
broadcast when its size is proven, else joined by digest, where AQE splits a hot
digest (no group is ever gathered). Task attempts write files of their own; the
list of files is committed by Spark and names only successful attempts' files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import bounded_broadcast, col, join_path, make_dir, open_fs, stored, table
from tessera.llm.registry import query
from tessera.session import shared_dir

GZIP_MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 4 << 20
FILE_BYTES = 1 << 30
LEVEL = 4
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the tables have no capture time


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: str | None) -> str:
    return f"<urn:x-page:{quote(key or '', safe='')}>"


def key_of(urn: str | None) -> str | None:
    return unquote(urn[len("<urn:x-page:"):-1]) or None if urn else None


def record(key: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, revisit: bool) -> bytes:
    """One record, uncompressed; a revisit keeps the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [f"WARC/1.1\r\nWARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(key)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def roles(pages: DataFrame, id_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """(sha, first): per payload of several records, the largest id."""
    payload = F.coalesce(col(pages, html_col), F.lit(""))
    return pages.where(F.octet_length(payload) >= min_bytes) \
        .select(F.unhex(F.sha1(payload)).alias("sha"), col(pages, id_col).alias("id")) \
        .groupBy("sha").agg(F.max("id").alias("first"), F.count("*").alias("n")) \
        .where("n > 1").select("sha", "first")


def write_warc(pages: DataFrame, out_dir: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the archives below ``out_dir``; returns (file, size, records), a row
    per file."""
    spark = pages.sparkSession
    shared = bounded_broadcast(stored(roles(pages, id_col, html_col, min_bytes), "warc-roles"), 1_000_000, 64) \
        if dict(pages.dtypes)[id_col] in ("bigint", "int") else roles(pages, id_col, html_col, min_bytes)
    payload = F.coalesce(col(pages, html_col), F.lit(""))
    rows = pages.select(col(pages, id_col).alias("id"), col(pages, url_col).alias("url"), payload.cast("binary").alias("payload"),
                        F.when(F.octet_length(payload) >= min_bytes, F.unhex(F.sha1(payload))).alias("sha")) \
        .join(shared.withColumnRenamed("sha", "sha2"), F.col("sha") == F.col("sha2"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = rows.select(F.col("id").cast("string").alias("id"), "url", "payload",
                       F.col("first").cast("string").alias("first"), revisit.alias("revisit"))
    make_dir(out_dir)

    def run(batches):
        fs, base = open_fs(out_dir)
        out, name, size, n = None, "", 0, 0
        done = []
        try:
            for batch in batches:
                for key, url, body, first, again in zip(*(batch.column(i) for i in range(5))):
                    body = body.as_py()
                    data = gzip_member(record(key.as_py(), url.as_py(), body, sha1_base32(body), first.as_py(), again.as_py()))
                    if out is not None and size + len(data) > file_bytes:
                        out.close()
                        done.append((name, size, n))
                        out = None
                    if out is None:
                        name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = fs.open_output_stream(join_path(base, name), compression=None)
                    out.write(data)
                    size, n = size + len(data), n + 1
        finally:
            if out is not None:
                out.close()
                done.append((name, size, n))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64()),
                                          pa.array([x[2] for x in done], pa.int64())], ["file", "size", "records"])

    return stored(rows.mapInArrow(run, "file string, size long, records long"), "warc-files")


class Ranged:
    """Reads of a file by position through one block."""

    def __init__(self, f, size: int, block: int = 1 << 20):
        self.f, self.size, self.block, self.start, self.data = f, size, block, 0, b""

    def at(self, pos: int, least: int) -> bytes:
        """Bytes from ``pos`` on: at least ``least``, or as many as there are."""
        have = self.start + len(self.data) - pos
        if pos < self.start or have < least and self.start + len(self.data) < self.size:
            self.start = pos
            self.data = self.f.read_at(min(max(self.block, least), self.size - pos), pos)
        return self.data[pos - self.start:]

    def find(self, magic: bytes, pos: int, end: int) -> int:
        """First place of ``magic`` that starts in [pos, end), or -1."""
        while pos < end:
            data = self.at(pos, len(magic))
            i = data.find(magic)
            if i >= 0:
                return pos + i if pos + i < end else -1
            if pos + len(data) >= self.size:
                return -1
            pos += max(1, len(data) - len(magic) + 1)
        return -1


def member_at(src: Ranged, pos: int) -> tuple[bytes, bytes, int] | None:
    """(header, block, end) of the record whose gzip member starts at ``pos``;
    None if no WARC header decodes there."""
    d, parts, got, header = zlib.decompressobj(31), [], 0, None
    at = pos
    while not d.eof:
        data = src.at(at, 1)[:1 << 16]
        if not data:
            break
        try:
            part = d.decompress(data)
        except zlib.error:
            return None
        at += len(data)
        parts.append(part)
        got += len(part)
        if header is None:
            so_far = b"".join(parts)
            if not so_far.startswith(b"WARC/1."[:len(so_far)]):
                return None
            end = so_far.find(b"\r\n\r\n")
            if end >= 0:
                header = so_far[:end]
    data = b"".join(parts)
    if header is None or not d.eof:
        if header is not None:
            raise ValueError(f"a record is cut off at byte {pos}")
        return None
    return header, data[len(header) + 4:], at - len(d.unused_data)


def fields_of(header: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:])


def records_in(src: Ranged, begin: int, end: int):
    """The records (fields, block) that start in [begin, end)."""
    pos = begin
    while (pos := src.find(GZIP_MAGIC, pos, end)) >= 0:
        found = member_at(src, pos)
        if found is None:
            pos += 1
            continue
        header, block, pos = found
        f = fields_of(header)
        yield f, block[:int(f["Content-Length"])]


def read_warc(files: DataFrame, in_dir: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(id, url, type, refers_to, digest, payload_bytes, payload) of all records in
    ``files`` (file, size); the payload of a revisit is null, ids are strings. A
    response whose payload does not have its digest is an error."""
    ranges = files.select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)),
                                                               F.lit(split_bytes).cast("long"))).alias("begin")) \
        .withColumn("end", F.least("size", F.col("begin") + split_bytes))
    names = "id url type refers_to digest payload_bytes payload".split()
    kinds = [pa.string()] * 5 + [pa.int64(), pa.binary()]

    def run(batches):
        fs, base = open_fs(in_dir)
        for batch in batches:
            for name, size, begin, end in zip(*(batch.column(c).to_pylist() for c in ("file", "size", "begin", "end"))):
                rows, held = [], 0
                with fs.open_input_file(join_path(base, name)) as f:
                    for h, block in records_in(Ranged(f, size), begin, end):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        again = h["WARC-Type"] == "revisit"
                        length = int(fields_of(http)["Content-Length"])
                        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if not again and (len(payload) != length or sha1_base32(payload) != digest):
                            raise ValueError(f"{name}: a payload does not have its digest")
                        url = h.get("WARC-Target-URI")
                        rows.append((key_of(h["WARC-Record-ID"]),
                                     url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"), h["WARC-Type"],
                                     key_of(h.get("WARC-Refers-To")), digest, length, None if again else payload))
                        held += len(block)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    n = max(files.sparkSession.sparkContext.defaultParallelism, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return ranges.repartition(n).mapInArrow(run, "id string, url string, type string, refers_to string, digest string, "
                                                 "payload_bytes long, payload binary")


#: five hex digits of the SHA-1 are four base-32 digits
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS sha FROM pages),
five AS (SELECT sha, i, CAST('0x' || substr(sha, 5 * i + 1, 5) AS BIGINT) AS v FROM (SELECT DISTINCT sha FROM p), range(0, 8) r(i)),
b32 AS (SELECT sha, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> 15) & 31)::INTEGER, 1)
                            || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> 10) & 31)::INTEGER, 1)
                            || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> 5) & 31)::INTEGER, 1)
                            || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v & 31)::INTEGER, 1), '' ORDER BY i) AS digest
        FROM five GROUP BY sha),
first AS (SELECT sha, max(page_id) AS top FROM p GROUP BY sha)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM p JOIN first USING (sha) JOIN b32 USING (sha)"""


@query("op4_warc", SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written and read back."""
    out_dir = shared_dir(spark, "op4")
    pages = table(spark, sf_dir, "pages")
    kind = dict(pages.dtypes)["page_id"]
    r = read_warc(write_warc(pages, out_dir), out_dir)
    return r.select(F.col("id").cast(kind).alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                    F.col("type").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"))
