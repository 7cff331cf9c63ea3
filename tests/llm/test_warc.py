import gzip

import pytest

from llm_fixtures import SF001, empty, docs, odd, spark  # noqa: F401  (fixtures)
from tessera.llm import warc as A
from tessera.session import shared_dir


class File:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def pages(spark):
    rows = [(1, "http://a/%20", "same", 1), (2, None, "same", 1), (5, "u\r\nX: y", "same", 1), (5, "u2", "same", 1), (None, "n", "same", 1),
            (3, "u", None, 1), (4, "u", "", 1), (6, "u", "é😀\x00\r\n\r\nWARC/1.1 \x1f\x8b\x08", 1), (7, "long", "ab" * 300_000, 1), (None, "z", "lone", 1)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, sha int")


def test_roundtrip(spark):
    out = shared_dir(spark, "t-warc")
    files = A.write_warc(pages(spark), out)
    got = sorted(((r.id, r.url, r.type, r.refers_to, r.digest, r.payload_bytes, r.payload and bytes(r.payload)) for r in A.read_warc(files, out).collect()), key=repr)
    want = []
    for r in pages(spark).collect():
        body = (r.html or "").encode()
        big = {"same": 5, "": 4}.get(body.decode())
        again = big is not None and r.page_id != big
        want.append((None if r.page_id is None else str(r.page_id), r.url, "revisit" if again else "response", str(big) if again else None,
                     A.sha1_base32(body), len(body), None if again else body))
    assert got == sorted(want, key=repr)


def test_any_split_gives_each_record_once(spark):
    out = shared_dir(spark, "t-warc")
    files = A.write_warc(pages(spark), out, file_bytes=700)
    assert files.count() > 2
    want = sorted(((r.id, r.url) for r in A.read_warc(files, out).collect()), key=repr)
    assert len(want) == 10
    for split in (1 << 20, 1000, 97, 13):
        assert sorted(((r.id, r.url) for r in A.read_warc(files, out, split).collect()), key=repr) == want


def test_false_magic_is_no_record():
    noise = A.GZIP_MAGIC + b"noise" + A.GZIP_MAGIC * 3 + gzip.compress(b"no warc header at all") + gzip.compress(b"WARC/1.1 but no end")
    one = A.gzip_member(A.record("k", "u", b"x" * 100, "D", None, False))
    data = noise + one + noise + one
    recs = list(A.records_in(A.Ranged(File(data), len(data), 64), 0, len(data)))
    assert [r[0]["WARC-Record-ID"] for r in recs] == ["<urn:x-page:k>"] * 2
    starts = [len(noise), 2 * len(noise) + len(one)]
    for cut in range(0, len(data), 7):  # a record belongs to the range it starts in
        a = len(list(A.records_in(A.Ranged(File(data), len(data), 64), 0, cut)))
        b = len(list(A.records_in(A.Ranged(File(data), len(data), 64), cut, len(data))))
        assert (a, b) == (sum(s < cut for s in starts), sum(s >= cut for s in starts))


def test_cut_off_record_is_an_error():
    one = A.gzip_member(A.record("k", "u", b"x" * 5000, "D", None, False), 0)
    with pytest.raises(ValueError):
        list(A.records_in(A.Ranged(File(one[:3000]), 3000), 0, 3000))


def test_min_bytes_and_empty(spark):
    out = shared_dir(spark, "t-warc")
    small = A.read_warc(A.write_warc(pages(spark), out, min_bytes=5), out)
    assert small.where("type = 'revisit'").count() == 0
    none = shared_dir(spark, "t-warc")
    files = A.write_warc(empty(pages(spark)), none)
    assert files.count() == 0 and A.read_warc(files, none).count() == 0


def test_query(spark):
    got = A.op4(spark, SF001).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    assert sorted(r.page_id for r in got) == sorted(html)
    for r in got:
        same = [i for i, h in html.items() if h == html[r.page_id]]
        assert r.payload_bytes == len(html[r.page_id].encode()) and r.payload_digest == A.sha1_base32(html[r.page_id].encode())
        assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == max(same) else ("revisit", max(same)))
