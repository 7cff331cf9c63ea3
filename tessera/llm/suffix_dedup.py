"""Removal of repeated byte strings by suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts anywhere else, in
the same text or another, is removed. Strings are judged on the input; matches never
cross texts. Texts are UTF-8 bytes.

A corpus has no single suffix array that one machine could hold, so the windows
(strings of ``length`` bytes) that may be equal are first brought together:

1. Every window has an anchor: of its ``KEY``-byte pieces that with the least hash,
   the first of equals. Equal windows have equal anchors at the same place, so they
   meet under the anchor's hash. The windows of one anchor follow each other; they make
   one segment of less than twice ``length`` bytes. Segments that a text has twice are
   found within the text and leave it once. Anchors of one segment in all are dropped.
2. The segments of one anchor make one string, whose suffix array is built by linear
   grouping construction (``lyndon_sort``). Suffixes that start with equal windows are
   neighbours in it; each pair of neighbours is compared byte for byte. Anchors with
   many different segments are first split: windows by their distance to the anchor, in
   blocks, and each block by the bytes that all its windows share, which again keeps
   equal windows together. Blocks of one window need no sorting.
3. The windows found are sent back to their texts, merged and cut out.

Texts that occur twice or more are removed whole if they have a window; one of them
goes through the steps above, for the sake of other texts.

Defined cases. Null and empty texts have no bytes; texts shorter than ``length`` are
kept. Repeated rows, with or without equal ids, are texts that occur twice. Ids are not
used, and may be null. Other columns are kept whatever their names and types. What is
left need not be valid UTF-8: it is bytes. An empty table gives an empty result.

Scale: one row per text and 20 bytes per anchor (one in about 150 bytes) are shuffled
for step 1, the segments of repeated anchors, without copies, for step 2, and the texts
once. An anchor with more than ``hot`` segments, such as a passage in a third of all
texts, is split into blocks by tasks before any of them meet, and blocks that are hot
still become single windows, which are counted with partial sums. Texts are named by
their SHA-256, segments by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh, stored, table, trim_memory
from tessera.llm.lyndon_sort import suffix_arrays
from tessera.llm.registry import query

LENGTH = 400
KEY = 64
HOT = 5_000
BLOCKS = (48, 8, 1)  # distances to the anchor in a block, by level of splitting
TOGETHER = 4  # segments that one suffix array takes
CHUNK = 1 << 20

_MULT = 0x9E3779B97F4A7C15
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, _U)
    p[0] = 1
    return np.multiply.accumulate(p)


class Anchors:
    """Anchors of texts of at least ``length`` bytes, a chunk of them at a time."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.key = min(KEY, length)
        self.up = self.down = np.ones(1, _U)

    def chunk(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text number, anchor's place, first window, last window, hash) arrays of the
        texts data[starts[i]:ends[i]], places counted in ``data``."""
        n, k, length = len(data), self.key, self.length
        if len(self.up) <= n:
            self.up = _powers(_MULT, n + 1)
            self.down = _powers(pow(_MULT, -1, 1 << 64), n + 1)
        sums = np.zeros(n + 1, _U)
        np.cumsum((np.frombuffer(data, np.uint8).astype(_U) + _U(1)) * self.up[:n], out=sums[1:])
        h = (sums[k:] - sums[:-k]) * self.down[:n - k + 1]
        h ^= h >> _U(32)
        h *= _U(0xD6E8FEB86659FD93)
        h ^= h >> _U(32)
        h *= _U(0xD6E8FEB86659FD93)
        h ^= h >> _U(32)
        # least of each window: by the hash's high half, then by place; minima of
        # blocks of one window's width, taken from both sides
        rank = (h & _U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=_U)
        width = length - k + 1
        grid = np.full(-(-len(h) // width) * width, ~_U(0))
        grid[:len(h)] = rank
        grid = grid.reshape(-1, width)
        left = np.minimum.accumulate(grid, axis=1).ravel()
        right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = n - length + 1
        at = (np.minimum(right[:windows], left[width - 1:width - 1 + windows]) & _U(0xFFFFFFFF)).astype(np.int64)
        edge = np.zeros(windows + 1, np.int32)  # windows inside one text
        edge[starts] += 1
        edge[ends - length + 1] -= 1
        inside = np.cumsum(edge[:-1]) > 0
        change = np.ones(windows, bool)
        change[1:] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1])
        change[starts] = True
        first = np.flatnonzero(change)
        last = np.append(first[1:], windows) - 1
        ok = inside[first]
        first, last = first[ok], last[ok]
        return np.searchsorted(starts, first, "right") - 1, at[first], first, last, h[at[first]].view(np.int64)


def pack(ranges) -> bytes:
    return np.asarray(ranges, np.int32).tobytes()


def merged(parts: list[bytes]) -> np.ndarray:
    """Packed ranges (first, last) as an array (n, 2), sorted, touching ones joined."""
    r = np.frombuffer(b"".join(parts), np.int32).reshape(-1, 2).astype(np.int64)
    if not len(r):
        return r
    r = r[np.argsort(r[:, 0], kind="stable")]
    reach = np.maximum.accumulate(r[:, 1])
    new = np.ones(len(r), bool)
    new[1:] = r[1:, 0] > reach[:-1] + 1
    ends = np.append(np.flatnonzero(new)[1:], len(r)) - 1
    return np.stack([r[new, 0], reach[ends]], axis=1)


def _chunks(texts: Iterator[tuple[bytes, bytes]], length: int, chunk: int):
    """Texts in chunks of about ``chunk`` bytes: (pieces of (key, offset, first byte's
    place in its text), bytes). A longer text is cut with ``length`` - 1 bytes
    of overlap, so that no window is lost or doubled."""
    pieces, parts, size = [], [], 0
    for key, t in texts:
        for o in range(0, max(len(t) - length + 1, 0), chunk):
            part = t[o:o + chunk + length - 1]
            pieces.append((key, size, o))
            parts.append(part)
            size += len(part)
            if size >= chunk:
                yield pieces, b"".join(parts)
                pieces, parts, size = [], [], 0
    if pieces:
        yield pieces, b"".join(parts)


def _anchor_rows(length: int, chunk: int):
    schema = "key binary, own binary, h array<long>, place array<long>"
    arrow = pa.schema([("key", pa.binary()), ("own", pa.binary()), ("h", pa.list_(pa.int64())),
                       ("place", pa.list_(pa.int64()))])

    def finish(found: dict) -> tuple:
        own = [(s, s + span - 1) for places in found.values() if len(places) > 1 for s, _, span in places]
        hs = [k[0] for k in found]
        places = [place_of(*p[0], len(p) > 1) for p in found.values()]
        return pack(merged([pack(own)])) if own else b"", hs, places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Anchors(length)
        seen: set[bytes] = set()

        def texts(batch):
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                if k not in seen:
                    seen.add(k)
                    yield k, t.as_buffer().to_pybytes()

        for batch in batches:
            rows, key, found = [], None, {}
            for pieces, data in _chunks(texts(batch), length, chunk):
                starts = np.array([p[1] for p in pieces])
                ends = np.append(starts[1:], len(data))
                for i, p, lo, hi, h in zip(*(x.tolist() for x in tool.chunk(data, starts, ends))):
                    k, offset, first = pieces[i]
                    if k is not key:
                        if key is not None:
                            rows.append((key, *finish(found)))
                        key, found = k, {}
                    name = h, p - lo, xxhash.xxh3_128_digest(data[lo:hi + length])
                    found.setdefault(name, []).append((lo - offset + first, p - lo, hi - lo + 1))
            if key is not None:
                rows.append((key, *finish(found)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)] if rows
                else [pa.array([], f.type) for f in arrow], schema=arrow)
            del rows
            trim_memory()

    return run, schema


def place_of(start: int, left: int, span: int, twice: bool) -> int:
    """First window (31 bits), its distance to the anchor (15), number of windows (15),
    and whether the text has the segment twice, in one long."""
    return start << 31 | left << 16 | span << 1 | twice


def place_parts(place: int) -> tuple[int, int, int, bool]:
    return place >> 31, place >> 16 & 0x7FFF, place >> 1 & 0x7FFF, bool(place & 1)


SEGMENT = "h long, key binary, place long, digest binary, bytes binary"
SEGMENT_ARROW = pa.schema([("h", pa.int64()), ("key", pa.binary()), ("place", pa.int64()),
                           ("digest", pa.binary()), ("bytes", pa.binary())])
RANGES = "key binary, ranges binary"
RANGES_ARROW = pa.schema([("key", pa.binary()), ("ranges", pa.binary())])


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _segment_rows(length: int, at_once: int = 8 << 20):
    """Texts with the anchors asked for -> their segments. A task sends the bytes of
    a segment once and its digest again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        sent: set[bytes] = set()
        rows, size = [], 0
        for batch in batches:
            for i, key in enumerate(batch.column(0).to_pylist()):
                if key in seen or not batch.column(2)[i].is_valid:
                    continue
                seen.add(key)
                t = batch.column(1)[i].as_buffer().to_pybytes()
                for a in batch.column(2)[i].as_py():
                    start, _, span, _ = place_parts(a["place"])
                    seg = t[start:start + span + length - 1]
                    d = xxhash.xxh3_128_digest(seg)
                    new = (a["h"], d) not in sent
                    if new:
                        if len(sent) > 500_000:
                            sent.clear()
                        sent.add((a["h"], d))
                        size += len(seg)
                    rows.append((a["h"], key, a["place"], d, seg if new else None))
                if size > at_once or len(rows) > 50_000:
                    yield _out(rows, SEGMENT_ARROW)
                    rows, size = [], 0
        yield _out(rows, SEGMENT_ARROW)
        trim_memory()

    return run


def widths(length: int) -> list[int]:
    """Block widths by level of splitting; what a block's windows share is never empty."""
    return [max(1, min(w, length // 4)) for w in BLOCKS]


def children(h: int, place: int, seg: bytes, width: int, length: int):
    """The blocks of a segment: (hash, place, bytes) with the windows whose distance to
    the anchor lies in [b * width, (b + 1) * width), by the bytes that all windows
    of that block share."""
    start, left, span, twice = place_parts(place)
    for b in range((left - span + 1) // width, left // width + 1):
        hi, lo = min(left, b * width + width - 1), max(left - span + 1, b * width)
        i, n = left - hi, hi - lo + 1  # its first window in the segment, their number
        core = seg[left - b * width:left - b * width - width + 1 + length]
        yield (xxhash.xxh3_64_intdigest(core, seed=(h * 31 + b) & (1 << 64) - 1) - (1 << 63),
               place_of(start + i, hi, n, twice), seg[i:i + n + length - 1])


class Group:
    """The segments of one anchor: by digest their bytes and where they occur."""

    __slots__ = ("h", "bytes", "where", "left")

    def __init__(self, h: int):
        self.h, self.bytes, self.where, self.left = h, {}, {}, {}

    def add(self, key: bytes, place: int, digest: bytes, seg: bytes | None) -> None:
        if seg is not None:
            self.bytes.setdefault(digest, seg)
        self.where.setdefault(digest, set()).add((key, place))

    def split(self, width: int, length: int) -> list["Group"]:
        out: dict[int, Group] = {}
        for d, seg in self.bytes.items():
            for key, place in self.where[d]:
                for h, p, s in children(self.h, place, seg, width, length):
                    out.setdefault(h, Group(h)).add(key, p, xxhash.xxh3_128_digest(s), s)
        return list(out.values())

    def repeated(self) -> bool:
        """Whether it has two windows or more that might be equal."""
        return len(self.bytes) > 1 or any(len(w) > 1 for w in self.where.values())


def _equal(v: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes from a[i] equal those from b[i]."""
    same = v[a] == v[b]
    for o in (length - 1, length // 2, length // 4, 3 * length // 4):
        same &= v[a + o] == v[b + o]
    rows = np.lib.stride_tricks.sliding_window_view(v, length)
    w = np.flatnonzero(same)
    for i in range(0, len(w), 8192):
        k = w[i:i + 8192]
        same[k] = (rows[a[k]] == rows[b[k]]).all(axis=1)
    return same


def solve(groups: list[Group], length: int) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """(text's key, ranges of windows) of all windows that occur twice in a group."""
    sort: list[Group] = []
    level = [(g, 0) for g in groups]
    while level:
        deeper = []
        for g, depth in level:
            if not g.repeated():
                continue
            if len(g.bytes) == 1:
                yield from _whole(g, next(iter(g.bytes)))
            elif len(g.bytes) <= TOGETHER or depth == len(BLOCKS):
                sort.append(g)
            else:
                deeper += [(c, depth + 1) for c in g.split(widths(length)[depth], length)]
        level = deeper
    strings, segs = [], []
    for g in sort:
        segs.append(list(g.bytes.items()))
        parts = []
        for _, seg in segs[-1]:
            parts += [np.frombuffer(seg, np.uint8).astype(np.int16) + 1, [0]]  # 0: end of a segment
        strings.append(np.concatenate(parts))
    for g, own, s, sa in zip(sort, segs, strings, suffix_arrays(strings)):
        # windows only: suffixes with ``length`` bytes to their segment's end
        sizes = np.array([len(b) + 1 for _, b in own])
        first = np.cumsum(sizes) - sizes
        seg_of = np.repeat(np.arange(len(own)), sizes)
        window = np.arange(len(s)) - first[seg_of] <= (sizes - 1 - length)[seg_of]
        sa = sa[window[sa]]
        eq = _equal(s, sa[:-1], sa[1:], length)
        hit = np.zeros(len(s) + 1, bool)
        hit[sa[1:][eq]] = hit[sa[:-1][eq]] = True
        for i, (d, _) in enumerate(own):
            if len(g.where[d]) > 1:
                yield from _whole(g, d)
                continue
            (key, place), = g.where[d]
            start, _, span, twice = place_parts(place)
            if twice:
                yield from _whole(g, d)
                continue
            on = np.flatnonzero(np.diff(np.concatenate(([0], hit[first[i]:first[i] + span].view(np.int8), [0]))))
            if len(on):
                yield key, [(start + int(x), start + int(y) - 1) for x, y in on.reshape(-1, 2)]


def _whole(g: Group, digest: bytes):
    for key, place in g.where[digest]:
        start, _, span, twice = place_parts(place)
        if not twice:  # the text knows of those
            yield key, [(start, start + span - 1)]


def _solve_rows(length: int, at_once: int = 3 << 20):
    """Segments sorted by anchor -> ranges of repeated windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[Group] = []
        size = 0

        def flush():
            by_key: dict[bytes, list] = {}
            for key, ranges in solve(groups, length):
                by_key.setdefault(key, []).extend(ranges)
            return _out([(k, pack(r)) for k, r in by_key.items()], RANGES_ARROW)

        for batch in batches:
            for h, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if not groups or groups[-1].h != h:
                    if size > at_once:
                        yield flush()
                        groups, size = [], 0
                    groups.append(Group(h))
                groups[-1].add(*rest)
                size += len(rest[3] or b"") + 60
        yield flush()
        groups.clear()
        trim_memory()

    return run


def _child_rows(width: int, length: int):
    """Segments (each with its bytes) -> the blocks of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for h, key, place, _, seg in zip(*(c.to_pylist() for c in batch.columns)):
                for h2, p, s in children(h, place, seg, width, length):
                    rows.append((h2, key, p, xxhash.xxh3_128_digest(s), s))
                if len(rows) > 10_000:
                    yield _out(rows, SEGMENT_ARROW)
                    rows = []
            yield _out(rows, SEGMENT_ARROW)

    return run


def _single_windows(rows: DataFrame, length: int) -> DataFrame:
    """Hot blocks, window by window: ranges of those that occur twice. Windows are
    counted with partial sums, so one that is in a third of all texts costs a row a task."""
    w = rows.mapInArrow(_child_rows(1, length), SEGMENT).select(
        "h", "digest", "key", F.shiftright("place", 31).cast("int").alias("s"),
        F.col("place").bitwiseAND(F.lit(1)).alias("known"))
    # a row may be there twice, if two copies of its text were read by two tasks
    twice = w.groupBy("h", "digest").agg(
        F.min("key").alias("k1"), F.max("key").alias("k2"), F.min("s").alias("s1"), F.max("s").alias("s2"),
        F.max("known").alias("own")).where("k1 <> k2 or s1 <> s2 or own = 1").select("h", "digest")
    return w.where("known = 0").join(twice, ["h", "digest"]).select("key", "s").distinct() \
        .groupBy("key").agg(F.collect_list("s").alias("s")).select("key", _as_ranges(F.col("s")).alias("ranges"))


def _as_ranges(starts: Column) -> Column:
    @F.pandas_udf("binary")
    def of(s: pd.Series) -> pd.Series:
        return s.map(lambda x: pack(merged([np.repeat(np.asarray(x, np.int32), 2).tobytes()])))

    return of(starts)


def _sort_hot(seg: DataFrame, length: int, hot: int) -> DataFrame:
    """Ranges from anchors with more than ``hot`` segments: split into blocks by the tasks
    that have them; blocks that are hot themselves are split into windows."""
    b = stored(seg.mapInArrow(_child_rows(widths(length)[0], length), SEGMENT), "suffix-blocks")
    n = b.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    b = stored(b.join(n, "h"), "suffix-blocks")
    cold = b.where(F.col("n") <= hot).drop("n").repartition("h").sortWithinPartitions("h") \
        .mapInArrow(_solve_rows(length), RANGES)
    return cold.unionByName(_single_windows(b.where(F.col("n") > hot).drop("n"), length))


def text_key(text: Column) -> Column:
    """The text's SHA-256, in 16 bytes."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def repeated_windows(docs: DataFrame, text_col: str = "text", length: int = LENGTH, hot: int = HOT,
                     chunk: int = CHUNK) -> DataFrame:
    """One row per text that has any: (key, n, ranges): ``n`` rows have the text; packed
    ranges of first bytes of windows that occur twice (for n > 1 not all of them)."""
    if not 8 <= length <= 0x3FFF:
        raise ValueError("length: 8 to 16383 bytes")
    text = F.coalesce(col(docs, text_col), F.lit(""))
    d = docs.select(text_key(text).alias("key"), text.cast("binary").alias("text")) \
        .where(F.octet_length("text") >= length)
    run, schema = _anchor_rows(length, chunk)
    counts = d.groupBy("key").agg(F.count("*").alias("n"))
    anchors = d.mapInArrow(run, schema).groupBy("key").agg(*[F.first(c).alias(c) for c in ("own", "h", "place")])
    texts = stored(anchors.join(counts, "key"), "suffix-anchors")
    each = texts.select("key", F.explode(F.arrays_zip("h", "place")).alias("a")).select("key", "a.h", "a.place")
    shared = stored(each.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "suffix-shared")
    wanted = each.join(shared, "h").groupBy("key") \
        .agg(F.collect_list(F.struct("h", "place")).alias("wanted"))
    pairs = d.join(wanted, "key").select("key", "text", "wanted")
    hots = shared.where(F.col("n") > hot).select("h")
    if hots.limit(1).count():
        seg = stored(pairs.mapInArrow(_segment_rows(length), SEGMENT), "suffix-segments")
        cold = seg.join(hots, "h", "left_anti")
        own = seg.join(hots, "h", "left_semi")
        # every row with its bytes again
        bytes_of = own.where(F.col("bytes").isNotNull()).groupBy("h", "digest").agg(F.first("bytes").alias("bytes"))
        own = own.drop("bytes").distinct().join(bytes_of, ["h", "digest"]).select(*seg.columns)
        more = [_sort_hot(own, length, hot)]
    else:
        cold, more = pairs.mapInArrow(_segment_rows(length), SEGMENT), []
    found = cold.repartition("h").sortWithinPartitions("h").mapInArrow(_solve_rows(length), RANGES)
    for m in more:
        found = found.unionByName(m)
    own = texts.where((F.octet_length("own") > 0) | (F.col("n") > 1)).select("key", "n", F.col("own").alias("ranges"))
    return own.unionByName(found.select("key", F.lit(1).cast("long").alias("n"), "ranges")) \
        .groupBy("key").agg(F.max("n").alias("n"), F.collect_list("ranges").alias("ranges"))


CUT = "n_bytes long, n_removed long, n_spans long, kept binary"


def cut(text: bytes, n: int | None, ranges: list[bytes] | None, length: int) -> tuple[int, int, int, bytes]:
    """(bytes, bytes removed, spans removed, bytes kept) of one text."""
    if n is None:
        return len(text), 0, 0, text
    if n > 1:
        return len(text), len(text), 1, b""
    r = merged(ranges)
    r[:, 1] += length - 1  # first and last byte
    joined = merged([pack(r)]).tolist()
    kept, at, gone = [], 0, 0
    for s, e in joined:
        kept.append(text[at:s])
        at, gone = e + 1, gone + e + 1 - s
    kept.append(text[at:])
    return len(text), gone, len(joined), b"".join(kept)


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, hot: int = HOT,
                   chunk: int = CHUNK, digest: bool = False) -> DataFrame:
    """``docs`` with its own columns and (n_bytes, n_removed, n_spans, kept), under names
    that do not clash: ``kept`` are the bytes left, or with ``digest`` their SHA-256."""
    found = repeated_windows(docs, text_col, length, hot, chunk)
    k, f, n, r, c = fresh(docs, "key", "found_key", "found_n", "found_ranges", "cut")
    found = found.select(F.col("key").alias(f), F.col("n").alias(n), F.col("ranges").alias(r))

    @F.pandas_udf(CUT)
    def apply(text: pd.Series, n: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        rows = []
        for t, m, x in zip(text, n, ranges):
            row = cut((t or "").encode(), None if pd.isna(m) else int(m), None if x is None else list(x), length)
            rows.append((*row[:3], hashlib.sha256(row[3]).digest() if digest else row[3]))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    j = docs.withColumn(k, text_key(col(docs, text_col))).join(found, F.col(k) == F.col(f), "left")
    j = j.withColumn(c, apply(F.col(f"`{text_col}`"), F.col(n), F.col(r)))
    new = fresh(docs, "n_bytes", "n_removed", "n_spans", "kept")
    return j.select(*[F.col(f"`{x}`") for x in docs.columns],
                    *[F.col(f"{c}.{x}").alias(y) for x, y in zip(("n_bytes", "n_removed", "n_spans", "kept"), new)])


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
sized AS (SELECT *, length(x) // 2 AS n FROM d),
win AS (
  SELECT rid, i, md5(substr(x, 2 * i + 1, 800)) AS m
  FROM (SELECT rid, x, unnest(range(0, n - 399)) AS i FROM sized WHERE n >= 400)),
hit AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY m) AS c FROM win) WHERE c > 1),
runs AS (
  SELECT rid, i, sum(CASE WHEN i - p <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i) AS r
  FROM (SELECT rid, i, coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), -1000000) AS p FROM hit)),
spans AS (SELECT rid, min(i) AS s, max(i) + 400 AS e FROM runs GROUP BY rid, r),
kept AS (
  SELECT rid, s, e, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s), 0) AS f FROM spans),
per AS (
  SELECT rid, CAST(sum(e - s) AS BIGINT) AS n_removed, count(*) AS n_spans, max(e) AS last_end,
         string_agg(substr(x, 2 * f + 1, 2 * (s - f)), '' ORDER BY s) AS k
  FROM kept JOIN sized USING (rid) GROUP BY rid)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE k || substr(x, 2 * last_end + 1) END)) AS kept_sha256
FROM sized LEFT JOIN per USING (rid)
"""


@query("op11_suffix_array_dedup", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 400 bytes."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    r = remove_repeats(d, digest=True)
    return r.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))
