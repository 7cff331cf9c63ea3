"""Prefix trie of conversations: a z-fast trie per task, merged by Spark.

A conversation is a sequence of turns. Each of its prefixes has a key, a hash chained
over the turns, so equal prefixes have equal keys everywhere. ``ZFastTrie`` holds only
compacted nodes (a branching, or the end of a conversation). A node whose edge spans
depths a+1 to e is found in one hash table under its handle: the key of its prefix at
the two-fattest depth in (a, e], that is the number divisible by the greatest power
of two. The exit node of a conversation is located by fat binary search over those
depths, in about log2(turns) look-ups, whatever the shape of the trie.

Tasks insert their conversations in batches: all of a batch are located first, then
the edges they leave are split and one conversation per new branch becomes a leaf;
those that share its branch are located again. The edges are then expanded into one row
per prefix, with counts, and Spark adds up the rows of equal keys from all tasks.
A first turn that a third of all conversations share is one row per task.

Sums over subtrees need no walk over them. Of the nodes that a conversation passes,
those with it as their smallest member are the last ones, without a gap; so the nodes
fall into one chain per conversation. Sums along each chain come from a window, and
a chain's total is added to the nodes above its top, which lie on the path of the
same conversation.

Defined cases. Null roles and texts are empty. Turns come in ascending order, null
first, equal ones by the hash of role and text; repeated rows are turns of their own.
Rows without a conversation id belong to no conversation. A conversation left without
turns is a member of the root alone. Other columns are ignored. An empty table has no
conversation and no node.

Scale: texts are hashed where they are read and never shuffled; 70 bytes per turn are.
A conversation's keys meet in one task, as a text does. A task's trie is given out and
begun anew after ``TURNS`` turns. The ids that end at one node are hashed in their
order as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import col, stored, table
from tessera.llm.registry import query

KEY = 16
ROOT = bytes(KEY)
TURNS = 200_000
BATCH = 2_000
FAMILY = 20  # fixed by the contract: conversations that share first turns, and of how many
SHARED = 4


def fattest(a: int, b: int) -> int:
    """The two-fattest number in (a, b], for 0 <= a < b."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


class Path:
    """A conversation: the keys of its prefixes of 1 to ``size`` turns, back to back."""

    __slots__ = ("conv", "keys", "words", "size")

    def __init__(self, conv: int, keys: bytes, words: list[int]):
        self.conv, self.keys, self.words, self.size = conv, keys, words, len(words)

    def key(self, depth: int) -> bytes:
        return self.keys[(depth - 1) * KEY:depth * KEY] if depth else ROOT


class Node:
    """A compacted node: depths ``above`` + 1 to ``depth`` of ``path``."""

    __slots__ = ("above", "depth", "path", "children", "ends", "low")

    def __init__(self, above: int, depth: int, path: Path | None):
        self.above, self.depth, self.path = above, depth, path
        self.children: dict[bytes, Node] = {}
        self.ends, self.low = 0, None

    def end(self, conv: int) -> None:
        self.ends += 1
        self.low = conv if self.low is None else min(self.low, conv)


class ZFastTrie:
    def __init__(self):
        self.root = Node(0, 0, None)
        self.handles: dict[tuple[int, bytes], Node] = {}

    def _put(self, n: Node) -> None:
        f = fattest(n.above, n.depth)
        self.handles[f, n.path.key(f)] = n

    def _drop(self, n: Node) -> None:
        f = fattest(n.above, n.depth)
        del self.handles[f, n.path.key(f)]

    def locate(self, p: Path) -> tuple[Node, int]:
        """The exit node of ``p`` and the number of turns the two share: the node's own
        depth, or less if ``p`` leaves the trie on the edge to the node."""
        node, low, high = self.root, 0, p.size
        while low < high:
            f = fattest(low, high)
            n = self.handles.get((f, p.key(f)))
            if n is None:
                high = f - 1
            elif n.depth <= p.size and n.path.key(n.depth) == p.key(n.depth):
                node, low = n, n.depth
            else:
                return n, self._shared(n, p, f)
        if node.depth < p.size:
            n = node.children.get(p.key(node.depth + 1))
            if n is not None:
                return n, self._shared(n, p, node.depth + 1)
        return node, node.depth

    @staticmethod
    def _shared(n: Node, p: Path, known: int) -> int:
        """How many turns ``p`` shares with ``n``: ``known`` at least."""
        low, high = known, min(n.depth, p.size)
        while low < high:
            mid = (low + high + 1) // 2
            if n.path.key(mid) == p.key(mid):
                low = mid
            else:
                high = mid - 1
        return low

    def _split(self, n: Node, depth: int, parent: Node) -> Node:
        """A node of ``depth`` on the edge from ``parent`` to ``n``."""
        m = Node(n.above, depth, n.path)
        self._drop(n)
        parent.children[n.path.key(n.above + 1)] = m
        n.above = depth
        m.children[n.path.key(depth + 1)] = n
        self._put(m)
        self._put(n)
        return m

    def insert(self, batch: list[Path]) -> None:
        while batch:
            exits: dict[int, tuple[Node, dict[int, list[Path]]]] = {}
            for p in batch:
                n, shared = self.locate(p)
                exits.setdefault(id(n), (n, {}))[1].setdefault(shared, []).append(p)
            batch = []
            for n, by_depth in exits.values():
                parent = None
                for depth in sorted(by_depth):
                    at = n
                    if depth < n.depth:
                        parent = parent or self._parent(n)
                        at = parent = self._split(n, depth, parent)
                    for p in by_depth[depth]:
                        if p.size == depth:
                            at.end(p.conv)
                        elif p.key(depth + 1) in at.children:
                            batch.append(p)  # behind the first of its branch
                        else:
                            leaf = at.children[p.key(depth + 1)] = Node(depth, p.size, p)
                            leaf.end(p.conv)
                            self._put(leaf)

    def _parent(self, n: Node) -> Node:
        above = Path(0, n.path.keys, n.path.words)
        above.size = n.above
        return self.locate(above)[0]

    def expand(self) -> Iterator[tuple]:
        """(key, depth, key of the prefix one shorter, smallest member, members, words of
        the last turn) of every prefix, the root included."""
        order, todo = [], [self.root]
        while todo:
            n = todo.pop()
            order.append(n)
            todo.extend(n.children.values())
        members: dict[int, tuple[int, int]] = {}
        for n in reversed(order):
            many, low = n.ends, n.low
            for c in n.children.values():
                k, x = members.pop(id(c))
                many += k
                low = x if low is None else min(low, x)
            members[id(n)] = many, low
            if n is self.root:
                if many:
                    yield ROOT, 0, None, low, many, 0
            else:
                for d in range(n.above + 1, n.depth + 1):
                    yield n.path.key(d), d, n.path.key(d - 1), low, many, n.path.words[d - 1]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, k, words): a row per turn, ``k`` the hash of its role and text."""
    text = F.coalesce(col(conversations, "text"), F.lit(""))
    role = F.coalesce(col(conversations, "role"), F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.select(
        col(conversations, "conv_id").cast("long").alias("conv"), col(conversations, "turn").alias("turn"),
        F.unhex(F.sha2(named.cast("binary"), 256)).alias("k"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words")).where("conv IS NOT NULL")


def in_order(rows: DataFrame) -> DataFrame:
    """``turns`` with ``at``, the turn's place in its conversation, from 1."""
    by = W.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "k")
    return rows.select("conv", F.row_number().over(by).alias("at"), "k", "words")


def rebuilt(rows: DataFrame, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """(conv, part, at, k, words): conversation c as the first h turns of c - c % ``family``
    and then its own without its first h; h = crc32(c) % ``shared``. One more row per
    conversation with part -1 keeps those without turns."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % shared
    r = stored(in_order(rows), "trie-turns")
    convs = r.where("at = 1").select("conv", (F.col("conv") - F.col("conv") % family).alias("base"), h.alias("h"))
    own = r.where(F.col("at") > h).select("conv", F.lit(1).alias("part"), "at", "k", "words")
    first = r.where((F.col("at") < shared) & (F.col("conv") % family == 0)) \
        .select(F.col("conv").alias("base"), "at", "k", "words")
    given = convs.join(first, "base").where(F.col("at") <= F.col("h")) \
        .select("conv", F.lit(0).alias("part"), "at", "k", "words")
    here = convs.select("conv", F.lit(-1).alias("part"), F.lit(0).alias("at"), F.lit(b"").alias("k"),
                        F.lit(0).cast("long").alias("words"))
    return own.unionByName(given).unionByName(here)


def paths(rows: DataFrame) -> DataFrame:
    """Stored rows (conv, keys, words), one per conversation, of rows (conv, part, at, k,
    words): the chained keys of its prefixes, back to back."""
    grouped = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "at", "k", "words"))).alias("t")) \
        .select("conv", F.filter("t", lambda x: x["part"] >= 0).alias("t")) \
        .select("conv", F.col("t.k").alias("k"), F.col("t.words").alias("words"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for ks in b.column(1).to_pylist():
                key, keys = ROOT, []
                for k in ks:
                    key = hashlib.blake2b(key + k, digest_size=KEY).digest()
                    keys.append(key)
                out.append(b"".join(keys))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), b.column(2)],
                                             ["conv", "keys", "words"])

    return stored(grouped.mapInArrow(chain, "conv long, keys binary, words array<long>"), "trie-paths")


NODE = "key binary, depth int, up binary, conv long, n long, words long"
NODE_ARROW = pa.schema([("key", pa.binary()), ("depth", pa.int32()), ("up", pa.binary()), ("conv", pa.int64()),
                        ("n", pa.int64()), ("words", pa.int64())])


def _trie_rows(batch_size: int, max_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, size, batch = ZFastTrie(), 0, []

        def rows():
            trie.insert(batch)
            out = []
            for row in trie.expand():
                out.append(row)
                if len(out) == 10_000:
                    yield _arrow(out)
                    out = []
            if out:
                yield _arrow(out)

        for b in batches:
            for conv, keys, words in zip(*(c.to_pylist() for c in b.columns)):
                batch.append(Path(conv, keys, words))
                size += len(words) + 1
                if len(batch) == batch_size:
                    trie.insert(batch)
                    batch = []
                if size > max_turns:
                    yield from rows()
                    trie, size, batch = ZFastTrie(), 0, []
        yield from rows()

    return run


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), NODE_ARROW)], schema=NODE_ARROW)


def _end_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, conv) sorted -> (key, SHA-256 of its ids in decimal, comma-joined)."""
    key, state = None, None
    for b in batches:
        done = []
        ks, convs = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
        edge = [0, *(i for i in range(1, len(ks)) if ks[i] != ks[i - 1]), len(ks)]
        for i, j in zip(edge, edge[1:]):
            if i == j:
                continue
            if ks[i] != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = ks[i], hashlib.sha256()
            else:
                state.update(b",")
            state.update(",".join(map(str, convs[i:j].tolist())).encode())
        yield _ends(done)
    yield _ends([(key, state.hexdigest())] if key is not None else [])


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
                                      ["key", "ends"])


def _key_at(keys: Column, depth: Column) -> Column:
    return F.when(depth == 0, F.lit(ROOT)).otherwise(F.substring(keys, (depth - 1) * KEY + 1, F.lit(KEY)))


def nodes(p: DataFrame, batch_size: int = BATCH, max_turns: int = TURNS) -> DataFrame:
    """All prefixes of the conversations in ``paths``: (key, depth, up, conv, n, words,
    up_conv, n_children, n_leaves, saved, ends): ``conv`` the smallest member, ``up``
    the parent, ``ends`` the digest of the ids that end there."""
    parts = p.mapInArrow(_trie_rows(batch_size, max_turns), NODE)
    n = stored(parts.groupBy("key", "depth").agg(
        F.first("up").alias("up"), F.min("conv").alias("conv"), F.sum("n").alias("n"), F.first("words").alias("words")),
        "trie-nodes")
    kids = n.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(F.count("*").alias("n_children"))
    n = stored(n.join(kids, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-counted")
    # chains: the nodes of one smallest member, summed from their end
    below = W.partitionBy("conv").orderBy(F.desc("depth"))
    chain = n.select("key", "depth", "conv",
                     F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).over(below).alias("leaves"),
                     F.sum((F.col("n") - 1) * F.col("words")).over(below).alias("saved"))
    tops = chain.groupBy("conv").agg(F.min("depth").alias("top"), F.max("leaves").alias("leaves"),
                                     F.max("saved").alias("saved")).where("top > 0")
    above = p.join(tops, "conv").select(
        "keys", "leaves", "saved", F.explode(F.sequence(F.lit(0), F.col("top") - 1)).alias("d")) \
        .select(_key_at(F.col("keys"), F.col("d")).alias("key"), "leaves", "saved") \
        .groupBy("key").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    last = F.octet_length("keys") / KEY
    ends = p.select(_key_at(F.col("keys"), last.cast("int")).alias("key"), "conv") \
        .repartition("key").sortWithinPartitions("key", "conv").mapInArrow(_end_rows, "key binary, ends string")
    ups = n.select(F.col("key").alias("up"), F.col("conv").alias("up_conv"))
    none = hashlib.sha256(b"").hexdigest()
    return n.join(chain.select("key", "leaves", "saved"), "key").join(above, "key", "left").join(ends, "key", "left") \
        .join(ups, "up", "left").select(
            "key", "depth", "up", "conv", "n", "words", "up_conv", "n_children",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            F.coalesce("ends", F.lit(none)).alias("ends"))


SQL = r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS c, turn,
         sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, k, w, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k) AS pos FROM t),
ids AS (
  SELECT c, c - c % 20 AS g,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
               list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
             lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
               lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM o)),
r AS (
  SELECT ids.c, 1 AS part, pos, k, w FROM o JOIN ids ON o.c = ids.c WHERE pos > h
  UNION ALL
  SELECT ids.c, 0, pos, k, w FROM o JOIN ids ON o.c = ids.g WHERE pos <= h),
d AS (
  SELECT c, row_number() OVER q AS depth, string_agg(k, '') OVER q AS pre, w
  FROM r WINDOW q AS (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
path AS (
  SELECT c, depth, md5(pre) AS key, md5(substr(pre, 1, length(pre) - 64)) AS up, w FROM d
  UNION ALL
  SELECT c, 0, md5(''), NULL, 0 FROM ids),
node AS (
  SELECT key, any_value(depth) AS depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(w) AS w
  FROM path GROUP BY key),
kids AS (SELECT up, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY up),
sub AS (
  SELECT p.key, sum(CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((v.n_convs - 1) * v.w) AS saved
  FROM node v LEFT JOIN kids ON kids.up = v.key JOIN path p ON p.c = v.conv_id AND p.depth <= v.depth
  GROUP BY p.key),
fin AS (
  SELECT key, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS s
  FROM (SELECT c, key, depth, max(depth) OVER (PARTITION BY c) AS m FROM path) WHERE depth = m GROUP BY key)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, v.n_convs,
       coalesce(kids.n, 0) AS n_children, CAST(sub.leaves AS BIGINT) AS n_leaves,
       CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(coalesce(fin.s, '')) AS ends_sha256
FROM node v LEFT JOIN node u ON u.key = v.up LEFT JOIN kids ON kids.up = v.key
JOIN sub ON sub.key = v.key LEFT JOIN fin ON fin.key = v.key
"""


@query("op13_conversation_prefix_trie", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations."""
    p = paths(rebuilt(turns(table(spark, sf_dir, "conversations"))))
    long = lambda c: F.col(c).cast("long")
    return nodes(p).select(
        F.col("conv").alias("conv_id"), long("depth").alias("depth"), F.col("up_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), long("n_children").alias("n_children"), long("n_leaves").alias("n_leaves"),
        long("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
