"""Language-model scores by logistic context mixing.

Tokens (words, then one end) are written in a binary code: the ``max_words`` most
frequent words, the end and the escapes (one by first byte) have a Huffman code; an
escaped word is spelled in a Huffman code of bytes. Words met once teach the model
when to escape. Each code bit is predicted by several models: the code
tree itself, hashed contexts (the word before, the last very frequent word; for bytes the one to four bytes before) and, for words, the word
that followed the last occurrence of the same two words in the text. The
predictions, as log odds, are combined by weights; a gate, made of how much the
contexts have seen, selects the weights. The result is refined by an adaptive
probability map. The log probabilities of a text's bits add up to its score,
and over its bytes to its bits per byte.

Training is online and covers all training documents: each task predicts a block,
corrects the weights by the error, then lets its context counts and map learn the
block. Counts, maps and weighted weights of all tasks are added up. Scoring uses the
merged model, so a document's score does not depend on its neighbours.

The base score needs the exact count of every token: the frequent words' counts are
in the broadcast dictionary; the others' are joined by word with the count table,
as (row, word, times).

Defined cases. A null text is empty and has one token, the end. A null id belongs to
the training part. Repeated rows are scored each. With no training token
the base counts are 0 and the model predicts from its prior. Extra columns are
ignored; an empty table gives an empty result.

Scale: the dictionary and the tables grow with the square root of the N training
tokens (``table_bits``, ``dictionary_words``; the spelling's tables with the distinct
words), without a cap. At N = 2*10^7, 10^8, 5*10^9 (about 30 GB) and 2*10^13 a table has
2^20, 2^21, 2^24 and 2^30 slots, the dictionary 131 thousand, 226 thousand, 1.6 million
and 101 million words. Both are broadcast whole: from some N on, they outgrow a worker's
memory and would have to be split by slot range, which is not built. Per task, counts
are summed before they are shuffled. Merging streams over the tasks' tables with
constant memory; the driver receives the merged tables, two bytes a slot.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import col, no_gc, stored, table
from tessera.llm.registry import query

FOLDS, HELD_FOLD = 5, 1
BASE_TOKENS = 1 << 21  # training tokens up to which tables have 2^TABLE_BITS slots
BASE_WORDS = 1 << 17  # and the least size of the dictionary, which grows from 16 times the tokens
MAX_WORD_BYTES = 64  # longer words are spelled, which bounds the dictionary
TABLE_BITS = 18
FREQUENT = 256
GATES = 32
BUCKETS = 33
BLOCK_TOKENS = 100_000
RUN_SYMBOLS = 1 << 14
CHUNK = 1 << 14
RATE = 0.05
WORD_CONTEXTS, SPELL_CONTEXTS = 2, 4
CACHE_WORDS = 600_000
TOGETHER = 4_000_000  # characters of texts that are cut into words together
END = b""  # the end's key in the dictionary; no word equals it
LOG10E = float(np.log10(np.e))


def table_bits(n_tokens: int) -> int:
    """Bits of a table's slots: with the square root of the training tokens, without a cap."""
    return TABLE_BITS + max(0, round(0.5 * np.log2(max(n_tokens, 1) / BASE_TOKENS)))


def dictionary_words(n_tokens: int) -> int:
    """Words of the dictionary: with the square root of the training tokens, without a cap."""
    return max(BASE_WORDS, int(BASE_WORDS * np.sqrt(n_tokens / (16 * BASE_TOKENS))))


class Codebook:
    """Canonical Huffman code of the symbols 0 to n-1; symbols of one length are in
    the order of ``rank``. The first ``depth`` bits of a code (all, unless told
    otherwise) are predicted by the mixer; what is left of a longer code by the
    symbols' counts (``tail``)."""

    def __init__(self, counts: np.ndarray, rank: np.ndarray, depth: int = 62):
        n = len(counts)
        counts = counts.astype(np.int64) + 1
        heap = [(w, i) for i, w in enumerate(counts.tolist())]
        heapq.heapify(heap)
        parent = np.zeros(2 * n - 1, np.int64)
        for node in range(n, 2 * n - 1):
            (wa, a), (wb, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a] = parent[b] = node
            heapq.heappush(heap, (wa + wb, node))
        lens, at = np.zeros(n, np.int64), np.arange(n)
        while (live := at != 2 * n - 2).any():  # all symbols climb to the root together
            lens += live
            at = np.where(live, parent[at], at)
        order = np.lexsort((rank, lens))
        high = int(lens.max())
        used = (np.int64(1) << (high - lens[order])).cumsum()
        codes = np.zeros(n, np.int64)
        codes[order] = (used - (np.int64(1) << (high - lens[order]))) >> (high - lens[order])
        self.lens = np.minimum(lens, depth).astype(np.uint8)
        high = int(self.lens.max())
        codes = codes >> (lens - self.lens)
        self.codes = codes.astype(np.int32 if high < 32 else np.int64)
        #: of the nodes of a depth the leaves come first: their number, and where the inner nodes are numbered from
        self.leaves, self.start = np.zeros(high + 1, np.int64), np.zeros(high + 1, np.int64)
        prior, inner = [], 1
        self.inner = np.zeros(high + 1, self.codes.dtype)  # from a code's first bits to the number of the node they lead to
        for d in range(high):
            deep = self.lens > d
            below = (codes[deep] >> (self.lens[deep] - np.int64(d + 1))) - 2 * ((np.int64(1) << d) - inner)
            odds = np.bincount(below, counts[deep], 2 * inner) + 0.5
            prior.append(np.log(odds[1::2] / odds[::2]))
            self.start[d + 1] = self.start[d] + inner
            self.leaves[d + 1] = ((lens == d + 1) & (self.lens == d + 1)).sum()
            self.inner[d] = self.start[d] - ((1 << d) - inner)
            inner = 2 * inner - int(self.leaves[d + 1])
        #: log odds of a 1, by inner node
        self.prior = np.concatenate([*prior, np.zeros(1)]).astype(np.float32)
        #: symbols with equal first bits of their codes
        self.classes = np.unique((np.int64(1) << self.lens.astype(np.int64)) + codes, return_inverse=True)[1].astype(np.int32)
        self.tail = np.log(counts / np.bincount(self.classes, counts)[self.classes])


class Mixer:
    """Context counts, weights and map of one kind of symbols."""

    def __init__(self, contexts: int, bits: int = TABLE_BITS):
        self.contexts, self.shift, self.size = contexts, np.uint32(32 - bits), 1 << bits
        self.cells = [np.zeros(2 * self.size, np.uint32) for _ in range(contexts)]  # of one task: zeros and ones by slot
        self._packed: list[np.ndarray] | None = None
        self.weights = np.full((contexts + 2, GATES), 0.3, np.float32)
        self.seen = np.zeros(GATES)
        self.map_n = np.zeros(GATES * BUCKETS)
        self.map_n1 = np.zeros(GATES * BUCKETS)
        self.map: np.ndarray | None = None

    @property
    def n(self) -> list[np.ndarray]:
        """Bits met, by slot."""
        return [c[::2] + c[1::2] for c in self.cells]

    @property
    def n1(self) -> list[np.ndarray]:
        return [c[1::2] for c in self.cells]

    @property
    def packed(self) -> list[np.ndarray]:
        """What the counts predict, by slot; while learning only the slots met are packed, as they are met."""
        if self._packed is None:
            self._packed = [pack(n, n1) for n, n1 in zip(self.n, self.n1)]
        return self._packed

    def run(self, cb: Codebook, ids: np.ndarray, ctx: list[np.ndarray], pred: np.ndarray | None, learn: bool,
            scores: bool = True) -> np.ndarray | None:
        """Natural log probability of each symbol, from the counts known before the
        block; ``learn``: correct the weights on the way and count the block at its end;
        without ``scores``, learning leaves the logarithms out and returns nothing.
        Work goes by small runs, whose arrays stay in the processor's cache."""
        out = np.empty(len(ids)) if scores else None
        cells: list[list] = [[] for _ in range(self.contexts)]
        for at in range(0, len(ids), RUN_SYMBOLS):
            cut = slice(at, at + RUN_SYMBOLS)
            lp = self._run(cb, ids[cut], [c[cut] for c in ctx], None if pred is None else pred[cut], cells if learn else None, scores)
            if scores:
                out[cut] = lp
        if learn and len(ids):
            self._packed = None
            for k in range(self.contexts):
                if sum(map(len, cells[k])) < self.size:  # the cells met only
                    for cell in cells[k]:
                        np.add.at(self.cells[k], cell, np.uint32(1))
                else:
                    self.cells[k] += np.bincount(np.concatenate(cells[k]), minlength=2 * self.size).astype(np.uint32)
        return out

    def _run(self, cb: Codebook, ids: np.ndarray, ctx: list[np.ndarray], pred: np.ndarray | None, cells: list | None,
             scores: bool) -> np.ndarray | None:
        """All bits of the symbols are laid out one depth after the other; only the weights,
        which learn after each depth, go depth by depth."""
        lens = cb.lens[ids]
        order = np.argsort(255 - lens, kind="stable")  # longest codes first: a depth's symbols are a prefix
        ids, lens = ids[order], lens[order].astype(np.int32)
        live = np.cumsum(np.bincount(lens, minlength=1)[::-1])[::-1][1:]  # symbols of more than so many bits
        each = live.tolist()

        def bits(of: np.ndarray) -> np.ndarray:
            return np.concatenate([of[:n] for n in each])

        if not each:
            return cb.tail[ids] if scores else None
        depth = np.repeat(np.arange(len(each), dtype=np.int32), live)
        code, left = bits(cb.codes[ids]), bits(lens) - depth
        path = code >> left
        bit = (code >> (left - 1)) & 1
        node = path + np.repeat(cb.inner[:len(each)], live)
        spread = node.astype(np.uint32) * np.uint32(0x9E3779B1)
        xs = np.empty((self.contexts + (2 if pred is None else 1), len(node)), np.float32)
        xs[0] = _take(cb.prior, node)
        gate = np.zeros(len(node), np.int16)
        for k in range(self.contexts):
            slot = bits(ctx[k][order])
            slot ^= spread
            slot *= np.uint32(0x85EBCA6B)
            slot = (slot >> self.shift).astype(np.intp)
            if cells is None:
                v = _take(self.packed[k], slot)
                seen = v & 3
                np.multiply(v >> 2, np.float32(1 / 512), out=xs[k + 1], dtype=np.float32)
            else:
                pair = _take(self.cells[k].view(np.uint64), slot)  # zeros in the low half
                ones = (pair >> np.uint64(32)).astype(np.int32)
                odds, seen = log_odds(pair.astype(np.int32) + ones, ones)
                np.multiply(odds, np.float32(1 / 512), out=xs[k + 1])
                slot <<= 1
                slot |= bit
                cells[k].append(slot)
            if k < 2:
                gate |= seen << (2 * k)
        row = np.minimum(depth, 15).astype(np.int16)
        match = None
        if pred is None:
            xs[-1] = 1
        else:  # of the bits of predicted symbols, those where the predicted symbol's code goes on and was right so far
            pred = pred[order]
            place = np.flatnonzero(bits(pred >= 0))
            q = pred[place - (np.cumsum(live) - live)[depth[place]]]
            q_code, q_left = cb.codes[q], cb.lens[q].astype(np.int32) - depth[place]
            alive = (q_left > 0) & ((q_code >> np.maximum(q_left, 0)) == path[place])
            place = place[alive]
            says = (q_code[alive] >> (q_left[alive] - 1)) & 1
            match = place, (2 * says - 1).astype(np.float32)
            gate[place] |= 16
            row[place] |= 16
        if cells is not None:
            x = self._learn(xs, match, gate, bit, each)
            both = np.bincount(2 * _cell(row, x) + bit, minlength=2 * GATES * BUCKETS)
            self.map_n += both[::2] + both[1::2]
            self.map_n1 += both[1::2]
        else:
            x = self._mixed(xs, match, gate.astype(np.intp))
        if not scores:
            return None
        sign = (1 - 2 * bit).astype(np.float32)
        if cells is None and self.map is not None:
            x += _take(self.map, _cell(row, x))
            sign *= np.float32(0.5)
        cost = np.log1p(np.exp(x * sign))
        lp, at = cb.tail[ids], 0
        for n in each:
            lp[:n] -= cost[at:at + n]
            at += n
        out = np.empty(len(lp))
        out[order] = lp
        return out

    def _mixed(self, xs: np.ndarray, match: tuple | None, gate: np.ndarray) -> np.ndarray:
        """Log odds of a 1 by the weights of the gates. ``match``: places that have a
        prediction by match, and the predictions."""
        x = _take(self.weights[0], gate) * xs[0]
        for w, s in zip(self.weights[1:], xs[1:]):
            x += _take(w, gate) * s
        if match is not None:
            x[match[0]] += self.weights[-1][gate[match[0]]] * match[1]
        return np.clip(x, -12, 12, out=x)

    def _learn(self, xs: np.ndarray, match: tuple | None, gate: np.ndarray, bit: np.ndarray, each: list[int]) -> np.ndarray:
        """Log odds of a 1, and a gradient step of the weights after each depth, by all its bits."""
        x, at = np.empty(len(gate), np.float32), 0
        goal = bit.astype(np.float32)
        gate = gate.astype(np.intp)
        rows = GATES * np.arange(len(xs), dtype=np.intp)[:, None]
        met = np.bincount(gate + np.repeat(GATES * np.arange(len(each)), each), minlength=GATES * len(each)).reshape(-1, GATES)
        change = np.zeros(self.weights.shape)
        cuts = np.searchsorted(match[0], np.cumsum([0, *each])).tolist() if match is not None else [0] * (len(each) + 1)
        for n, step, i, j in zip(each, RATE / (0.3 * met + 12), cuts, cuts[1:]):
            s, w = xs[:, at:at + n], gate[at:at + n] + rows  # places in the array of all weights
            mixed = _take(self.weights.ravel(), w)
            mixed *= s
            p = np.add.reduce(mixed, axis=0, out=x[at:at + n])
            if match is not None:
                place, says = match[0][i:j] - at, match[1][i:j]
                of = w[0][place]
                p[place] += self.weights[-1][of] * says
            np.maximum(p, np.float32(-12), out=p)
            np.minimum(p, np.float32(12), out=p)
            p = np.exp(-p)
            p += np.float32(1)
            np.divide(np.float32(1), p, out=p)
            err = np.subtract(goal[at:at + n], p, out=p)
            change[:len(xs)] = np.bincount(w.ravel(), np.multiply(err, s, out=mixed).ravel(), len(xs) * GATES).reshape(-1, GATES)
            if match is not None:
                change[-1] = np.bincount(of, err[place] * says, GATES)
            self.weights += (change * step).astype(np.float32)
            at += n
        self.seen += met.sum(0)
        return x

    def parts(self, kind: str):
        """What other tasks' models are added to: (kind, place, bytes)."""
        for k in range(self.contexts):
            for at in range(0, self.size, CHUNK):
                cut = self.cells[k][2 * at:2 * (at + CHUNK)]
                if cut.any():  # zeros, then ones
                    yield f"{kind}{k}", at // CHUNK, zstandard.compress(cut.reshape(-1, 2).T.astype("<u4").tobytes(), 1)
        rest = np.concatenate([(self.weights * self.seen).ravel(), self.seen, self.map_n.ravel(), self.map_n1.ravel()])
        yield f"{kind}w", 0, zstandard.compress(rest.astype("<f8").tobytes(), 1)


def _take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.take(values, at, mode="clip")  # unchecked, which is what makes it fast


def _cell(row, x: np.ndarray) -> np.ndarray:
    """The map's cell: a row by depth and match, a column by the log odds."""
    return row * np.int16(BUCKETS) + (x * np.float32((BUCKETS - 1) / 24) + np.float32(BUCKETS / 2)).astype(np.int16)


def log_odds(n: np.ndarray, n1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds, rounded (times 512), and the confidence, 0 to 3, of counts."""
    n, odds = n.astype(np.float32), n1.astype(np.float32)
    conf = (n > 0).view(np.int8) + (n > 3).view(np.int8) + (n > 30).view(np.int8)
    n -= odds
    n += np.float32(0.4)
    odds += np.float32(0.4)
    odds /= n
    np.log(odds, out=odds)
    np.maximum(odds, np.float32(-15), out=odds)
    np.minimum(odds, np.float32(15), out=odds)
    odds *= np.float32(512)
    return np.rint(odds, out=odds), conf


def pack(n: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log odds (times 512) and two bits of confidence of counts in 16 bits."""
    odds, conf = log_odds(n, n1)
    return (odds.astype(np.int16) << 2) | conf


def merged(rows: DataFrame) -> dict:
    """Sum the parts (kind, place, data) of all tasks; the result grows as the tables do."""

    def run(batches):
        key, total = None, None

        def out(key, total):
            if key[0][-1] != "w":
                zeros, ones = total.reshape(2, -1)
                total = pack(zeros + ones, ones).astype("<i2")
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int32()),
                                               pa.array([zstandard.compress(total.tobytes(), 1)], pa.binary())], ["kind", "place", "data"])

        for b in batches:
            for kind, place, data in zip(*(b.column(i) for i in range(3))):
                here = (kind.as_py(), place.as_py())
                x = zstandard.decompress(data.as_py())
                x = np.frombuffer(x, "<f8") if here[0][-1] == "w" else np.frombuffer(x, "<u4").astype(np.uint64)
                if here == key:
                    total = total + x
                else:
                    if key is not None:
                        yield out(key, total)
                    key, total = here, x
        if key is not None:
            yield out(key, total)

    summed = rows.repartition("kind", "place").sortWithinPartitions("kind", "place").mapInArrow(run, rows.schema)
    return {(r["kind"], r["place"]): zstandard.decompress(r["data"]) for r in summed.collect()}


def mixer_of(parts: dict, kind: str, contexts: int, bits: int = TABLE_BITS) -> Mixer:
    m = Mixer(contexts, bits)
    m.cells = []  # only the packed form is needed to predict
    m._packed = [np.zeros(m.size, np.int16) for _ in range(contexts)]
    for k in range(contexts):
        for at in range(0, m.size, CHUNK):
            if data := parts.get((f"{kind}{k}", at // CHUNK)):
                m.packed[k][at:at + CHUNK] = np.frombuffer(data, "<i2")
    if data := parts.get((f"{kind}w", 0)):
        x = np.frombuffer(data, "<f8")
        w, x = x[:m.weights.size].reshape(m.weights.shape), x[m.weights.size:]
        seen, x = x[:GATES], x[GATES:]
        m.weights = np.where(seen > 0, w / np.maximum(seen, 1), m.weights).astype(np.float32)
        n, n1 = x[:GATES * BUCKETS], x[GATES * BUCKETS:]
        plain = np.tile(np.linspace(-12, 12, BUCKETS), GATES)
        p = (n1 + 4 / (1 + np.exp(-plain))) / (n + 4)
        m.map = np.log(p / (1 - p)).astype(np.float32)
    return m


def mix32(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x.astype(np.uint32) + np.uint32(salt)) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(15))


def word_contexts(ids: np.ndarray, first: np.ndarray, end: int, classes: np.ndarray):
    """Contexts of the tokens ``ids`` (``first``: whether a text begins there) and the
    token that followed the same two tokens last in the text, or -1."""
    n = len(ids)
    doc = np.cumsum(first)
    p1 = np.full(n, end, np.int64)
    p1[1:] = np.where(first[1:], end, ids[:-1])
    p2 = np.full(n, end, np.int64)
    p2[1:] = np.where(first[1:], end, p1[:-1])
    place = np.arange(n)
    seen = np.maximum.accumulate(np.where(ids < FREQUENT, place, -1))
    last = np.full(n, -1)
    last[1:] = seen[:-1]
    begin = np.maximum.accumulate(np.where(first, place, 0))
    frequent = np.where(last >= begin, ids[np.maximum(last, 0)], end)
    wide = end + 257  # ids are less
    pair = p2 * wide + p1
    pred = np.full(n, -1, np.int64)
    if n * wide * wide < 1 << 63:
        key = doc * (wide * wide) + pair
        bits = np.uint64(n.bit_length())
        order = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> bits << bits | place.astype(np.uint64)
        order.sort()  # by a hash of the key, then by place: sorts faster than an index
        same = np.flatnonzero(order[1:] >> bits == order[:-1] >> bits)
        order = (order & np.uint64((1 << n.bit_length()) - 1)).astype(np.intp)
        before, after = order[same], order[same + 1]
        if (key[before] != key[after]).any():  # two keys have one hash
            order = np.argsort(key, kind="stable")
            same = key[order[1:]] == key[order[:-1]]
            before, after = order[:-1][same], order[1:][same]
    else:
        order = np.lexsort((pair, doc))
        same = (pair[order[1:]] == pair[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
        before, after = order[:-1][same], order[1:][same]
    pred[after] = ids[before]
    return [mix32(classes[p1], 1), mix32(frequent, 3)], pred


def bytes_before(ids: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Of the bytes ``ids`` of words, one after the other, the one to four bytes before; 257 before a word."""
    since = np.arange(len(ids)) - np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))

    def before(k: int) -> np.ndarray:
        out = np.full(len(ids), 257, np.int64)
        out[k:] = ids[:-k]
        return np.where(since >= k, out, 257)

    return [before(k) for k in (1, 2, 3, 4)]


def spell_contexts(ids: np.ndarray, first: np.ndarray):
    """Contexts of the bytes ``ids`` of words, one after the other."""
    return contexts_of(bytes_before(ids, first))


def contexts_of(before: list[np.ndarray]) -> list[np.ndarray]:
    a, b, c, d = before
    three = (a * 259 + b) * 259 + c
    return [mix32(three, 6), mix32(a * 259 + b, 5), mix32(a, 4), mix32(three * 259 + d, 7)]


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct value, and for each value which of them it is."""
    order = np.argsort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[order[1:]] != values[order[:-1]]
    of = np.empty(len(values), np.intp)
    of[order] = np.cumsum(new) - 1
    return order[new], of


class Model:
    """Dictionary, codes and (after training) the mixers; one per worker."""

    def __init__(self, words: list[bytes], counts: list[int], n_tokens: int, n_distinct: int, n_end: int,
                 escapes: np.ndarray, byte_counts: np.ndarray):
        """``escapes``: tokens that are escaped, by first byte."""
        self.blob, self.counts = b"\n".join(words), np.array(counts, np.int64)
        self.n_tokens, self.n_distinct, self.n_end = n_tokens, n_distinct, n_end
        rank = np.zeros(len(words) + 257, np.int64)  # words alike get codes alike
        keys = words + [END] + [bytes([x]) for x in range(256)]
        rank[sorted(range(len(keys)), key=keys.__getitem__)] = np.arange(len(keys))
        self.word_code = Codebook(np.concatenate([self.counts, [n_end], escapes]), rank)
        self.byte_code = Codebook(byte_counts, np.arange(len(byte_counts)))
        self.word_mixer: Mixer | None = None
        self.byte_mixer: Mixer | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("ids", "spelled")}

    @property
    def end(self) -> int:
        """The end's id; the escapes follow it."""
        return len(self.counts)

    @functools.cached_property
    def ids(self) -> dict[bytes, int]:
        words = self.blob.split(b"\n") if len(self.counts) else []
        return {w: i for i, w in enumerate(words)} | {END: self.end}

    @functools.cached_property
    def spelled(self) -> list[dict[bytes, float]]:
        return [{}, {}]

    def token_ids(self, texts: pa.Array | list[str | None], once: bool = False):
        """(ids, whether a text begins, escaped places, their words, lengths) of texts
        one after the other; ``once``: escape words counted once as well."""
        flat, lens = arrow_tokens(texts)
        flat = flat.dictionary_encode()  # a word is looked up once
        at, keys = flat.indices.to_numpy(), flat.dictionary.to_numpy(zero_copy_only=False)
        of = np.fromiter(map(self.ids.get, keys, itertools.repeat(-1)), np.int32, len(keys))
        rare = of < 0
        if once and self.end:
            rare |= (of < self.end) & (self.counts[np.minimum(of, self.end - 1)] < 2)
        of[rare] = self.end + 1 + np.fromiter((w[0] for w in keys[rare]), np.int32, int(rare.sum()))
        first = np.zeros(len(at), bool)
        first[np.cumsum(lens) - lens] = True
        places = np.flatnonzero(rare[at])
        return of[at], first, places, keys[at[places]].tolist(), lens

    def token_blocks(self, texts: pa.Array, size: int, once: bool = False):
        """(texts, ``token_ids`` of them) by blocks of about ``size`` characters, several of which are cut into words together."""
        for held in itertools.batched(blocks(texts, size), max(1, TOGETHER // size)):
            ids, first, rare, words, lens = self.token_ids(pa.concat_arrays(held), once)
            text, at, seen = 0, 0, 0
            for b in held:
                n = lens[text:text + len(b)]
                end = at + int(n.sum())
                upto = int(np.searchsorted(rare, end))
                yield b, ids[at:end], first[at:end], rare[seen:upto] - at, words[seen:upto], n
                text, at, seen = text + len(b), end, upto

    def spell(self, words: list[bytes]) -> np.ndarray:
        """Natural log probability of the spelling of each word."""
        known, old = self.spelled
        if len(known) > CACHE_WORDS // 2:  # the half not met lately goes
            self.spelled[:] = known, old = {}, known
        todo = set(words).difference(known)
        known.update((w, old[w]) for w in todo if w in old)
        todo = [w for w in todo if w not in old]
        for at in range(0, len(todo), 1 << 14):
            part = todo[at:at + (1 << 14)]
            ids, first, lens = byte_ids(part)
            before = bytes_before(ids, first)
            once, of = distinct(functools.reduce(lambda x, y: x * 259 + y, before, ids))  # of the byte and all that its contexts are made of
            lp = self.byte_mixer.run(self.byte_code, ids[once], contexts_of([b[once] for b in before]), None, False)[of]
            lp[first] = 0.0  # the escape has told the first byte
            known.update(zip(part, np.add.reduceat(lp, np.cumsum(lens) - lens).tolist()))
        return np.fromiter(map(known.__getitem__, words), np.float64, len(words))


def arrow_tokens(texts: pa.Array | list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """The tokens of ``tokens_of``, one text after the other, and the texts' numbers of them."""
    t = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
    t = pc.ascii_lower(pc.ascii_trim_whitespace(t))
    none, space = pa.scalar("", t.type), pa.scalar(" ", t.type)
    t = pc.binary_join_element_wise(t, pc.if_else(pc.equal(t, none), none, space), none)  # the last space is followed by the end
    words = pc.ascii_split_whitespace(t)
    return words.flatten().cast(pa.binary() if t.type == pa.string() else pa.large_binary()), pc.list_value_length(words).to_numpy().astype(np.int64)


def tokens_of(text: str | None) -> list[bytes]:
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    words.append(END)
    return words


def byte_ids(words: list[bytes]):
    """Bytes of the words, each followed by the terminator 256."""
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ids = np.full(int(lens.sum()), 256, np.int64)
    inner = np.ones(len(ids), bool)
    inner[np.cumsum(lens) - 1] = False
    ids[inner] = np.frombuffer(b"".join(words), np.uint8)
    first = np.zeros(len(ids), bool)
    first[np.cumsum(lens) - lens] = True
    return ids, first, lens


def blocks(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Runs of texts of about ``size`` characters."""
    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), 1):
        held += n + 1
        if held >= size:
            yield texts.slice(start, i - start)
            start, held = i, 0
    if start < len(texts):
        yield texts.slice(start)


def count_words(docs: DataFrame) -> DataFrame:
    """Stored rows (word, n) of the tokens of ``docs`` (text)."""

    def run(batches):
        for b in batches:
            for texts in blocks(b.column(0), 4 * TOGETHER):
                words, n = arrow_tokens(texts)[0].value_counts().flatten()
                yield pa.RecordBatch.from_arrays([words.cast(pa.binary()), n], ["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word binary, n long")
    return stored(rows.groupBy("word").agg(F.sum("n").alias("n")), "lm-counts")


def train(docs: DataFrame, max_words: int | None = None):
    """(broadcast model, count table, tokens, distinct words) of ``docs`` (text)."""
    spark = docs.sparkSession
    counts = count_words(docs)
    all_ = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v"),
                      F.sum(F.when(F.col("word") == F.lit(END), F.col("n"))).alias("ends")).first()
    n, ends = all_["n"] or 0, all_["ends"] or 0
    max_words = dictionary_words(n) if max_words is None else max_words
    word_bits, byte_bits = table_bits(n), table_bits(8 * all_["v"])  # a distinct word is spelled in about 8 bytes
    top = counts.where((F.octet_length("word") > 0) & (F.octet_length("word") <= MAX_WORD_BYTES)) \
        .orderBy(F.desc("n"), "word").limit(max_words).collect()
    words, own = [bytes(r["word"]) for r in top], [r["n"] for r in top]
    letters = np.bincount(np.frombuffer(b"".join(words), np.uint8), minlength=257)[:257]
    letters[256] = len(words)
    escapes = np.zeros(256, np.int64)  # tokens outside the dictionary, and words met once, by first byte
    held = (F.col("n") == 1) | (F.octet_length("word") > MAX_WORD_BYTES)
    if len(words) == max_words:
        held = held | (F.col("n") < own[-1]) | (F.col("n") == own[-1]) & (F.col("word") > F.lit(words[-1]))
    for r in counts.where(held & (F.octet_length("word") > 0)).groupBy(F.substring(F.hex("word"), 1, 2).alias("b")) \
            .agg(F.sum("n").alias("n")).collect():
        escapes[int(r["b"], 16)] = r["n"]
    model = Model(words, own, n, all_["v"], ends, escapes, letters)
    sent = spark.sparkContext.broadcast(pickle.dumps(model, 5))

    def learn_words(batches):
        m = worker_model(sent)
        mixer, size = Mixer(WORD_CONTEXTS, word_bits), 20_000  # small blocks first: weights and counts learn together
        with no_gc():
            for b in batches:
                for _, ids, first, _, _, _ in m.token_blocks(b.column(0), size, once=True):
                    size = min(6 * BLOCK_TOKENS, size + size // 4)
                    ctx, pred = word_contexts(ids, first, m.end, m.word_code.classes)
                    mixer.run(m.word_code, ids, ctx, pred, True, scores=False)
        yield from part_batches(mixer.parts("w"))

    def learn_spelling(batches):
        m = worker_model(sent)
        mixer, size = Mixer(SPELL_CONTEXTS, byte_bits), 512
        with no_gc():
            for b in batches:
                words = [w for w in b.column(0).to_pylist() if w]
                while words:
                    ids, first, _ = byte_ids(words[:size])
                    words, size = words[size:], min(32_768, 2 * size)
                    mixer.run(m.byte_code, ids, spell_contexts(ids, first), None, True, scores=False)
        yield from part_batches(mixer.parts("b"))

    schema = "kind string, place int, data binary"
    parts = merged(docs.select("text").mapInArrow(learn_words, schema)
                   .unionByName(counts.select("word").mapInArrow(learn_spelling, schema)))
    model.word_mixer = mixer_of(parts, "w", WORD_CONTEXTS, word_bits)
    model.byte_mixer = mixer_of(parts, "b", SPELL_CONTEXTS, byte_bits)
    return spark.sparkContext.broadcast(pickle.dumps(model, 5)), counts, n, all_["v"]


def part_batches(parts):
    for kind, place, data in parts:
        yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([place], pa.int32()), pa.array([data], pa.binary())],
                                         ["kind", "place", "data"])


_model: dict = {}


def worker_model(sent) -> Model:
    """The model of a broadcast, unpacked once per worker process."""
    if _model.get("of") is not sent.value:
        _model.clear()
        _model.update(of=sent.value, model=pickle.loads(sent.value))
    return _model["model"]


def _scored(docs: DataFrame, sent) -> DataFrame:
    """Per row of ``docs`` (id, text): score and the base over the dictionary's
    words; ``rare`` has the other words with their times."""
    schema = docs.select("id").schema.add("n_tokens", "long").add("n_bytes", "long").add("n_known", "long") \
        .add("base", "double").add("score", "double")\
        .add("words", T.ArrayType(T.BinaryType())).add("times", T.ArrayType(T.IntegerType()))

    def run(batches):
        from collections import Counter
        m = worker_model(sent)
        logs = np.log10((np.concatenate([m.counts, [m.n_end]]) + 0.5) / (m.n_tokens + 0.5 * (m.n_distinct + 1)))
        for b in batches:
            at = 0
            with no_gc():
                for texts, ids, first, rare, rare_words, lens in m.token_blocks(b.column("text"), 6 * BLOCK_TOKENS):
                    starts = np.cumsum(lens) - lens
                    ctx, pred = word_contexts(ids, first, m.end, m.word_code.classes)
                    lp = m.word_mixer.run(m.word_code, ids, ctx, pred, False)
                    lp[rare] += m.spell(rare_words)
                    base = np.where(ids > m.end, 0.0, logs[np.minimum(ids, m.end)])
                    known = (ids < m.end) | (ids == m.end) & (m.n_end > 0)
                    cut = np.searchsorted(rare, np.append(starts, len(ids))).tolist()
                    per = [Counter(rare_words[i:j]) for i, j in zip(cut, cut[1:])]
                    n = len(texts)
                    yield pa.RecordBatch.from_arrays([
                        b.column("id").slice(at, n), pa.array(lens),
                        pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()),
                        pa.array(np.add.reduceat(known.astype(np.int64), starts)), pa.array(np.add.reduceat(base, starts)),
                        pa.array(np.add.reduceat(lp, starts) * LOG10E),
                        pa.array([list(c.keys()) for c in per], pa.list_(pa.binary())),
                        pa.array([list(c.values()) for c in per], pa.list_(pa.int32()))], schema.names)
                    at += n

    return docs.select("id", "text").mapInArrow(run, schema)


def fold(id_text: Column) -> Column:
    return F.crc32(F.coalesce(id_text.cast("string"), F.lit("")).cast("binary")) % FOLDS


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_words: int | None = None) -> DataFrame:
    """One row per document: (id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte); scores are log10 probabilities."""
    d = docs.select(col(docs, id_col).alias("id"), col(docs, text_col).alias("text"))
    held = fold(F.col("id")) == HELD_FOLD
    sent, counts, n, v = train(d.where(~held).select("text"), max_words)
    rows = stored(_scored(d, sent).withColumn("rid", F.monotonically_increasing_id()), "lm-rows")
    log = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(n + 0.5 * (v + 1)))
    rare = rows.select("rid", F.explode(F.arrays_zip("words", "times")).alias("w")) \
        .select("rid", F.col("w.words").alias("word"), F.col("w.times").alias("times")) \
        .join(counts, "word", "left") \
        .groupBy("rid").agg(F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
                            F.sum(F.col("times") * log).alias("rare_base"))
    bits = F.try_divide(-F.col("score") / F.lit(float(np.log10(2.0))), F.col("n_bytes"))
    return rows.drop("words", "times").join(rare, "rid", "left").select(
        "id", held.alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score", bits.alias("bits_per_byte"))


@query("op1_lm_scoring")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
