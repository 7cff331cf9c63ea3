"""BPE encoding and decoding with a pair occurrence index.

Texts are cut into pieces that no merge crosses. The distinct pieces a worker has
not met yet are encoded together: their symbols are laid out in one linked list,
an index maps every pair to all its positions, and the active ranks are applied
in ascending order. Applying a rank merges all its positions from left to right
and updates the lists of the neighbouring pairs. Pieces met before come from the
worker's bounded cache. Decoding joins the tokens' bytes.

The tokenizer file (JSON of the tokenizers library: byte-level BPE without
normalizer) is a parameter and must be at the same path on every node; a file
whose merges or settings this module does not cover is refused, not guessed.

Defined cases. Null is the empty text: no ids, and it decodes to the empty text.
Special strings inside a text become their special ids, as in the library. Any
text length; extra columns may have any name; repeated rows give repeated
results; an empty table gives an empty result.

Scale: no shuffle; each task holds one Arrow batch, the tokenizer's tables and a
cache of at most ``CACHE_PIECES`` pieces.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import json
import re
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import col, fresh, no_gc, table, trim_memory
from tessera.llm.registry import query

CACHE_PIECES = 400_000
#: texts are encoded in blocks of about so many characters, and decoded of so many ids
BLOCK_CHARS = 2_000_000
BLOCK_IDS = 200_000
BATCH_ROWS = 1_000
#: Unicode white space, as the pattern's \s has it
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: pieces that the pattern below never crosses: a run of other characters with
#: one space before it, or white space
COARSE = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
SPACES = set(re.findall(f"[{SPACE}]", "".join(map(chr, range(0x3001)))))
OTHER_SPACE = re.compile("[" + re.escape("".join(SPACES - {" ", "\n"})) + "]")


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable bytes stand for
    themselves, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Tables of one tokenizer file, and the encoder and decoder."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        m, pre = j["model"], j["pre_tokenizer"] or {}
        plain = (m["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space") and j["normalizer"] is None and not m.get("dropout")
                 and not m.get("ignore_merges") and not m.get("continuing_subword_prefix")
                 and not m.get("end_of_word_suffix") and (j["decoder"] or {}).get("type") == "ByteLevel"
                 and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in j["added_tokens"]))
        if not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        vocab, alphabet = m["vocab"], byte_alphabet()
        # fixed value: the pre-tokenizer's pattern
        self.fine = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.of_byte = np.array([vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])], np.int32)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in m["merges"]]
        #: by rank: left, right, merged id
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.ranks = {(a, b): r for r, (a, b, _) in enumerate(self.merges)}
        made = {new: r for r, (_, _, new) in enumerate(self.merges)}
        if len(made) < len(self.merges) or any(made.get(x, -1) > r for (a, b), r in self.ranks.items() for x in (a, b)):
            raise ValueError(f"{path}: merges are not in the order that makes their parts")
        keys = np.array([(a << 32) | b for a, b, _ in self.merges], np.int64)
        self.pair_ranks = np.argsort(keys)
        self.pairs = keys[self.pair_ranks]
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        cut = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.cut = re.compile(f"({cut})") if cut else None
        table = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        tokens = [table.get(i, b"") for i in range(max(table) + 1)]
        #: all tokens' bytes one after the other, and where each begins
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.byte_len = np.array([len(t) for t in tokens])
        self.byte_at = np.cumsum(self.byte_len) - self.byte_len
        self.old: dict[str, bytes] = {}  # the cache, in two halves by age
        self.fresh: dict[str, bytes] = {}

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for pairs without one."""
        pair = (left.astype(np.int64) << 32) | (right.astype(np.int64) & 0xFFFFFFFF)
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.pair_ranks[at], -1)

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, number of ids of each word).

        All words lie in one linked list, divided by a symbol that is in no
        pair. ``index`` has the positions of every active pair by its rank."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        size = int(lens.sum()) + len(words) + 1
        word_of = np.repeat(np.arange(len(words)), lens + 1)
        sym = np.full(size, -1, np.int32)
        inner = np.ones(size, bool)
        inner[0] = False
        inner[np.cumsum(lens + 1)] = False  # symbol 0 and the one after each word
        sym[inner] = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        nxt = np.arange(1, size + 1, dtype=np.int32)
        prv = np.arange(-1, size - 1, dtype=np.int32)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(ranks: np.ndarray, places: np.ndarray) -> None:
            keep = ranks >= 0
            ranks, places = ranks[keep], places[keep]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, group in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(places, cuts)):
                if r in index:
                    index[r].append(group)
                else:
                    index[r] = [group]
                    heapq.heappush(active, r)

        enter(self.ranks_of(sym[:-1], sym[1:]), np.arange(size - 1))
        sym_m, nxt_m, prv_m = memoryview(sym), memoryview(nxt), memoryview(prv)
        while active:
            rank = heapq.heappop(active)
            a, b, new = self.merges[rank]
            found = index.pop(rank)
            places = np.concatenate(found) if len(found) > 1 else found[0]
            if a == b or len(places) < 12:  # few, or maybe overlapping: one by one, left to right
                for p in sorted(places.tolist()):
                    q = nxt_m[p]
                    if sym_m[p] != a or sym_m[q] != b:  # an earlier merge took one of them
                        continue
                    n, before = nxt_m[q], prv_m[p]
                    sym_m[p], sym_m[q] = new, -2
                    nxt_m[p], prv_m[n] = n, p
                    for at, pair in ((p, (new, sym_m[n])), (before, (sym_m[before], new))):
                        r = self.ranks.get(pair)
                        if r is not None:
                            if r in index:
                                index[r].append(np.array([at]))
                            else:
                                index[r] = [np.array([at])]
                                heapq.heappush(active, r)
                continue
            # a place gets a pair of different symbols once only, and such pairs never overlap
            places = places[sym[places] == a]
            seconds = nxt[places]
            fit = sym[seconds] == b
            places, seconds = places[fit], seconds[fit]
            after = nxt[seconds]
            sym[places], sym[seconds] = new, -2
            nxt[places], prv[after] = after, places
            before = prv[places]
            enter(self.ranks_of(sym[places], sym[after]), places)
            enter(self.ranks_of(sym[before], sym[places]), before)
        ids = sym[sym >= 0]
        return ids, np.bincount(word_of[np.flatnonzero(sym >= 0) - 1], minlength=len(words))

    def keys_of(self, x: str) -> list[str]:
        """Cache keys of the pieces of a text without special strings. A key is a
        piece without the one space before it; pieces of white space are their
        own keys; a piece without a space before it has a carriage return there.

        In a text whose white space is single spaces and line feeds inside words
        (the common case), cutting at the spaces gives the pieces, or several
        that follow each other, as one."""
        if "  " in x or " \n" in x or "\n " in x or x[-1:] == " " or OTHER_SPACE.search(x):
            found, keys = COARSE.findall(x), []
        else:
            first, *keys = x.split(" ")
            found = COARSE.findall(first)
        spelled = [p[1:] if p[0] == " " and len(p) > 1 and p[1] not in SPACES else p if p[0] in SPACES else "\r" + p for p in found]
        return spelled + keys

    @staticmethod
    def piece_of(key: str) -> str:
        if key[0] == "\r" and len(key) > 1 and key[1] not in SPACES:
            return key[1:]
        return key if key[0] in SPACES else " " + key

    def learn(self, keys: set[str]) -> None:
        """Put the pieces that the cache does not have into it."""
        fresh, old = self.fresh, self.old
        todo = keys.difference(fresh)
        fresh.update((x, old[x]) for x in todo if x in old)
        todo = [x for x in todo if x not in old]
        words = list(map(self.cut_piece, map(self.piece_of, todo)))
        place = {w: i for i, w in enumerate(dict.fromkeys(itertools.chain.from_iterable(words)))}
        if not place:
            return
        ids, counts = self.merge_all([w.encode() for w in place])
        raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        starts = [0, *ends]
        for x, ws in zip(todo, words):
            i = place[ws[0]]
            fresh[x] = raw[starts[i]:ends[i]] if len(ws) == 1 else \
                b"".join([raw[starts[i]:ends[i]] for i in map(place.__getitem__, ws)])

    def cut_piece(self, x: str) -> list[str]:
        """The pattern's words of a piece; plain words are told without it."""
        if x[1:].isalpha() and (x[0] == " " or x[0].isalpha()):
            return [x]
        if x[-1] in ".," and x[1:-1].isalpha() and (x[0] == " " or x[0].isalpha()):
            return [x[:-1], x[-1]]
        return self.fine.findall(x)

    @no_gc()
    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, rows, chars = [], [], 0
        for t in texts:
            rows.append([(x, None) if x in self.special else (x, self.keys_of(x))
                         for x in (self.cut.split(t or "") if self.cut else [t or ""])])
            chars += len(t or "")
            if chars >= BLOCK_CHARS:
                out += self._encode_block(rows)
                rows, chars = [], 0
        return out + self._encode_block(rows)

    def forget(self) -> None:
        """Give up the cache of pieces."""
        self.old, self.fresh = {}, {}

    def _encode_block(self, rows: list) -> list[bytes]:
        if len(self.fresh) > CACHE_PIECES // 2:  # the half not met lately goes
            self.old, self.fresh = self.fresh, {}
        self.learn(set().union(*(keys for row in rows for _, keys in row if keys)))
        get, special = self.fresh.__getitem__, self.special
        return [b"".join([struct.pack("<I", special[x]) if keys is None else b"".join(map(get, keys)) for x, keys in row])
                for row in rows]

    def decode(self, rows: list[bytes | None]) -> list[str]:
        """The texts of rows of little-endian unsigned 32-bit ids."""
        out, block, held = [], [], 0
        for r in rows:
            block.append(bytes(r or b""))
            held += len(block[-1])
            if held >= 4 * BLOCK_IDS:
                out += self._decode_block(block)
                block, held = [], 0
        return out + self._decode_block(block)

    def _decode_block(self, rows: list[bytes]) -> list[str]:
        ids = np.frombuffer(b"".join(rows), "<u4").astype(np.int64)
        lens = self.byte_len[ids]
        ends = np.cumsum(lens)
        # byte j of a token lies j after the token's start in the table of all tokens' bytes
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.byte_at[ids] - (ends - lens), lens)
        raw = self.blob[place].tobytes()
        cuts = np.cumsum([0] + [len(r) // 4 for r in rows])
        at = np.concatenate(([0], ends))[cuts].tolist()
        return [raw[i:j].decode("utf-8", "replace") for i, j in zip(at, at[1:])]


@functools.cache
def bpe(path: str) -> ByteBpe:
    """One per worker process and file."""
    return ByteBpe(path)


def encoded(text: Column, path: str) -> Column:
    """The ids of a text: binary, little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(bpe(path).encode(texts.tolist()), dtype=object)

    return of(text)


def decoded(ids: Column, path: str) -> Column:
    """The text of ids as ``encoded`` gives them."""

    @F.pandas_udf("string")
    def of(rows: pd.Series) -> pd.Series:
        return pd.Series(bpe(path).decode(rows.tolist()), dtype=object)

    return of(ids)


def encode_decode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns: its ids and their text, named ``ids`` and
    ``decoded`` (with underscores before them if ``docs`` has such columns). One Python
    worker a task does both."""

    ids, back = fresh(docs, "ids", "decoded")
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns])
    at_column = docs.columns.index(text_col)
    schema = T.StructType([*rows.schema.fields, T.StructField(ids, T.BinaryType()), T.StructField(back, T.StringType())])

    def run(batches):
        for big in batches:
            for at in range(0, big.num_rows, BATCH_ROWS):  # results leave in small batches
                b = big.slice(at, BATCH_ROWS)
                found = bpe(path).encode(b.column(at_column).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(found, pa.binary()), pa.array(bpe(path).decode(found), pa.string())], schema.names)
        bpe(path).forget()  # the worker lives on and may do other work next
        trim_memory()

    return rows.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    d = encode_decode(docs.select(col(docs, id_col).alias("doc_id"), col(docs, text_col).alias("text")), path)
    return d.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                    F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op10_bpe_encoding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document by byte_bpe_50k.json."""
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
