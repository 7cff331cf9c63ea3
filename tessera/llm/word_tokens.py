"""Tokenizing by white-space pieces with the tokenizers library.

For tokenizer files whose pre-tokenizer drops white space, no token spans ASCII
white space, so a text's ids are its pieces' ids in order. Pieces met before are
looked up; only the others go through the library. ``load`` refuses files for
which this does not hold.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct

from tessera.llm.bpe import byte_alphabet
from tessera.llm.common import no_gc


@functools.cache
def load(path: str):
    """The library's tokenizer, once per worker process and file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    pre = j["pre_tokenizer"] or {}
    split = (pre.get("pretokenizers") or [pre])[0]
    drops_space = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") \
        and "\\s" not in split["pattern"].get("Regex", "\\s").replace("[^\\s", "[^") \
        and all(p.get("type") == "ByteLevel" and not p.get("use_regex") and not p.get("add_prefix_space")
                for p in (pre.get("pretokenizers") or [pre])[1:])
    norm = j["normalizer"] or {"type": "Sequence", "normalizers": []}
    by_char = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"}
                  and n["content"] == " " for n in norm.get("normalizers", [norm]))
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                    or any(c.isspace() for c in t["content"]) for t in j["added_tokens"])
    if not (drops_space and by_char and plain):
        raise ValueError(f"{path}: tokens may span white space")
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def pieces(text: str | None) -> list[bytes]:
    """Runs of other characters than ASCII white space, as UTF-8."""
    return (text or "").encode().split()


# fixed values: the pre-tokenizer pattern for which Latin pieces are cut here, and
# what it comes to on their lower case. LATIN: printable ASCII and the letters of
# U+00C0 to U+017E but for U+0130; NFC leaves them as they are, and each has a lower
# case of its own
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN = re.compile("[!-~À-ÖØ-öø-įı-ž]*")
LATIN_PATTERN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^a-z0-9ß-öø-ž]+")
#: byte (as a Latin-1 character) -> its character in the byte-level alphabet
BYTE_CHAR = {b: c for c, b in byte_alphabet().items()}


@functools.cache
def _latin_cut(path: str) -> bool:
    """Whether Latin pieces may go straight to the library's model."""
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    norm, pre = j["normalizer"] or {}, j["pre_tokenizer"] or {}
    kinds = [n["type"] for n in norm.get("normalizers", [])]
    return "Lowercase" in kinds and (pre.get("pretokenizers") or [pre])[0].get("pattern") == {"Regex": PATTERN} \
        and [p["type"] for p in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]


class PreTokens(dict):
    """Latin pre-token -> its ids by the library's model, packed; two halves by age
    bound its size."""

    def __init__(self, path: str, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}
        self.tokenize = load(path).model.tokenize

    def age(self) -> None:
        if len(self) > self.limit // 2:
            self.old = dict(self)
            self.clear()

    def __missing__(self, x: str) -> bytes:
        ids = self.old.get(x)
        if ids is None:
            chars = x if x.isascii() else x.encode().decode("latin-1").translate(BYTE_CHAR)
            found = self.tokenize(chars)
            ids = struct.pack(f"<{len(found)}I", *[y.id for y in found])
        self[x] = ids
        return ids


@functools.cache
def pre_tokens(path: str, limit: int = 400_000) -> PreTokens:
    return PreTokens(path, limit)


@functools.cache
def _special(path: str):
    """Search for any special string."""
    return re.compile("|".join(re.escape(x.content) for x in load(path).get_added_tokens_decoder().values()) or "(?!)").search


def packed_pieces(path: str, todo: list[bytes]) -> list[bytes]:
    """Ids of each piece by the library, as little-endian unsigned 32-bit integers. Latin
    pieces without special strings are cut into pre-tokens here, and the library's
    model encodes each distinct one; all others take the library's whole way."""
    t = load(path)
    words = [p.decode() for p in todo]
    out: list = [None] * len(words)
    if _latin_cut(path):
        special, latin, cut = _special(path), LATIN.fullmatch, LATIN_PATTERN.findall
        known = pre_tokens(path)
        known.age()
        for i, w in enumerate(words):
            if latin(w) and not special(w):
                low = w.lower()
                if low.isascii() and low.isalpha():  # one pre-token
                    out[i] = known[low]
                else:
                    out[i] = b"".join([known[x] for x in cut(low)])
    rest = [i for i, x in enumerate(out) if x is None]
    for i, e in zip(rest, t.encode_batch_fast([words[i] for i in rest], add_special_tokens=False) if rest else []):
        out[i] = struct.pack(f"<{len(e.ids)}I", *e.ids)
    return out


def encode_pieces(path: str, todo: list[bytes]) -> list[list[int]]:
    """Ids of each piece by the library."""
    return [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in packed_pieces(path, todo)]


class IdCache(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers; two halves by
    age bound its size."""

    def __init__(self, path: str, limit: int):
        super().__init__()
        self.path, self.limit, self.old = path, limit, {}

    def learn(self, seen: set[bytes]) -> None:
        """Make every piece of ``seen`` present."""
        if len(self) > self.limit // 2:
            self.old = dict(self)
            self.clear()
        todo = seen.difference(self)
        old = self.old
        self.update((p, old[p]) for p in todo if p in old)
        todo = [p for p in todo if p not in old]
        for at in range(0, len(todo), 20_000):
            part = todo[at:at + 20_000]
            self.update(zip(part, packed_pieces(self.path, part)))


@functools.cache
def id_cache(path: str, limit: int) -> IdCache:
    return IdCache(path, limit)


@no_gc()
def encode(path: str, texts: list[str | None], limit: int = 1_000_000) -> list[bytes]:
    """Ids of each text, as little-endian unsigned 32-bit integers."""
    cache = id_cache(path, limit)
    out = []
    for at in range(0, len(texts), 512):
        rows = [pieces(t) for t in texts[at:at + 512]]
        cache.learn({p for r in rows for p in r})
        get = cache.__getitem__
        out += [b"".join(map(get, r)) for r in rows]
    return out
