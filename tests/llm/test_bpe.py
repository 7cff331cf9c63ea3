import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import ODD, empty, rows_of, docs, odd, spark  # noqa: F401  (fixtures)
from tessera.llm import bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def ids(x):
    return list(memoryview(x).cast("I"))


def test_matches_library(lib, docs):
    random.seed(5)
    alphabet = list("ab cd'stelm  \n\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 ​　᠎123½²é日本ñ😀́ß.!\x00﻿") + \
        ["<|endoftext|>", "'ll", "'re", " the", "aaaa", "abab"]
    plain = ["a", "b.", "c,", " ", "\n", "\r", "\t", "ä", "1"]
    texts = ODD + ["".join(random.choices(alphabet, k=random.randint(0, 40))) for _ in range(4000)] + \
        ["".join(random.choices(plain, k=random.randint(0, 12))) for _ in range(8000)] + [r.text for r in docs.limit(100).collect()]
    ours = B.ByteBpe(PATH)
    want = [e.ids for e in lib.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = ours.encode(texts)
    assert [ids(x) for x in got] == want
    assert ours.decode(got) == [lib.decode(x, skip_special_tokens=False) for x in want]
    assert ours.decode(got) == [t or "" for t in texts]


def test_decode_of_any_ids(lib):
    random.seed(6)
    ours = B.ByteBpe(PATH)
    for _ in range(300):
        x = random.choices(range(50257), k=random.randint(0, 12))
        assert ours.decode([struct.pack(f"<{len(x)}I", *x)]) == [lib.decode(x, skip_special_tokens=False)]
    assert ours.decode([None, b""]) == ["", ""] and ours.decode([]) == []


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(B, "CACHE_PIECES", 200)
    monkeypatch.setattr(B, "BLOCK_CHARS", 500)
    ours, full = B.ByteBpe(PATH), B.ByteBpe(PATH)
    texts = [f"text {i} has the number {i * i}" for i in range(800)]
    assert ours.encode(texts) == full.encode(texts)
    assert len(ours.fresh) + len(ours.old) < 1200


def test_query_columns(spark, odd, lib):
    got = B.digests(odd, PATH)
    want = []
    for r in odd.collect():
        x = lib.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(x), hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert rows_of(got, *got.columns) == sorted(want, key=repr)
    assert B.digests(empty(odd), PATH).count() == 0
    both = B.encode_decode(odd, PATH)  # odd has a column named ids
    assert both.columns == [*odd.columns, "_ids", "decoded"]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        B.ByteBpe(public_tokenizers.path("word_bpe_49k.json"))
