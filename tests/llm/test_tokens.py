"""Token counts and token output against the library."""

import random
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import ODD, SF001, empty, rows_of, docs, odd, spark  # noqa: F401  (fixtures)
from tessera.llm import token_counts as C
from tessera.llm import token_output as O
from tessera.llm import word_tokens as W
from tessera.session import shared_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def lib_ids(lib, t):
    return lib.encode(t or "", add_special_tokens=False).ids


def test_pieces_match_library(lib):
    random.seed(4)
    chars = list("ab cd'stelm  \n\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 ​　᠎123½²é日本ñ😀́ßΣςİ가ᄀ.!\x00﻿") + \
        ["<|endoftext|>", "<|startoftext|>", "'ll", "'re", " the", "ά", "ŉ", "ſ", "Ö", "×"]
    texts = ODD + ["".join(random.choices(chars, k=random.randint(0, 30))) for _ in range(4000)]
    want = [lib_ids(lib, t) for t in texts]
    assert [list(memoryview(x).cast("I")) for x in W.encode(PATH, texts)] == want
    assert [list(memoryview(x).cast("I")) for x in W.encode(PATH, texts, limit=50)] == want  # a small cache changes nothing


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        W.load(public_tokenizers.path("byte_bpe_50k.json"))


def test_counts(spark, odd, lib):
    for size in (0, 3, 1000):
        got = C.counts(odd, PATH, table_size=size, limit=100)
        want = []
        for r in odd.collect():
            n = len(lib_ids(lib, r.text))
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 100))
        assert rows_of(got, *got.columns) == sorted(want, key=repr)
    assert C.counts(empty(odd), PATH).count() == 0


def test_summary_is_pruned_not_wrong(spark, docs, lib):
    f = C.frequent(docs, PATH, table_size=50, summary_size=100)
    assert len(f.table) == 50 and all(n == len(lib_ids(lib, w.decode())) for w, n in f.table.items())


def test_written_ids_read_back(spark, odd, lib):
    out = shared_dir(spark, "t-ids")
    index = O.write_tokens(odd, out, PATH, sample_docs=5)
    got = sorted(((r.id, r.n_tokens, bytes(r.ids)) for r in O.read_tokens(index, out).collect()), key=repr)
    want = []
    for r in odd.collect():
        x = lib_ids(lib, r.text) + [2]
        want.append((r.doc_id, len(x), struct.pack(f"<{len(x)}I", *x)))
    assert got == sorted(want, key=repr)
    one = O.fetch(index, out, [6]).collect()
    assert [bytes(r.ids) for r in one] == [x for i, _, x in want if i == 6]
    none = shared_dir(spark, "t-ids")
    assert O.read_tokens(O.write_tokens(empty(odd), none, PATH), none).count() == 0


def test_wrong_dictionary_is_an_error(spark, docs):
    out = shared_dir(spark, "t-ids")
    index = O.write_tokens(docs, out, PATH, sample_docs=50)
    fs, base = O.open_fs(out)
    with fs.open_input_stream(f"{base}/dictionary") as f:
        assert f.read()
    with fs.open_output_stream(f"{base}/dictionary") as f:
        f.write(b"")
    with pytest.raises(Exception, match="dictionary"):
        O.read_tokens(index, out).collect()


def test_query(spark, lib):
    start, want = 0, []
    for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect():
        x = lib_ids(lib, r.text) + [2]
        want.append((r.doc_id, start, len(x), zlib.crc32(struct.pack(f"<{len(x)}I", *x))))
        start += len(x)
    got = O.op3(spark, SF001).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want


def test_pre_tokens_are_encoded_once_and_bounded():
    path = public_tokenizers.path("word_bpe_49k.json")
    words = [f"{a}{b}{c}".encode() for a in ("qzx", "Qzx", "Ünb", "中") for b in ("", "'s", "7é") for c in ("", ",", "ſ", "<|")]
    known = W.PreTokens(path, 40)
    calls, tokenize = [], known.tokenize
    known.tokenize = lambda x: calls.append(x) or tokenize(x)
    before, W.pre_tokens = W.pre_tokens, lambda p: known
    try:
        first = W.encode_pieces(path, words)
        n = len(calls)
        assert W.encode_pieces(path, words[:20]) == first[:20] and len(calls) == n  # across calls
        for i in range(300):
            W.encode_pieces(path, [b"w" + bytes([97 + i // 26, 97 + i % 26])])
        assert len(known) <= 40 and len(known.old) <= 40
    finally:
        W.pre_tokens = before
    whole = [e.ids for e in W.load(path).encode_batch([w.decode() for w in words], add_special_tokens=False)]
    assert first == whole
