import hashlib
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from llm_fixtures import SF001, empty, rows_of, docs, odd, spark  # noqa: F401  (fixtures)
from tessera.llm import quality, simhash
from tessera.llm.common import stored
from test_decontam import brute as brute_contamination
from test_simhash import brute_groups


@pytest.fixture(scope="module")
def steps(spark, docs):
    """The input of each stage and the last result, written and read as the driver does."""
    out = [docs]
    for name, f in P.STAGES:
        out.append(stored(f(spark, out[-1], SF001), f"t-{name}"))
    return out


def test_stages_are_declared():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "bpe_encoding"]


def test_quality_keeps_what_the_operator_keeps(spark, docs, steps):
    j = quality.judge(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    assert rows_of(steps[1], "doc_id") == rows_of(j.where("kept").selectExpr("id as doc_id"), "doc_id")
    assert steps[1].schema == docs.schema
    assert 0 < steps[1].count() < docs.count()


def test_dedup_keeps_one_of_each_group(steps):
    rows = sorted((r.doc_id, r.text) for r in steps[1].collect())
    groups = brute_groups([(i, simhash.fingerprint(t)) for i, t in rows], 2)
    assert rows_of(steps[2], "doc_id") == sorted(((g,) for g in set(groups)), key=repr)
    assert steps[2].schema == steps[1].schema


def test_decontamination_drops_only_contaminated(spark, steps):
    rows = sorted((r.doc_id, r.text) for r in steps[2].collect())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    bad = brute_contamination([t for _, t in rows], items)
    assert rows_of(steps[3], "doc_id") == sorted((((i,)) for (i, _), b in zip(rows, bad) if not b[3]), key=repr)
    assert steps[3].schema == steps[2].schema


def test_last_stage_and_run(spark, steps):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in steps[3].collect():
        x = lib.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(x), hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    cols = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows_of(steps[4], *cols) == sorted(want, key=repr)
    assert rows_of(P.run(spark, SF001), *cols) == sorted(want, key=repr)


def test_stages_take_odd_and_empty_tables(spark, docs, odd):
    clash = odd.selectExpr("doc_id", "text", "'en' as lang", "ids as counts", "id as kept_key")
    for df in (clash, empty(docs)):
        for i, (_, f) in enumerate(P.STAGES):
            got = f(spark, df, SF001)
            n = got.count()
            assert n <= df.count()
            if i < 3:
                assert got.columns == df.columns
