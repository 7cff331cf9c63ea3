import collections
import itertools
import math
import pickle
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm_fixtures import SF001, empty, docs, odd, spark  # noqa: F401  (fixtures)
from tessera.llm import lm_score as L


def tokens(t):
    return (t or "").encode().lower().split() + [b""]


def brute_base(rows):
    c = collections.Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1:
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    return [(len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
             sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t))) for _, t in rows]


def test_codebook_is_a_prefix_code():
    rng = np.random.default_rng(1)
    for n, depth in ((2, 9), (3, 1), (700, 9), (700, 64)):
        counts = rng.zipf(1.4, n)
        cb = L.Codebook(counts, rng.permutation(n), depth)
        cells = collections.Counter(zip(cb.lens.tolist(), cb.codes.tolist()))
        assert abs(sum(2.0 ** -d for d, _ in cells) - 1) < 1e-9  # complete
        tails = collections.defaultdict(float)
        for d, c, t in zip(cb.lens.tolist(), cb.codes.tolist(), cb.tail):
            tails[d, c] += math.exp(t)
        assert all(abs(x - 1) < 1e-9 for x in tails.values())


def model(texts, max_words=1000):
    c = collections.Counter(w for t in texts for w in tokens(t))
    top = [(w, k) for w, k in c.most_common() if w][:max_words]
    esc = np.zeros(256, np.int64)
    for w, k in c.items():
        if w and (k == 1 or w not in dict(top)):
            esc[w[0]] += k
    letters = np.bincount(np.frombuffer(b"".join(w for w, _ in top), np.uint8), minlength=257)[:257]
    letters[256] = len(top)
    m = L.Model([w for w, _ in top], [k for _, k in top], sum(c.values()), len(c), c[b""], esc, letters)
    m.word_mixer, m.byte_mixer = L.Mixer(L.WORD_CONTEXTS, 12), L.Mixer(L.SPELL_CONTEXTS, 12)
    ids, first, _, _, _ = m.token_ids(texts, once=True)
    ctx, pred = L.word_contexts(ids, first, m.end, m.word_code.classes)
    for _ in range(3):
        m.word_mixer.run(m.word_code, ids, ctx, pred, True)
    b, f, _ = L.byte_ids([w for w in c if w])
    m.byte_mixer.run(m.byte_code, b, L.spell_contexts(b, f), None, True)
    return m


def test_probabilities_of_all_next_symbols_add_up_to_one():
    random.seed(2)
    texts = [" ".join(random.choices(["aa", "ab", "b", "cc", "ä"], k=8)) for _ in range(50)]
    m = model(texts)
    n = len(m.word_code.lens)
    total = 0.0
    for s in range(n):  # each symbol after the same beginning
        ids = np.array([0, 1, 0, 1, s], np.int32)
        first = np.array([True, False, False, False, False])
        ctx, pred = L.word_contexts(ids, first, m.end, m.word_code.classes)
        total += math.exp(m.word_mixer.run(m.word_code, ids, ctx, pred, False)[-1])
    assert abs(total - 1) < 1e-4
    # spellings with a given first byte: all words of at most one more byte, and the longer ones
    lp = 0.0
    for x in range(257):
        ids = np.array([97, x])
        lp += math.exp(m.byte_mixer.run(m.byte_code, ids, L.spell_contexts(ids, np.array([True, False])), None, False)[-1])
    assert abs(lp - 1) < 1e-4


def test_weights_and_map_learn_from_every_bit():
    random.seed(3)
    texts = [" ".join(random.choices(["aa", "ab", "b", "cc", "ä"], k=8)) for _ in range(50)]
    m = model(texts)
    ids = m.token_ids(texts, once=True)[0]
    bits = 3 * int(m.word_code.lens[ids].sum())  # model() trains three times
    assert m.word_mixer.seen.sum() == bits and m.word_mixer.map_n.sum() == bits


def test_words_of_long_codes_are_told_apart_by_context():
    pairs = [(f"a{i}", f"b{i}") for i in range(1500)]
    random.seed(4)
    texts = [" ".join(p) for p in random.sample(pairs, len(pairs)) for _ in range(3)]
    m = model(texts, 5000)
    m.word_mixer = L.Mixer(L.WORD_CONTEXTS, 18)

    def run(texts, learn):
        ids, first, _, _, lens = m.token_ids(texts)
        ctx, pred = L.word_contexts(ids, first, m.end, m.word_code.classes)
        lp = m.word_mixer.run(m.word_code, ids, ctx, pred, learn)
        return np.add.reduceat(lp, np.cumsum(lens) - lens)

    for _ in range(5):
        run(texts, True)
    assert m.word_code.lens.max() > 9 and not m.word_code.tail.any()  # no bit is left to the counts
    of = m.word_code.codes[[m.ids[b.encode()] for _, b in pairs]] >> 2  # words whose codes differ at the end only
    like = {}
    for (_, b), c in zip(pairs, of.tolist()):
        like.setdefault(c, []).append(b)
    wrong = [(a, o) for (a, b), c in zip(pairs, of.tolist()) for o in like[c] if o != b]
    right = dict(zip((a for a, _ in pairs), run([" ".join(p) for p in pairs], False)))
    less = [right[a] - x for (a, _), x in zip(wrong, run([" ".join(p) for p in wrong], False))]
    assert len(less) > 1000 and np.mean(less) > 1


def test_spelling_mixes_all_bits_with_one_to_four_bytes_before():
    random.seed(5)
    m = model([" ".join("".join(random.choices("abcdefgh", k=9)) for _ in range(900)) + " äöü 日本語"])
    assert m.byte_code.lens.max() > 10 and not m.byte_code.tail.any()
    ids, first, _ = L.byte_ids([b"abcde", b"xbcde", b"xycde", b"xyzde", b"xyzwe"])
    ends = [[int(c[at]) for at in range(5, 30, 6)] for c in L.spell_contexts(ids, first)]
    same = sorted(sum(x == e[0] for x in e) for e in ends)  # the context at the end of each word
    assert same == [2, 3, 4, 5]


def test_a_score_does_not_depend_on_neighbours():
    texts = ["aa ab b aa", "cc b b b b", "", "ä zz aa"] * 5
    m = model(texts)

    def scores(part):
        ids, first, rare, words, lens = m.token_ids(part)
        ctx, pred = L.word_contexts(ids, first, m.end, m.word_code.classes)
        lp = m.word_mixer.run(m.word_code, ids, ctx, pred, False)
        lp[rare] += m.spell(words)
        return np.add.reduceat(lp, np.cumsum(lens) - lens)

    alone = [scores([t])[0] for t in texts]
    assert np.allclose(alone, scores(texts), atol=1e-5)


def corpus(spark):
    random.seed(7)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(random.choices(words, weights=[1 / (k + 1) for k in range(300)], k=60))) for i in range(400)]
    rows += [(None, "w1 NEW words"), (1000, None), (1001, ""), (1002, "x" * 3000 + " \x1c W1"), (5, rows[5][1]), (1003, "unseen " * 50)]
    return rows, spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, id int, words int")


def test_base_is_exact_and_model_learns(spark):
    rows, df = corpus(spark)
    for max_words in (40, 1 << 17):  # with the cap, most counts come from the join
        got = L.score(df, max_words=max_words).collect()
        assert len(got) == len(rows)
        want = sorted(((i, *x) for (i, _), x in zip(rows, brute_base(rows))), key=repr)
        have = sorted(((r.id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=repr)
        for a, b in zip(have, want):
            assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-9 * abs(b[4]) + 1e-9
        assert all(r.score < 0 for r in got)
        assert {r.held_out for r in got if r.id is None} == {False}
    same = [r.score for r in got if r.id == 5]
    assert len(same) == 2 and abs(same[0] - same[1]) < 1e-6


def test_model_beats_the_base_on_language_with_structure(spark):
    random.seed(8)
    next_of = {f"w{i}": [f"w{(3 * i + k) % 50}" for k in range(3)] for i in range(50)}
    rows = []
    for i in range(600):
        w = random.choice(list(next_of))
        out = []
        for _ in range(60):
            out.append(w)
            w = random.choice(next_of[w])
        rows.append((i, " ".join(out)))
    got = L.score(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out") \
        .agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > 0.6 * got.b  # 3 of 50 words can follow


def test_tables_and_dictionary_grow_with_the_corpus(spark, monkeypatch):
    for n in (10**8, 10**10, 10**13):
        assert L.table_bits(4 * n) == L.table_bits(n) + 1
        assert abs(L.dictionary_words(4 * n) / L.dictionary_words(n) - 2) < 1e-4
    _, df = corpus(spark)  # about 24,000 tokens
    monkeypatch.setattr(L, "BASE_TOKENS", 400)
    monkeypatch.setattr(L, "BASE_WORDS", 50)
    sent, _, n, v = L.train(df.select("text"))
    m = pickle.loads(sent.value)
    assert m.word_mixer.size == 1 << L.table_bits(n) == 8 << L.TABLE_BITS
    assert m.byte_mixer.size == 1 << L.table_bits(8 * v) > 1 << L.TABLE_BITS
    assert len(m.counts) == L.dictionary_words(n) > 90
    assert all((m.word_mixer.packed[k] != 0).sum() > 1000 for k in range(2))


def test_counts_of_small_and_large_tables_agree():
    random.seed(6)
    texts = [" ".join(random.choices(["aa", "ab", "b", "cc", "ä"], k=8)) for _ in range(50)]
    m = model(texts)
    ids, first, _, _, _ = m.token_ids(texts)
    ctx, pred = L.word_contexts(ids, first, m.end, m.word_code.classes)
    for bits in (4, 20):  # fewer slots than bits, and more
        mixer = L.Mixer(L.WORD_CONTEXTS, bits)
        mixer.run(m.word_code, ids, ctx, pred, True)
        for k in range(L.WORD_CONTEXTS):
            assert mixer.n[k].sum() == m.word_code.lens[ids].sum()
            assert (mixer.packed[k] == np.where(mixer.n[k] > 0, L.pack(mixer.n[k], mixer.n1[k]), 0)).all()


def test_word_after_the_same_two_words_in_a_large_dictionary():
    rng, end, n = np.random.default_rng(9), 1 << 22, 1 << 20  # (text, word, word) has no room in 64 bits
    ids = rng.integers(end - 30, end, n).astype(np.int32)
    first = rng.random(n) < 0.01
    first[0] = True
    _, pred = L.word_contexts(ids, first, end, np.arange(end + 257))
    want, seen, a, b = [], {}, end, end
    for x, f in zip(ids[:20_000].tolist(), first.tolist()):
        if f:
            seen, a, b = {}, end, end
        want.append(seen.get((a, b), -1))
        seen[a, b] = x
        a, b = b, x
    assert pred[:20_000].tolist() == want


def test_empty(spark):
    _, df = corpus(spark)
    assert L.score(empty(df)).count() == 0
    only_held = df.where("doc_id = 1002" if zlib.crc32(b"1002") % 5 == 1 else "doc_id = 0").limit(0)
    assert L.score(only_held).count() == 0


def test_no_training_rows(spark):
    held = next(i for i in itertools.count() if zlib.crc32(str(i).encode()) % 5 == 1)
    r = L.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0)
    assert abs(r.base_score - 3 * math.log10(0.5 / 0.5)) < 1e-9 and r.score < 0


def test_query(spark):
    got = {r.doc_id: r for r in L.op1(spark, SF001).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert len(got) == len(rows)
    for (i, t), w in zip(rows, brute_base(rows)):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3] and abs(r.base_score - w[3]) < 1e-9 * abs(w[3])


def test_learning_is_the_same_without_scores():
    random.seed(12)
    texts = [" ".join(random.choices(["aa", "ab", "b", "cc", "ä"], k=40)) for _ in range(60)]
    m = model(texts)
    ids, first, _, _, _ = m.token_ids(texts)
    ctx, pred = L.word_contexts(ids, first, m.end, m.word_code.classes)
    one, two = L.Mixer(L.WORD_CONTEXTS, 12), L.Mixer(L.WORD_CONTEXTS, 12)
    for _ in range(3):
        assert one.run(m.word_code, ids, ctx, pred, True) is not None
        assert two.run(m.word_code, ids, ctx, pred, True, scores=False) is None
    assert list(one.parts("w")) == list(two.parts("w"))


def test_words_tied_with_the_last_dictionary_word_count_as_escapes(spark):
    docs = spark.createDataFrame([("b b b a a c c d d e",)], "text string")
    sent, _, n, _ = L.train(docs, max_words=2)  # b, and a of the four met twice
    m = pickle.loads(sent.value)
    assert m.blob.split(b"\n") == [b"b", b"a"] and n == 11
    code = L.Codebook(np.concatenate([m.counts, [1], np.bincount([*b"ccdde"], minlength=256)]), np.arange(259))
    assert sorted(m.word_code.lens.tolist()) == sorted(code.lens.tolist())


def test_words_are_cut_as_python_cuts_them():
    texts = [None, "", " \n\t ", "a", " A  b ", "\x0bA\x0cB\x1c d\x85e\xa0 　x İ ẞ", "a\x00b"]
    texts += [f"x{chr(i)}Y{chr(i)}" for i in range(0x2100)]
    flat, lens = L.arrow_tokens(texts)
    want = [tokens(t) for t in texts]
    assert lens.tolist() == [len(x) for x in want] and flat.to_pylist() == [w for x in want for w in x]


def test_a_word_is_looked_up_and_a_byte_with_those_before_it_scored_once(monkeypatch):
    class Counted(dict):
        asked = 0

        def get(self, *a):
            self.asked += 1
            return super().get(*a)

    m = model(["aa ab b", "cc b"])
    m.__dict__["ids"] = Counted(m.ids)
    ids = m.token_ids(["aa b aa zz"] * 50)[0]
    assert len(ids) == 250 and m.ids.asked == 4  # aa, b, zz, the end
    rare = [w.encode() for w in ("zzzzzzzz", "zzzzzzzzzz", "zzzzy")]
    want = []
    for w in rare:
        b, first, _ = L.byte_ids([w])
        want.append(m.byte_mixer.run(m.byte_code, b, L.spell_contexts(b, first), None, False)[1:].sum())
    sizes, run = [], L.Mixer.run
    monkeypatch.setattr(L.Mixer, "run", lambda self, cb, ids, *a, **k: sizes.append(len(ids)) or run(self, cb, ids, *a, **k))
    assert np.allclose(m.spell(rare), want, atol=1e-5)
    assert sum(sizes) == 8  # z after 0 to 4 z, y and the terminator after zzzz, the terminator after zzzy


def test_blocks_cut_together_are_the_blocks_cut_alone():
    texts = pa.array([None, "", "aa zz b", "b zz"] * 40, pa.string())
    m = model(["aa ab b", "cc b"])
    got = list(m.token_blocks(texts, 30))
    assert [x for b, *_ in got for x in b.to_pylist()] == texts.to_pylist() and len(got) > 5
    for b, *rest in got:
        for x, y in zip(rest, m.token_ids(b)):
            assert list(x) == list(y)
