"""Words have emission probabilities of their own, which sum to one, and scores are path sums over them."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
import xxhash

from tidegauge.llm import hmm


def test_words_of_a_shared_bucket_are_told_apart(spark):
    shared = list(itertools.islice((w for i in itertools.count() if xxhash.xxh64_intdigest((w := f"w{i}").encode(), 42) % hmm.BUCKETS == 0), 40))
    own = [f"own{i}" for i in range(40)]
    rng = random.Random(4)
    # two languages of 40 words, half of them in one bucket with the other's half; to know the language is worth log10(2) a word
    languages = [shared[k::2] + own[k::2] for k in (0, 1)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(languages[i % 2], k=60))) for i in range(200)], "doc_id long, text string")
    held = [r for r in hmm.lm_score(docs, states=2).collect() if r.held_out]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert 0.25 < gain < 0.301


def emissions(done, states):
    """word -> (training count, P(w | s)), read from the tables that training leaves."""
    words = {(r.chunk, r.slice): hmm._unpack_words(bytes(r.a)) for r in done.pieces.where("kind = 1").collect()}
    out = {}
    for r in done.profile.where("kind = 0").collect():
        u = np.frombuffer(bytes(r.u), "<f2").reshape(-1, states)
        c = hmm._unsqueeze(bytes(r.c), "<i8")
        for w, n, p in zip(words[r.chunk, r.slice], c, (c[:, None] + 1) / done.denominator * hmm._ratios(u, done.model)):
            assert w not in out or np.array_equal(out[w][1], p)
            out[w] = (int(n), p)
    return out


def corpus(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{int(rng.paretovariate(0.6))}" for _ in range(rng.randrange(1, 90)))) for i in range(150)]
    return spark.createDataFrame([*rows, (None, "a1 b1 b2"), (7, None), (7, "A1 a1\x1ca2")], "doc_id long, text string")


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_each_state_is_a_distribution_and_scores_are_path_sums(spark, monkeypatch, rounds):
    states, docs = 3, corpus(spark).repartition(3)
    monkeypatch.setattr(hmm, "CHUNK_BYTES", 4000)
    done = hmm.train(docs, 7, 2, states, rounds, "doc_id", "text")
    known = emissions(done, states)
    unknown = next(p for n, p in known.values() if not n)
    total = sum(p for n, p in known.values() if n) + unknown
    assert np.allclose(total, 1, atol=1e-9)
    assert np.allclose(done.model["a"].sum(axis=1), 1) and abs(done.model["start"].sum() - 1) < 1e-9
    monkeypatch.setattr(hmm, "train", lambda *a: done)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score) for r in hmm.lm_score(docs, states=states, rounds=rounds).collect())
    want = []
    for r in docs.collect():
        words = [*(r.text or "").encode().lower().split(), hmm.END]
        alpha, log = done.model["start"], 0.0
        for t, w in enumerate(words):
            alpha = (alpha @ done.model["a"] if t else alpha) * known[w][1]
            log += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        want.append((r.doc_id is None, r.doc_id or 0, len(words), log))
    for g, w in zip(got, sorted(want), strict=True):
        assert g[:3] == w[:3] and abs(g[3] - w[3]) < 1e-5 * abs(w[3])


def test_chunks_do_not_change_the_model(spark, monkeypatch):
    """Expected counts are added up over chunks as over one; only the 16-bit rounding differs."""
    docs = corpus(spark).where("text is not null")
    one = {(r.doc_id, r.n_tokens): r.score for r in hmm.lm_score(docs.coalesce(1), states=3).collect()}
    monkeypatch.setattr(hmm, "CHUNK_BYTES", 2000)
    many = {(r.doc_id, r.n_tokens): r.score for r in hmm.lm_score(docs.repartition(4), states=3).collect()}
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 2e-3 * abs(one[k]) for k in one)


def test_long_texts_are_learnt_block_by_block():
    rng = np.random.RandomState(3)
    model = {"start": rng.dirichlet(np.ones(3)), "a": rng.dirichlet(np.ones(3), 3), "ratio": rng.uniform(0.2, 3, (9, 3))}
    seqs = [rng.randint(0, 9, n) for n in (1, 7, 64, 130)]
    whole, parts = hmm._zero(3, 9), hmm._zero(3, 9)
    assert np.allclose(hmm._e_step(seqs, model, whole), hmm._e_step(seqs, model, parts, batch=16))
    assert all(np.allclose(whole[x], parts[x], rtol=1e-5) for x in whole)
