"""The starting point of Baum-Welch is learnt from all training documents."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from tidegauge.llm import hmm


def test_the_start_is_learnt_from_every_training_document(spark):
    """Two languages that no document of a third, chosen by hash, has a word of; one round can only follow a start that knows them."""
    rng, n = random.Random(5), 3000
    chosen = {r.id for r in spark.range(n).where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 20)) < (1000 << 20) // n).collect()}
    languages = [[f"{c}{i}" for i in range(40)] for c in "ab"]
    rows = [(i, " ".join(rng.choices([f"n{k}" for k in range(40)] if i in chosen else languages[i % 2], k=20))) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = [r for r in hmm.lm_score(docs, states=3, rounds=1).collect() if r.held_out and r.doc_id not in chosen]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert len(held) > 200 and gain > 0.25


def test_a_stretch_has_one_state():
    rng = np.random.RandomState(1)
    model = {"share": rng.dirichlet(np.ones(3)), "ratio": rng.uniform(0.2, 3, (9, 3))}
    seqs = [rng.randint(0, 9, n) for n in (1, 15, 16, 17, 40)]
    want, got = hmm._zero(3, 9), hmm._zero(3, 9)
    for s in seqs:
        before = None
        for i in range(0, len(s), hmm.STRETCH):
            x = s[i : i + hmm.STRETCH]
            p = model["share"] * model["ratio"][x].prod(axis=0)
            p /= p.sum()
            np.add.at(want["emit"], x, p)
            want["a"] += (len(x) - 1) * np.diag(p)
            if before is None:
                want["start"] += p
            else:
                want["a"] += np.outer(before, p)
            before = p
    hmm._stretch_step(np.concatenate(seqs), np.array([*map(len, seqs)]), model, got, batch=32)
    assert all(np.allclose(want[x], got[x], rtol=1e-4) for x in want)
