"""Models: exact parts against brute force, held-out accuracy for the rest."""

from __future__ import annotations

import collections
import itertools
import math
import os
import random
import zlib

import numpy as np
import pytest

from tidegauge.llm import hmm, quality, toxicity


def corpus(spark, n=240):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = [f"{'en' if i % 2 else 'de'}{rng.randrange(60)}" for _ in range(rng.randrange(20, 80))]
        toxic = i % 4 == 0
        if toxic:
            for w in rng.sample(["awful", "nasty", "vile"], 2):
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words), "x", "y"))
        labels.append((i, int(toxic), int(i % 3 == 0)))
    rows += [(1000, None, "x", "y"), (1001, "", "x", "y"), (1002, "AWFUL n4sty", "x", "y"), (1003, "vile " * 5000, "x", "y"), (None, "en1 en2", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, fold string")
    return docs, spark.createDataFrame([*labels, (1001, None, None)], "doc_id long, toxic int, quality int")


def test_lm_counts_are_exact_and_the_model_beats_the_base(spark):
    docs, _ = corpus(spark)
    got = {r.doc_id: r for r in hmm.lm_score(docs, states=4, rounds=2).collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b" "] for r in docs.collect()}
    fold = lambda i: -1 if i is None else zlib.crc32(str(i).encode()) % 7
    c = collections.Counter()
    for i, w in texts.items():
        if fold(i) != 2:
            c.update(w)
    n, v = sum(c.values()), len(c)
    for i, w in texts.items():
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        g = got[i]
        assert (g.n_tokens, g.n_known, g.train_tokens, g.held_out) == (len(w), sum(c[x] > 0 for x in w), n, fold(i) == 2)
        assert abs(g.base_score - base) < 1e-6 * abs(base)
    held = [g for g in got.values() if g.held_out]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)


def test_lm_without_rows_or_training(spark):
    docs, _ = corpus(spark)
    assert hmm.lm_score(docs.where("false")).count() == 0
    only = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 7 = 2")
    got = hmm.lm_score(only).collect()
    assert got and all(g.n_known == 0 and g.train_tokens == 0 and g.base_score == 0 for g in got)


def test_forward_sums_over_all_paths():
    rng = np.random.RandomState(0)
    model = {"start": np.array([0.3, 0.7]), "a": np.array([[0.9, 0.1], [0.4, 0.6]]), "ratio": rng.uniform(0.1, 3, (hmm.BUCKETS + 1, 2))}
    seqs = [np.array([1, 2, 3, 4], np.uint16), np.array([9], np.uint16), np.array([5, 5, 6], np.uint16)]
    counts = hmm._zero(2)
    got = hmm._e_step(seqs, model, counts)
    emit, moves = np.zeros_like(counts["emit"]), np.zeros((2, 2))
    for s, g in zip(seqs, got):
        paths = {}
        for p in itertools.product(range(2), repeat=len(s)):
            w = model["start"][p[0]] * model["ratio"][s[0], p[0]]
            for t in range(1, len(s)):
                w *= model["a"][p[t - 1], p[t]] * model["ratio"][s[t], p[t]]
            paths[p] = w
        total = sum(paths.values())
        assert abs(math.log(total) - g) < 1e-6
        for p, w in paths.items():
            for t in range(len(s)):
                emit[s[t], p[t]] += w / total
                if t:
                    moves[p[t - 1], p[t]] += w / total
    assert np.allclose(emit, counts["emit"], atol=1e-5) and np.allclose(moves, counts["a"], atol=1e-5)


def test_model_is_a_distribution():
    rng = np.random.RandomState(1)
    base = rng.dirichlet(np.ones(hmm.BUCKETS + 1))
    m = hmm._model(rng.uniform(0, 9, 3), rng.uniform(0, 9, (3, 3)), rng.uniform(0, 9, (hmm.BUCKETS + 1, 3)), base)
    assert np.allclose((m["ratio"] * base[:, None]).sum(axis=0), 1) and np.allclose(m["a"].sum(axis=1), 1)


def test_fold():
    assert toxicity.fold("ІDI0T, n4sty! e​vil") == " idiot nasty evil "


def test_toxicity_finds_disguised_words_and_respects_exceptions(spark):
    docs, labels = corpus(spark)
    lex = toxicity.fit(docs, labels, exceptions=["not awful"])
    rows = {r.doc_id: r for r in toxicity.score(docs, lex).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    held = [i for i in truth if rows[i].held_out]
    assert held and all(rows[i].predicted == truth[i] for i in held)
    assert rows[1002].predicted == 1 and rows[1003].predicted == 1 and rows[1000].score == rows[1001].score < 0.5
    a = lex.automaton()
    assert lex.density(a, "this is not awful at all") == 0 < lex.density(a, "this is awful")
    assert not rows[None].held_out


def test_toxicity_without_labels_or_rows(spark):
    docs, labels = corpus(spark)
    lex = toxicity.fit(docs, labels.where("false"))
    assert {r.score for r in toxicity.score(docs, lex).collect()} == {0.0}
    assert toxicity.score(docs.where("false"), lex).count() == 0


def graded(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        g = i % 3
        rows.append((i, " ".join(rng.choice(["good", "fine", "clear"] if rng.random() < g / 2 else ["BAD!!", "junk%%%", "x|y"]) for _ in range(40))))
        labels.append((i, g))
    return spark.createDataFrame([*rows, (900, None), (901, ""), (None, "good")], "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality_grades_in_order(spark):
    docs, labels = graded(spark)
    model = quality.fit(docs, labels)
    assert model.grades == [0, 1, 2] and model.thresholds[0] < model.thresholds[1]
    rows = {r.doc_id: r for r in quality.grade(docs, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i in truth if rows[i].held_out]
    assert sum(abs(rows[i].expected_grade - truth[i]) < 0.7 for i in held) > 0.85 * len(held)
    assert all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows.values())
    assert rows[900].expected_grade == rows[901].expected_grade
    low = {r.doc_id: r.tail_probability for r in quality.grade(docs, model, select_grade=1).collect()}
    assert all(low[i] >= rows[i].tail_probability for i in low)


def test_quality_without_labels_or_rows(spark):
    docs, labels = graded(spark)
    model = quality.fit(docs, labels.where("quality = 1"))
    assert all(r.kept and r.expected_grade is None for r in quality.grade(docs, model).collect())
    assert quality.grade(docs.where("false"), quality.fit(docs, labels)).count() == 0


def plain_density(lex, text):
    """The lexicon's density without an automaton: every entry is looked for at every place."""
    f = toxicity.fold(text)
    excused = [(i, i + len(p) - 1) for p in map(toxicity.fold, lex.exceptions) for i in range(len(f)) if f.startswith(p, i)]
    best = {}
    for e, w in lex.weights.items():
        for i in range(len(f)):
            if f.startswith(e, i):
                best[i] = max(best.get(i, 0), w)
    return sum(w for i, w in best.items() if not any(a <= i <= b for a, b in excused)) / math.log2(2 + f.count(" "))


def test_density_against_plain_matching():
    rng = random.Random(12)
    lex = toxicity.Lexicon(weights={" vile ": 2.0, " vil": 1.5, " idio": 3.0, " of the ": 0.5, " nasty ": 1.0}, exceptions=["not vile", "vile of", "of the idiot"])
    words = ["vile", "vilest", "v1le", "not", "of", "the", "idiot", "1d10t", "nasty", "n4sty!", "x", "Ѕoft", "идиот"]
    a = lex.automaton()
    for _ in range(300):
        text = " ".join(rng.choices(words, k=rng.randrange(0, 25)))
        assert abs(lex.density(a, text) - plain_density(lex, text)) < 1e-9
    assert lex.density(a, "not vile " * 100_000) == 0  # a long text of excused hits takes no time squared


def test_labelled_sample_is_bounded_and_one_row_an_id(spark):
    from tidegauge.llm.labelled import labelled_sample

    docs = spark.createDataFrame([(i, f"t{i}", "x") for i in range(500)] + [(7, "a", "x")] * 3 + [(None, "n", "x")], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)] + [(7, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "toxic", 10_000, 5, 0).collect()
    ids = [i for i in range(500) if zlib.crc32(str(i).encode()) % 5]
    assert len(rows) == len(ids) and sum(r.text == "a" for r in rows) == (7 in ids)
    few = labelled_sample(docs, labels, "toxic", 50, 5, 0).collect()
    assert 20 < len(few) <= 50 and {r.text for r in few} <= {r.text for r in rows}


def test_ordinal_gradient_and_likelihood():
    rng = np.random.RandomState(5)
    n, k, size = 12, 3, 20
    at, doc, value = rng.randint(0, size, 60), rng.randint(0, n, 60), rng.uniform(0, 1, 60)
    y, w, theta = rng.randint(0, k + 1, n), rng.normal(0, 1, size), np.array([-0.7, 0.1, -0.4])
    gw, gt, loss = quality.gradient(w, theta, at, value, doc, y)
    th = quality.upper(theta)
    x = [sum(w[a] * v for a, d, v in zip(at, doc, value) if d == i) for i in range(n)]
    above = lambda xi, j: 1.0 if j < 0 else 0.0 if j >= k else 1 / (1 + math.exp(th[j] - xi))
    want = -sum(math.log(above(x[i], y[i] - 1) - above(x[i], y[i])) for i in range(n)) / n + quality.RIDGE / 2 * float(w @ w)
    assert abs(loss - want) < 1e-9
    for params, grad in ((w, gw), (theta, gt)):
        for i in range(len(params)):
            step = np.zeros(len(params))
            step[i] = 1e-5
            a, b = ((quality.gradient(*((params + s, theta) if params is w else (w, params + s)), at, value, doc, y)[2]) for s in (step, -step))
            assert abs((a - b) / 2e-5 - grad[i]) < 1e-6


def test_quality_reads_whole_words_and_ignores_other_columns(spark):
    long = "a" * 100
    assert quality.shape(long + "!") == "x!" and quality.features(long + "bcd") == quality.features(long + "bcd") != quality.features(long + "bce")
    docs, labels = graded(spark)
    model = quality.fit(docs, labels)
    clash = docs.select("doc_id", "text", *[docs.doc_id.alias(c) for c in ("id", "fold", "label", "expected_grade")])
    assert sorted(map(str, quality.grade(clash, model).collect())) == sorted(map(str, quality.grade(docs, model).collect()))
    with pytest.raises(ValueError):
        quality.fit(docs, labels, max_grades=2)


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_held_out_labels_of_the_tables(spark):
    """Recall and false alarms of toxicity, and the ranking of quality, on rows that were not learnt from."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic) and sum(r.predicted for r in clean) <= 0.02 * len(clean)
    rows = quality.grade(docs, quality.fit(docs, labels)).join(labels, "doc_id").where("held_out and quality is not null").collect()
    good, bad = [r.tail_probability for r in rows if r.quality], [r.tail_probability for r in rows if not r.quality]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.85


def test_quality_and_toxicity_of_very_long_texts(spark):
    docs, labels = graded(spark)
    model = quality.fit(docs, labels)
    long = spark.createDataFrame([(1, "good fine clear " * 200_000), (2, "BAD!! junk%%% " * 200_000), (None, "x" * 2_000_000)], "doc_id long, text string")
    rows = {r.doc_id: r for r in quality.grade(long, model).collect()}
    assert rows[1].expected_grade > 1.5 > 0.5 > rows[2].expected_grade and rows[None].expected_grade is not None
    lex = toxicity.Lexicon(weights={" vile ": 4.0}, exceptions=["not vile"], slope=1.0, offset=-1.0, empty=False)
    score = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame([(1, "vile " * 300_000), (2, "not vile " * 300_000), (None, None)], "doc_id long, text string"), lex).collect()}
    assert score[1] > 0.99 and score[2] == score[None] < 0.5
