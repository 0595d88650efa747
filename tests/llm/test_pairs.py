"""Near-duplicate operators against brute force, with copies, ties, nulls and empty tables."""

from __future__ import annotations

import os
import random

import brute
import numpy as np
import pytest

from tidegauge.llm import buckets, components, simhash, vector_dedup
from tidegauge.llm.simhash import covering_masks, fingerprint, simhash_near_dedup
from tidegauge.llm.vector_dedup import vector_near_dedup


def test_covering_masks_cover_every_pair_of_bits_within_the_radius():
    masks = covering_masks(3)
    assert len(masks) == 15 and all(bin(m).count("1") == 32 for m in masks)
    rng = random.Random(1)
    for _ in range(5000):
        differ = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(differ & m == 0 for m in masks)


def test_components_of_chains_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(200, 200 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (300, 301), (301, 300)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{200 + i: 200 for i in range(30)}, 300: 300, 301: 300}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_group_pairs_makes_all_pairs_of_equal_codes():
    got = {(int(a), int(b)) for i, j in buckets.group_pairs(np.array([3, 3, 3, 5, 8, 8])) for a, b in zip(i, j)}
    assert got == {(0, 1), (0, 2), (1, 2), (4, 5)}


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, fp string, id string")


def test_simhash_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(buckets, "BLOCK", 4)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    for k in range(40):  # near copies: one word changed in four hundred
        t = rng.choice(base).split()
        t[rng.randrange(len(t))] = "changed"
        rows.append((100 + k, " ".join(t)))
    rows += [(900, None), (901, ""), (902, "  \t"), (903, "one"), (904, "ONE"), (905, "a b"), (906, base[0]), (907, base[0].upper()), (5000, base[0])]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_near_dedup(docs(spark, rows)).collect()}
    assert got == brute.simhash_components([(i, t or "") for i, t in rows])
    assert sum(c != i for i, (_, c) in got.items()) > 5


def test_simhash_edges(spark):
    assert simhash_near_dedup(docs(spark, [])).count() == 0
    got = sorted((r.doc_id is None, r.component_id) for r in simhash_near_dedup(docs(spark, [(None, "a b c d"), (3, "a b c d"), (3, "a b c d")])).collect())
    assert got == [(False, 3), (False, 3), (True, 3)]
    assert fingerprint("") == 0 and fingerprint("A b") == fingerprint("a  B")
    long = " ".join(f"w{i}" for i in range(70_000))
    assert fingerprint(long) == brute.simhash(long)


def test_simhash_block_size_does_not_matter(spark, monkeypatch):
    rows = [(i, f"{'same words here again ' * 30} tail {i % 7}") for i in range(60)]
    want = {r.doc_id: r.component_id for r in simhash_near_dedup(docs(spark, rows)).collect()}
    real = buckets.bucket_links
    monkeypatch.setattr(simhash, "bucket_links", lambda *a, **k: real(*a, block=2, **k))
    assert {r.doc_id: r.component_id for r in simhash_near_dedup(docs(spark, rows)).collect()} == want


def vectors():
    rng = np.random.RandomState(3)
    rows, i = [], 0
    for lab in (1, 2, None):
        for _ in range(12):
            c = rng.standard_normal(16)
            for noise in (0, 0, 0.02, 0.05, 0.08, 0.2):
                rows.append((i, [float(x) for x in (c + noise * rng.standard_normal(16))], lab))
                i += 1
    rows += [(i, None, 1), (i + 1, [0.0] * 16, 1), (i + 2, [float("nan")] + [1.0] * 15, 1), (i + 3, [1.0] * 15 + [None], 1), (i + 4, [1.0, 2.0], 1), (i + 5, [2.0, 4.0], 1), (i + 6, [float("inf")] * 16, 1), (i + 7, [], 1)]
    return rows


@pytest.mark.parametrize("block", [512, 2])
def test_vectors_against_brute_force(spark, monkeypatch, block):
    real = buckets.bucket_links
    monkeypatch.setattr(vector_dedup, "bucket_links", lambda *a, **k: real(*a, block=block, **k))
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    exact = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_near_dedup(df).collect()}
    want = brute.vector_links(exact)
    assert got == want and sum(n for n, _, _ in want.values()) > 50


def test_vectors_without_rows(spark):
    assert vector_near_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_vector_plan_misses_rarely():
    k, tables = vector_dedup.plan(50_000, 0.98)
    p = vector_dedup.collision(0.2) ** k
    assert (1 - p) ** tables <= vector_dedup.MISS and tables < 60


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_planted_links_among_the_tables_vectors(spark):
    """Vectors at a cosine of 0.98 and a little more of the table's own: all links are found, as all pairs by brute force have it."""
    rng = np.random.RandomState(4)
    table = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").where("label is not null and embedding is not null").limit(600).collect()]
    rows = list(table)
    for k, (i, v, lab) in enumerate(table[:150]):
        a = np.array(v, np.float64)
        a /= np.sqrt(a @ a)
        off = rng.standard_normal(len(a))
        off -= (off @ a) * a
        c = 0.98 + 0.0005 * (k % 20)
        rows.append((10_000_000 + k, [float(x) for x in c * a + np.sqrt(1 - c * c) * off / np.sqrt(off @ off)], lab))
    rows += [(10_000_000, table[0][1], table[0][2]), (None, table[1][1], table[1][2])]  # an id twice, and none
    schema = "vec_id long, embedding array<float>, label int, id long, sig int, t int"
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema)
    named = [(k, [float(np.float32(x)) for x in v], lab) for k, (_, v, lab) in enumerate(rows)]
    want = brute.vector_links(named)
    got = vector_near_dedup(df).collect()
    assert len(got) == len(rows) and sum(w[0] for w in want.values()) >= 280
    plain = {r.vec_id: r for r in got if r.vec_id not in (10_000_000, None)}
    lost = [i for k, (i, _, _) in enumerate(rows) if i in plain and plain[i].n_links != want[k][0]]
    assert not lost
    assert [r.n_links >= 1 and r.kept for r in got if r.vec_id is None] == [True] and max(r.n_links for r in got if r.vec_id == 10_000_000) >= 1
