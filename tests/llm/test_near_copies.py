"""The SimHash stage against brute-force Jaccard, alone and after the pipeline's stages before it."""

from __future__ import annotations

import collections
import os
import random

import brute
import numpy as np
import pytest

import corpus_pipeline
from tidegauge.llm import buckets, simhash_similar
from tidegauge.llm.common import materialise, table
from tidegauge.llm.simhash import covering_masks


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def survivors(rows):
    """rows: (id, text), ids unique. Indices that stay when pairs of similarity 0.8 are linked."""
    sets = [shingles(t) for _, t in rows]
    holds = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holds[x].append(i)
    near = {(a, b) for own in holds.values() for k, a in enumerate(own) for b in own[k + 1 :]}
    links = [(a, b) for a, b in near if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    groups = collections.defaultdict(list)
    for i, r in brute.smallest_reachable(range(len(rows)), links).items():
        groups[r].append(i)
    return {min(g, key=lambda i: (rows[i][0] is None, rows[i][0] or 0)) for g in groups.values()}, len(links)


def made(seed=3):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(90)) for _ in range(rng.choice([3, 30, 150, 400])))) for i in range(30)]
    for k in range(90):
        t = rows[rng.randrange(30)][1].split()
        for _ in range(rng.randrange(1, 2 + len(t) // 30)):
            t[rng.randrange(len(t))] = "changed"
        rows.append((1000 - k, " ".join(t)))
    return [*rows, (2000, None), (2001, " "), (2002, rows[5][1].upper())]


@pytest.mark.parametrize("block", [512, 4])
def test_groups_against_brute_force(spark, monkeypatch, block):
    real = buckets.bucket_links
    monkeypatch.setattr(simhash_similar, "bucket_links", lambda *a, **k: real(*a, block=block, **k))
    rows = made()
    want, links = survivors(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r.doc_id for r in got) == sorted(rows[i][0] for i in want) and links > 30


def test_repeated_and_null_ids(spark):
    rng = random.Random(5)
    text = [f"w{rng.randrange(900)}" for _ in range(200)]
    near, other = " ".join([*text[:-1], "end"]), " ".join(f"v{rng.randrange(900)}" for _ in range(200))
    rows = [(7, " ".join(text)), (9, near), (9, other), (None, " ".join([*text[:-1], "null"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, corpus_pipeline.drop_near_copies(spark, docs, "").collect())) == [(7, rows[0][1]), (9, other)]
    assert simhash_similar.similar_groups(docs.where("false")).count() == 0


def test_a_chain_of_bucket_mates_is_no_group(spark, monkeypatch):
    """Rows that share keys with the next one but are less alike than 0.8: no component is taken of them, and only the two true copies link."""
    rng = random.Random(8)
    words = [f"w{rng.randrange(5000)}" for _ in range(1200)]
    rows = [(i, " ".join(words[25 * i : 25 * i + 200])) for i in range(40)] + [(100, " ".join([*words[:199], "end"]))]
    seen, real = [], simhash_similar.components
    monkeypatch.setattr(simhash_similar, "components", lambda edges: seen.append(edges.count()) or real(edges))
    held = []
    linked = simhash_similar.bucket_links
    monkeypatch.setattr(simhash_similar, "bucket_links", lambda keyed, keys, *a, **k: held.append((keys, keyed.groupBy(*keys).count().agg({"count": "max"}).first()[0], keyed.select("id").distinct().count())) or linked(keyed, keys, *a, **k))
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(r.doc_id for r in got) == list(range(40)) and survivors(rows)[1] == 1
    assert seen == [2]  # the row that points to its copy and the copy itself
    ((keys, largest, members),) = held
    assert keys == ["key"] and members > 20 and largest < members / 2


def test_bands_miss_rarely():
    assert (1 - 0.8**simhash_similar.ROWS) ** simhash_similar.bands_for(0.8) <= simhash_similar.MISS


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_pipeline_leaves_no_near_copies(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    for name, stage in corpus_pipeline.STAGES:
        if name == "suffix_dedup":
            break
        docs = materialise(stage(spark, docs, sf), name)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert survivors(rows)[1] == 0


def test_masks_propose_every_pair_within_the_radius():
    """Without the bands, pairs whose prints differ in at most three bits still share a key."""
    rng = np.random.RandomState(6)
    masks = np.array(covering_masks(3), np.uint64)
    for _ in range(50):
        own = rng.randint(0, 1 << 62, 300).astype(np.uint64) * np.uint64(3)
        other = np.concatenate([own[1:], rng.randint(0, 1 << 62, 1).astype(np.uint64)])
        prints = [np.packbits(np.unpackbits(np.sort(x).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0) * 2 > len(x), bitorder="little").view(np.uint64)[0] for x in (own, other)]
        shared = (simhash_similar.covering_keys(own, masks) == simhash_similar.covering_keys(other, masks)).any()
        assert shared or np.bitwise_count(prints[0] ^ prints[1]) > 3


def test_columns_with_the_names_of_helpers_and_empty_tables(spark):
    text = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(text), 0, "a", "b"), (2, " ".join([*text[:-1], "end"]), 0, "c", "d"), (3, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, key string, hit string")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [1, 3]
    assert sorted(r.doc_id for r in corpus_pipeline.drop_exact_copies(spark, docs.union(docs), "").collect()) == [1, 1, 2, 2, 3, 3]
    assert sorted((r.doc_id, r.hit) for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()) == [(1, "b"), (2, "d"), (3, None)]
    for stage in (corpus_pipeline.drop_near_copies, corpus_pipeline.drop_exact_copies, corpus_pipeline.cut_repeats, corpus_pipeline.pack_sequences):
        assert stage(spark, docs.where("false"), "").count() == 0
