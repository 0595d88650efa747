"""Joins by position, multiset semi-joins and collapsing where one key holds most rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import consistency, findings, scan, vote


@pytest.fixture(params=[1_000_000, 25])
def most(request, monkeypatch):
    """Rows of a key that are read at once: all, or few."""
    monkeypatch.setattr(scan, "RANGE_ROWS", request.param)
    return request.param


def keyed(rng, n):
    return [("hot" if rng.random() < 0.8 else rng.choice(["a", "b"]), i) for i in range(n)]


def test_positions(spark, most):
    rng = random.Random(1)
    a, b = keyed(rng, 200), keyed(rng, 150)
    got = consistency.zip_streams(spark.createDataFrame(a, "k string, x int"), spark.createDataFrame(b, "k string, y int"), ["k"], ["x"], ["y"]).collect()
    want = []
    for k in ("hot", "a", "b"):
        xs, ys = ([i for key, i in rows if key == k] for rows in (a, b))
        want += [(k, p + 1, xs[p] if p < len(xs) else None, ys[p] if p < len(ys) else None) for p in range(max(len(xs), len(ys)))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_claims(spark, most):
    rng = random.Random(2)
    claims, marks = keyed(rng, 200), keyed(rng, 90)
    got = vote.prune(spark.createDataFrame(claims, "k string, x int"), spark.createDataFrame(marks, "k string, m int"), ["k"], ["x"]).select("k", "x").collect()
    left, want = Counter(k for k, _ in marks), []
    for k, x in claims:
        if left[k] > 0:
            left[k] -= 1
            want.append((k, x))
    assert sorted(tuple(r) for r in got) == sorted(want)


def folded(rows):
    """The definition: clusters in order of emission."""
    owner, found = {}, defaultdict(list)
    for k, seq, cells in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        cluster = next((owner[k, c] for c in cells or () if (k, c) in owner), seq)
        owner.update({(k, c): cluster for c in cells or ()})
        found[k, cluster].append(seq)
    return sorted(((k, s) for (k, _), s in found.items()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_clusters(spark, most, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        k = "hot" if rng.random() < 0.7 else rng.choice(["a", None])
        cells = [(rng.randrange(150), rng.randrange(2)) for _ in range(rng.choice([0, 1, 1, 2, 3]))]
        rows.append((k, i, None if rng.random() < 0.05 else cells))
    df = spark.createDataFrame(rows, "k string, seq bigint, cells array<struct<r: int, c: int>>").repartition(5)
    got = findings.collapse(df, ["k"], "seq", "cells", seqs=F.array_sort(F.collect_list("seq"))).collect()
    assert sorted(((r.k, r.seqs) for r in got), key=str) == folded(rows)


def test_an_order_that_a_component_does_not_see(spark, most):
    """1 and 2 own two cells; 3 has both, joins 1 and takes 2's cell along, so 4 joins 1 as well: 2 stays alone though all are linked."""
    rows = [("k", 1, [1]), ("k", 2, [2]), ("k", 3, [1, 2]), ("k", 4, [2])] + [("k", 10 + i, [100 + i, 101 + i]) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, seq bigint, cells array<int>")
    got = findings.collapse(df, ["k"], "seq", "cells", seqs=F.array_sort(F.collect_list("seq"))).collect()
    assert sorted(((r.k, r.seqs) for r in got), key=str) == folded(rows)
    assert [1, 3, 4] in [r.seqs for r in got]
