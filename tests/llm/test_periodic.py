"""Runs of words against a plain search, the query's digests, and edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidegauge.llm.periodic import candidate_stretches, periodic_runs
from tidegauge.llm.queries import op12_periodic_runs
from tidegauge.llm.tandem import runs


def plain_runs(words, min_words=2):
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= max(q, min_words - q):
                s, size = i, j - i + q
                if not any(all(words[x] == words[x + p] for x in range(s, s + size - p)) for p in range(1, q)):
                    out.append((s, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, found):
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng):
    words = [rng.randrange(rng.randrange(1, 4) + 1) for _ in range(rng.randrange(0, 40))]
    if rng.random() < 0.5:
        piece = [rng.randrange(5) for _ in range(rng.randrange(1, 9))]
        words = words[: rng.randrange(0, 12)] + piece * rng.randrange(2, 6) + piece[: rng.randrange(0, 9)] + words[: rng.randrange(0, 9)]
    return words


def test_runs_of_numbers():
    rng = random.Random(3)
    for _ in range(1500):
        words = some_words(rng)
        if rng.random() < 0.2:  # a mark that occurs once parts two stretches
            words = words + [90] + words
        assert [tuple(r) for r in runs(np.array([*words, 100])).tolist()] == plain_runs(words), words
    for words in ([0] * 300, [0, 1] * 100 + [0], list(range(50)) * 4, [0, 0, 1] * 40 + [0, 0] * 3):
        assert [tuple(r) for r in runs(np.array([*words, 100])).tolist()] == plain_runs(words)


def test_stretches_hold_every_run():
    rng = random.Random(4)
    for _ in range(400):
        words = some_words(rng) + [7, 8, 9] * 5 + some_words(rng)
        start, end = candidate_stretches(np.array(words), np.zeros(len(words), np.int64), 12)
        for s, size, _ in plain_runs(words, 12):
            assert any(a <= s and s + size <= b for a, b in zip(start, end)), words


def test_documents(spark):
    rng = random.Random(6)
    texts = [" ".join(f"w{w}" for w in some_words(rng)) for _ in range(120)]
    texts += [None, "", " \t\n", "a " * 11, "a " * 12, "a\x0ba\x0c" * 30, "Ä ä " * 9, "a b " * 13, " x y " * 7, "x y z " * 4000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b " * 10), (5, "a b " * 10), (-(1 << 63), "q " * 20)]
    got = [(r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in periodic_runs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    want = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        found = plain_runs(words, 12) if len(words) < 1000 else [(0, 12000, 3)]
        want.append((i, len(words), found, plain_collapse(words, found)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table_and_clashing_columns(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    row = periodic_runs(spark.createDataFrame([(1, "a b " * 8, "x", 3)], "doc_id bigint, text string, runs string, id int")).first()
    assert (row.doc_id, row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (1, 16, [(0, 16, 2)], "a b")


@pytest.mark.parametrize("seed", [1, 2])
def test_query(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(["the", "of", "and", "so", "on"]) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    rows += [(1000 + i, t) for i, t in enumerate([None, "", "one", "same words " * 20, " a\tb\n" * 9])]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect())
    want = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
        found = plain_runs(words, 12)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        digest = hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in found).encode()).hexdigest()
        end = [digest, hashlib.sha256(plain_collapse(words, found).encode()).hexdigest()]
        want.append((i, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *end))
    assert got == sorted(want)
    assert sum(r[1] > 0 for r in got) > 10
