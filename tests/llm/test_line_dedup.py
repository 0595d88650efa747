"""Line dedup against a plain version, and its edge cases."""

from __future__ import annotations

import random
from collections import Counter

from tidegauge.llm.line_dedup import line_dedup

BLANK = " \t\n\x0b\x0c\r"
ASCII = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, min_docs, min_chars):
    def keys(text):
        return [line.strip(BLANK).translate(ASCII) for line in (text or "").split("\n")]

    seen = Counter(k for _, t in rows for k in set(keys(t)))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [line for line, k in zip(lines, keys(t)) if len(k) < min_chars or seen[k] < min_docs]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return sorted((tuple(r) for r in line_dedup(docs, **kw).collect()), key=str)


def test_like_the_plain_version(spark):
    rng = random.Random(5)
    pool = ["alpha", " Alpha\t", "ALPHA", "Äther", "äther", "", "  ", "\x0b", "x\r", "x", " x", "ein Satz.", "一行", "İ", "a\x00b"]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"only {i} {j}" for j in range(rng.randrange(1, 30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n"), (None, "alpha\nmine"), (103, "alpha"), (103, "alpha"), (None, None)]
    for limits in ((10, 1), (3, 2), (1, 1), (2, 6)):
        assert run(spark, rows, min_docs=limits[0], min_chars=limits[1]) == plain(rows, *limits)


def test_a_line_repeated_in_one_document_counts_once(spark):
    rows = [(1, "a\n" * 50), (2, "b\na")]
    assert run(spark, rows, min_docs=3) == [(1, 51, 0, "a\n" * 50), (2, 2, 0, "b\na")]
    assert run(spark, rows, min_docs=2) == plain(rows, 2, 1)


def test_nothing_frequent_and_empty_tables(spark):
    assert run(spark, [(1, "a\nb"), (2, None)], min_docs=2) == [(1, 2, 0, "a\nb"), (2, 1, 0, "")]
    assert run(spark, []) == []


def test_very_long_text_and_columns_named_like_helpers(spark):
    long = "\n".join(["shared"] * 20_000 + [f"line {i}" for i in range(20_000)])
    rows = [(i, long if i == 0 else "shared", "x", 1, 2, 3) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id string, lines int, of int, gone int")
    got = {r.doc_id: r for r in line_dedup(docs).collect()}
    assert (got[0].n_lines, got[0].n_dropped, got[0].kept_text) == (40_000, 20_000, "\n".join(f"line {i}" for i in range(20_000)))
    assert all((got[i].n_dropped, got[i].kept_text) == (1, "") for i in range(1, 12))
