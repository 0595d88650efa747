"""The divergence audit against a plain version."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from tidegauge.llm import divergence
from tidegauge.llm.divergence import source_divergence

ASCII = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, min_docs, top):
    n, held = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII))
        n[lang or "", source or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = []
    for lang in held:
        kept = [t for t, c in held[lang].items() if c >= min_docs]
        own = {s: n[lang, s] for a, s in n if a == lang}

        def shares(count):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(sum(own.values(), Counter()))
        for s in own:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, r + 1) for r, (i, v) in enumerate(items[:most])]
    return sorted(out)


def some_rows(seed):
    rng = random.Random(seed)
    words = ["a", "B", "b", "Éa", "éa", "x1y", "foo-bar", "ж", "The", "the", "…", "zz\x00q", "Z"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for _ in range(300):
        source = "hot" if rng.random() < 0.4 else rng.choice(["s1", "s2", "S3", "é", None])
        rows.append((rng.choice(["en", "en", "de", "", None]), source, " ".join(rng.choices(words, k=rng.randrange(0, 25)))))
    return rows + [("en", "silent", None), ("en", "silent2", "123 ?"), ("xx", "one", "rare words"), ("xx", "two", ""), ("yy", "alone", "a " * 5000)]


def test_like_the_plain_version(spark):
    rows = some_rows(8)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    for min_docs, top in ((30, 50), (5, 3), (10_000, 5)):
        assert sorted(tuple(r) for r in source_divergence(docs, min_docs=min_docs, top=top).collect()) == plain(rows, min_docs, top)


def test_counts_are_handed_on_when_there_are_too_many(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "HELD", 4)
    batches = [pa.RecordBatch.from_arrays([pa.array(["en"] * 2), pa.array(["s", "t"]), pa.array(["a b c", "a A d"])], ["lang", "source", "text"])] * 3
    got = Counter()
    for out in divergence._count_terms(iter(batches)):
        for r in out.to_pylist():
            got[r["source"], r["term"]] += r["n"]
            got[r["source"], r["term"], "docs"] += r["n_docs"]
    assert got == {("s", "a"): 3, ("s", "b"): 3, ("s", "c"): 3, ("t", "a"): 6, ("t", "d"): 3} | {(s, t, "docs"): 3 for s, t in (("s", "a"), ("s", "b"), ("s", "c"), ("t", "a"), ("t", "d"))}


def test_counts_beyond_64_bits(spark):
    df = spark.createDataFrame([(9_000_000_000_000, 10_000_000_000_000, 7)], "n bigint, total bigint, terms bigint")
    assert df.select(divergence.share("n", "total", "terms")).first()[0] == 1 + 10**9 * 9_000_000_000_005 // (10_000_000_000_035)


def test_empty_table_and_clashing_columns(spark):
    assert source_divergence(spark.createDataFrame([], "lang string, source string, text string")).collect() == []
    rows = [("en", "s", "a b", 1, "x"), ("en", "t", "a", 2, "y")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string, term int, p string")
    assert sorted(tuple(r) for r in source_divergence(docs, min_docs=1).collect()) == plain([r[:3] for r in rows], 1, 50)
