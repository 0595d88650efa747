"""Exact and suffix deduplication, tokenising, packing, URL rules: brute force and round trips."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidegauge.llm import bpe, exact_dedup, packing, suffix_dedup
from tidegauge.llm.url_filter import url_filter
from tidegauge.llm.wordids import WordEncoder

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = [
    "", " ", "a  b\n\n c", "x\xa0 y   z", "don't I'll 'S 12 34abc!!??", "<|endoftext|> hi <|endoftext|>", "\n a", "é 日本語 😀", "a\x1cb \x1c c\x85 d", "tab\t\tx \r\n y",
    "नमस्ते दुनिया ١٢٣ ⅷ²", "the, end. The,, x.,", "É, é.", "İstanbul ΣΑΣ Σ", "e\u0301 cafe\u0301.", "a" * 3000, "!?" * 500, "ab " * 2000, "Word,word.Word", ", .", "  the,  of.",
]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "s", "k") for i, t in rows], "doc_id long, text string, n int, sha string, row string")


def test_fingerprints_compose():
    rng = random.Random(1)
    for n in (0, 1, 8191, 8192, 8193, 20000, 300_000):
        a, b = rng.randbytes(n), rng.randbytes(777)
        whole = exact_dedup.fingerprint(a + b)
        left, right = exact_dedup.fingerprint(a), exact_dedup.fingerprint(b)
        part = lambda f: (f >> 26, f & ((1 << 26) - 1))
        assert part(whole) == exact_dedup.combine(part(left), part(right), len(b))


def test_long_texts_are_hashed_in_parts(spark, monkeypatch):
    """Parts of a text, hashed by rows of their own, combine to the fingerprint of the whole; pieces are compared one by one."""
    monkeypatch.setattr(exact_dedup, "PART", 50)
    monkeypatch.setattr(exact_dedup, "PIECE", 7)
    rng = random.Random(11)
    long = ["".join(rng.choice("aбc𝄞\n ") for _ in range(n)) for n in (49, 50, 51, 333, 100)]
    rows = [(i, t) for i, t in enumerate([*long, *long[2:], "", "x", None])]
    src = docs(spark, rows).selectExpr("doc_id as id", "coalesce(text, '') as text").withColumn("sha", exact_dedup.F.sha2("text", 256))
    got = {r.id: (r.n, r.fp) for r in exact_dedup.fingerprints(src).collect()}
    assert got == {i: (len((t or "").encode()), exact_dedup.fingerprint((t or "").encode())) for i, t in rows}
    kept = {r.doc_id: r.keep_id for r in exact_dedup.exact_dedup(docs(spark, rows)).collect()}
    assert kept == {i: max(j for j, u in rows if (u or "") == (t or "")) for i, t in rows}


@pytest.mark.parametrize("collide", [False, True])
def test_exact_dedup(spark, monkeypatch, collide):
    if collide:  # every fingerprint equal: the comparison of texts decides
        def same(parts):
            for pdf in parts:
                yield pdf.drop(columns="text").assign(n=pdf["text"].map(lambda x: len(x.encode())), h0=0, h1=0, s0=1, s1=1)

        monkeypatch.setattr(exact_dedup, "_hash_parts", same)
    rows = [(1, "aa"), (2, "ab"), (3, "aa"), (4, None), (5, ""), (6, "ba"), (7, "ab"), (8, "x" * 50_000), (9, "x" * 50_000), (10, "y"), (None, "z"), (None, "z"), (11, "é")]
    got = sorted(((str(r.doc_id), r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_dedup(docs(spark, rows)).collect()), key=str)
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = []
    for i, t in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        want.append((str(i), keep, len(g), keep is None or i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0


def passage(rng, n):
    return "".join(rng.choice("abcdefgh  é") for _ in range(n))


@pytest.mark.parametrize("group", [2048, 1])
def test_suffix_dedup_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rng = random.Random(5)
    shared = [passage(rng, n) for n in (150, 199, 200, 210, 260, 400, 900)]
    rows = []
    for i in range(40):
        parts = [passage(rng, rng.randrange(0, 300))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(max(1, len(s) - 190))
            parts += [s[a : a + rng.randrange(180, 500)], passage(rng, rng.randrange(0, 200))]
        rows.append((i, "".join(parts)))
    rows += [(100, rows[0][1]), (101, None), (102, ""), (103, "z" * 500), (104, "line of text, again. " * 40), (105, "line of text, again. " * 15), (106, "short"), (107, "short")]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(docs(spark, rows)).collect()}
    raw = [(i, (t or "").encode()) for i, t in rows]
    spans = brute.repeated_spans(raw)
    for i, t in raw:
        kept, at = b"", 0
        for a, b in spans[i]:
            kept, at = kept + t[at:a], b
        kept += t[at:]
        assert got[i] == (len(t), len(t) - len(kept), len(spans[i]), hashlib.sha256(kept).hexdigest()), i
    assert sum(0 < g[1] < g[0] for g in got.values()) > 5


def test_suffix_dedup_without_rows(spark):
    assert suffix_dedup.suffix_dedup(docs(spark, [])).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(6)
    for k in (0, 1, 2, 5, 8):
        runs = [sorted((bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 12))), b"v%d" % i) for i in range(rng.randrange(30))) for _ in range(k)]
        out = list(suffix_dedup.merge_runs([suffix_dedup.front_code(r) for r in runs]))
        keys = [o[0] for o in out]
        assert sorted((o[0], o[1]) for o in out) == sorted(x for r in runs for x in r) and keys == sorted(keys)
        assert all(o[2] == suffix_dedup.common(a, o[0]) for a, o in zip(keys, out[1:]))


def test_anchors_do_not_depend_on_the_place():
    rng = random.Random(7)
    same = rng.randbytes(200)
    for pad in (0, 3, 500):
        pos, _, _ = suffix_dedup.anchors(rng.randbytes(pad) + same + rng.randbytes(50))
        inside = {int(p) - pad for p in pos if pad <= p <= pad + 200 - suffix_dedup.GRAM}
        assert inside
        first = inside if pad == 0 else first & inside
    assert first
    long = rng.randbytes(3 * suffix_dedup.PIECE // 2)
    cut = suffix_dedup.PIECE
    suffix_dedup.PIECE = 1 << 12
    try:
        a = suffix_dedup.anchors(long[:50_000])
    finally:
        suffix_dedup.PIECE = cut
    b = suffix_dedup.anchors(long[:50_000])
    assert all((x == y).all() for x, y in zip(a[:2], b[:2]))


def test_word_ids_equal_the_library():
    tk = Tokenizer.from_file(WORD)
    e = WordEncoder.load(WORD)
    for t in ODD:
        assert np.frombuffer(e.ids(t), "<u4").tolist() == tk.encode(t, add_special_tokens=False).ids, t


def test_bpe_equals_the_library(spark):
    tk = Tokenizer.from_file(BYTE)
    rows = list(enumerate(ODD)) + [(500, None)]
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_round_trip(docs(spark, rows), BYTE, lexicon_words=30).collect()}
    for i, t in rows:
        ids = tk.encode(t or "", add_special_tokens=False).ids
        text = tk.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()), t
    assert bpe.bpe_round_trip(docs(spark, []), BYTE).count() == 0


def test_long_words_merge_like_short_ones():
    v = bpe.Vocabulary(BYTE)
    rng = random.Random(8)
    for _ in range(50):
        w = "".join(rng.choice("theandionrs") for _ in range(rng.randrange(2, 60))).encode()
        assert v._merge_long([v.letter[b] for b in w]) == v.merge(w)


def test_automaton_shares_suffixes(tmp_path):
    words = [a + b for a in ("walk", "talk", "balk") for b in ("", "s", "ed", "ing")]
    path = tmp_path / "a.bin"
    path.write_bytes(bpe.build_automaton([(w.encode(), [i, 7 * i]) for i, w in enumerate(words)]))
    a = bpe.Automaton(str(path))
    assert all(np.frombuffer(a.get(w.encode()), "<u4").tolist() == [i, 7 * i] for i, w in enumerate(words))
    assert a.get(b"wal") is None and a.get(b"walke") is None and a.get(b"") is None
    assert len(a.first) - 1 == 9  # w/t/b, a, l, k, and the shared endings
    empty = tmp_path / "e.bin"
    empty.write_bytes(bpe.build_automaton([]))
    assert bpe.Automaton(str(empty)).get(b"x") is None


def test_packing_keeps_every_id_once(spark):
    tk = Tokenizer.from_file(WORD)
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randrange(0, 5000)))) for i in range(60)] + [(60, None), (61, ""), (62, "one"), (63, "one")]
    got = packing.pack(docs(spark, rows), WORD).collect()
    by, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for i, t in rows:
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for rs in seqs.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert packing.pack(docs(spark, []), WORD).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_cutting_stock_is_near_the_bound(seed):
    rng = np.random.RandomState(seed)
    demand = rng.randint(0, 5000, packing.CLASSES)
    plan = packing.cutting_stock(demand)
    sizes = np.arange(1, packing.CLASSES + 1)
    assert (sum(p * n for p, n in plan) == demand).all() and all((p * sizes).sum() <= packing.CLASSES for p, _ in plan)
    c = packing.CLASSES

    def least(k):  # Martello and Toth's lower bound: long items alone, middle ones one a sequence, small ones fill up
        own, middle, small = sizes > c - k, (sizes <= c - k) & (2 * sizes > c), (2 * sizes <= c) & (sizes >= k)
        room = demand[middle].sum() * c - (demand * sizes)[middle].sum()
        return demand[own].sum() + demand[middle].sum() + max(0, ((demand * sizes)[small].sum() - room) / c)

    assert sum(n for _, n in plan) <= 1.005 * max(map(least, range(c // 2 + 1))) + 2 * c


def test_url_rules(spark):
    listed = spark.createDataFrame([("com", "/en/", "block"), ("Example.com", "/en/7", "allow"), ("host.org", "", "block"), ("host.or", "g", "allow"), ("e.com", "n/", "block")], "host string, path string, verdict string")
    urls = ["http://A.EXAMPLE.com/en/7x?q", "http://a.example.com/en/1", "x://com/en/", "http://notcom/en/", "http://xhost.org/a", "http://host.org", "http://h.host.org#f", None, "no scheme", "http://", "http://e.com/En/", "a://b://c.com/en/"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, host string, row string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter(pages, listed).collect()}
    assert got[0] == ("a.example.com", "/en/7x", "example.com/en/7", "allow") == got[12]
    assert got[1] == ("a.example.com", "/en/1", "com/en/", "block")
    assert got[2] == ("com", "/en/", "com/en/", "block")
    assert [got[i][2] for i in (3, 4, 7, 8, 9, 10, 11)] == [None] * 7 and got[7][:2] == ("", "") == got[8][:2]
    assert got[5] == ("host.org", "", "host.org", "block") and got[6][2] == "host.org"
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_filter(pages, none).collect()} == {"allow"} and url_filter(pages.where("false"), listed).count() == 0


def test_large_groups_of_contexts_equal_small_ones(monkeypatch):
    """The classes of large groups find what comparing all pairs finds, at text ends too."""
    rng = random.Random(9)
    reach, gram, found = 136, 64, 0
    for _ in range(30):
        rights = [bytes(rng.choice(b"ab") for _ in range(6)) * 30 for _ in range(4)]
        lefts = [bytes(rng.choice(b"cd") for _ in range(5)) * 30 for _ in range(4)]
        own = set()
        for _ in range(60):
            r, left = bytearray(rng.choice(rights)[: rng.choice([136, 136, 90, 0])]), bytearray(rng.choice(lefts)[: rng.choice([136, 136, 40, 0])])
            for x in (r, left):
                if x and rng.random() < 0.7:
                    x[rng.randrange(len(x))] = 90
            own.add((b"g" * gram + bytes(r), bytes(left)))
        own = sorted(own)
        shared = [-gram, *(suffix_dedup.common(a[0], b[0]) - gram for a, b in zip(own, own[1:]))]
        args = [(i, left) for i, (_, left) in enumerate(own)], [len(r) for r, _ in own], shared, reach
        monkeypatch.setattr(suffix_dedup, "SMALL", 1000)
        want = suffix_dedup.group_spans(*args)
        monkeypatch.setattr(suffix_dedup, "SMALL", 0)
        assert suffix_dedup.group_spans(*args) == want
        found += sum(x[0] >= 0 for x in want)
    assert found > 100


def test_null_and_repeated_ids_and_long_texts(spark):
    """op2, op6 and op9 on rows without an id, with one id twice, and with a text of a million words."""
    rng = random.Random(13)
    long = " ".join(rng.choices(["alpha", "beta", "gamma", "delta!"], k=200_000))
    rows = [(None, "no id"), (None, None), (7, "one text"), (7, "another text"), (7, "one text"), (8, long)]
    df = docs(spark, rows)
    words = Tokenizer.from_file(WORD)
    sizes = collections.Counter()
    for r in packing.pack(df, WORD).collect():
        sizes[r.doc_id] += r.length
    want = collections.Counter()
    for i, t in rows:
        want[i] += len(words.encode(t or "", add_special_tokens=False).ids) + 1
    assert sizes == want
    tk = Tokenizer.from_file(BYTE)
    got = collections.Counter((r.doc_id, r.n_tokens) for r in bpe.bpe_round_trip(df, BYTE, lexicon_words=20).collect())
    assert got == collections.Counter((i, len(tk.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    short = [(None, "x" * 250), (None, None), (7, "y" * 250), (7, "z" * 100), (7, "y" * 250), (8, "".join(rng.choice("abcdefgh ") for _ in range(300_000)) + "x" * 220)]
    cut = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.suffix_dedup(docs(spark, short)).collect())
    assert cut == sorted([("None", 250, 250, 1), ("None", 0, 0, 0), ("7", 250, 250, 1), ("7", 100, 0, 0), ("7", 250, 250, 1), ("8", 300_220, 220, 1)])


def test_long_urls_and_null_rows(spark):
    listed = spark.createDataFrame([("com", "/en/", "block")], "host string, path string, verdict string")
    urls = ["http://" + "a." * 100_000 + "com/en/x", "http://x.com/" + "p/" * 200_000, None]
    pages = spark.createDataFrame([(None if i == 1 else i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (len(r.host), r.rule, r.verdict) for r in url_filter(pages, listed).collect()}
    assert got == {0: (200_003, "com/en/", "block"), None: (5, None, "allow"), 2: (0, None, "allow")}
