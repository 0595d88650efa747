"""Repeated byte strings across a corpus, by sampled suffixes and a common-prefix-aware merge sort.

A string of WIDTH bytes that occurs twice holds, in both places and at the same
offset, a sampled position: one whose GRAM-byte hash is the least of some window
of WIDTH bytes around it. So only sampled positions ("anchors", about two in
WIDTH - GRAM) are exchanged, and no repeat is missed. For an anchor all
that matters is its context, REACH bytes to the left and GRAM + REACH to the right:

1. anchors whose gram hash occurs once are dropped;
2. those whose whole context occurs again are settled: all of it is repeated;
3. the distinct contexts of the other grams go through the suffix sort. Each task
   sorts its suffixes (right context, then left context read backwards), cuts the
   run by destination and front-codes it. A destination merges its runs with a
   loser tree in which strings carry the length of their common prefix with the
   last output, so known prefixes are never compared again; the merge also
   yields the common prefix R of neighbours. With the common suffix L of two left
   contexts, L + R >= REACH says that [anchor - L, anchor + GRAM + R) is repeated;
4. a gram with more than GROUP distinct contexts is not gathered: its windows are
   counted by hash, which combines before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import frugal, give_back, materialise, map_ids

WIDTH = 200
GRAM = 64
#: Contexts of one gram that one task takes; the windows of larger groups are counted over all tasks.
GROUP = 1 << 16
SMALL = 32
PIECE = 1 << 17
RUN_BYTES = 4 << 20
# Odd multipliers of the rolling hashes and of their finisher.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
FINISH = 0xFF51AFD7ED558CCD

_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse."""
    if base not in _TABLES:
        size = PIECE + 4 * WIDTH
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size + 1, np.uint64)
            p[1:] = np.uint64(b)
            made.append(np.multiply.accumulate(p))
        _TABLES[base] = tuple(made)
    return _TABLES[base]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(FINISH)
    return x ^ (x >> np.uint64(29))


def _prefix(data: np.ndarray, base: int) -> np.ndarray:
    powers = _tables(base)[0]
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=out[1:])
    return out


def _between(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, base: int) -> np.ndarray:
    return (prefix[b] - prefix[a]) * _tables(base)[1][a]


def _sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over each run of w values (van Herk): blocks of w, accumulated from either side."""
    n = len(x)
    pad = -n % w
    fill = x[-1:]
    y = np.concatenate([x, np.repeat(fill, pad)]).reshape(-1, w)
    ahead = op.accumulate(y, axis=1).ravel()
    back = op.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - w + 1], ahead[w - 1 : n])


def anchors(data: bytes, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, gram hashes, context hashes) of a text's anchors; none below `width` bytes."""
    n, reach = len(data), width - gram
    empty = np.zeros(0, np.int64)
    if n < width:
        return empty, empty, empty
    whole = np.frombuffer(data, np.uint8)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for start in range(0, n, PIECE):
        # a piece sees enough on both sides to decide on its own positions and their contexts
        lo, hi = max(0, start - 2 * width), min(n, start + PIECE + 2 * width)
        part = whole[lo:hi]
        prefix = _prefix(part, BASES[0])
        at = np.arange(len(part) - gram + 1)
        if len(at) <= reach:
            continue
        h = _mix(_between(prefix, at, at + gram, BASES[0]))
        w = reach + 1
        least = _sliding(h, w, np.minimum)  # of each window, by its start
        padded = np.concatenate([np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64)])
        pos = np.flatnonzero(_sliding(padded, w, np.maximum) == h)
        pos = pos[(pos + lo >= start) & (pos + lo < start + PIECE)]
        if not len(pos):
            continue
        a, b = np.maximum(pos - reach, 0), np.minimum(pos + width, len(part))
        second = _prefix(part, BASES[1])
        ctx = _mix(_between(second, a, b, BASES[1]) ^ ((pos - a).astype(np.uint64) << np.uint64(20)) ^ (b - pos).astype(np.uint64))
        found.append((pos + lo, h[pos].view(np.int64), ctx.view(np.int64)))
    if not found:
        return empty, empty, empty
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def common(a: bytes, b: bytes, k: int = 0) -> int:
    """Length of the common prefix, of which k bytes are known."""
    n = min(len(a), len(b))
    while k + 32 <= n and a[k : k + 32] == b[k : k + 32]:
        k += 32
    while k < n and a[k] == b[k]:
        k += 1
    return k


def front_code(run: list[tuple[bytes, bytes]]) -> bytes:
    """A sorted run of (key, value): common prefix with the previous key, lengths, rest of key, value."""
    out, last = [], b""
    for key, value in run:
        k = common(last, key)
        out.append(k.to_bytes(2, "little") + (len(key) - k).to_bytes(2, "little") + len(value).to_bytes(2, "little") + key[k:] + value)
        last = key
    return b"".join(out)


def front_decode(blob: bytes) -> Iterator[tuple[bytes, bytes, int]]:
    """(key, value, common prefix with the previous key), one at a time."""
    at, last = 0, b""
    while at < len(blob):
        k, n, m = (int.from_bytes(blob[at + i : at + i + 2], "little") for i in (0, 2, 4))
        at += 6
        last = last[:k] + blob[at : at + n]
        yield last, blob[at + n : at + n + m], k
        at += n + m


def merge_runs(runs: list[bytes]) -> Iterator[tuple[bytes, bytes, int]]:
    """Front-coded sorted runs as one sorted stream of (key, value, common prefix with the previous output).

    A loser tree (Ng and Kakehi, 2008): each head knows its common prefix with
    the last output. Of two heads the one with the longer prefix is smaller; only
    of equal ones are bytes compared, from that prefix on.
    """
    streams = [front_decode(r) for r in runs]
    size = 1
    while size < max(1, len(streams)):
        size *= 2
    heads: list[tuple[bytes, bytes] | None] = [None] * size
    lcp = [0] * size
    for i, s in enumerate(streams):
        if (x := next(s, None)) is not None:
            heads[i] = (x[0], x[1])

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix becomes that with the winner."""
        if heads[a] is None:
            return b, a
        if heads[b] is None:
            return a, b
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        x, y = heads[a][0], heads[b][0]
        k = common(x, y, lcp[a])
        if k == len(x) or k < len(y) and x[k] < y[k]:
            lcp[b] = k
            return a, b
        lcp[a] = k
        return b, a

    losers = [0] * size
    winners = [0] * (2 * size)
    for i in range(size):
        winners[size + i] = i
    for i in range(size - 1, 0, -1):
        winners[i], losers[i] = play(winners[2 * i], winners[2 * i + 1])
    top = winners[1]
    while heads[top] is not None:
        yield heads[top][0], heads[top][1], lcp[top]
        x = next(streams[top], None) if top < len(streams) else None
        heads[top], lcp[top] = ((x[0], x[1]), x[2]) if x is not None else (None, 0)
        node = (size + top) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


def group_spans(entries: list[tuple[int, bytes]], rights: list[int], shared: list[int], reach: int, gram: int = GRAM) -> list[tuple[int, int]]:
    """For each of a gram's contexts the largest (L, R) over all partners with L + R >= reach; (-1, -1) where there is none.

    entries: (order, left context backwards), in the sort's order; shared[i]: R of
    entries i-1 and i beyond the gram. R of any two is the least in between.
    """
    n = len(entries)
    best = [[-1, -1] for _ in range(n)]
    if n <= SMALL:
        for i in range(n):
            r = reach
            for j in range(i + 1, n):
                r = min(r, shared[j])
                left = min(reach, common(entries[i][1], entries[j][1]))
                if left + r >= reach:
                    for e in (best[i], best[j]):
                        e[0], e[1] = max(e[0], left), max(e[1], r)
        return [tuple(b) for b in best]
    # for each split of a window into `left` and `right` bytes round the gram, equal pairs of classes are equal windows
    order = sorted(range(n), key=lambda i: entries[i][1])
    steps = np.array([0, *(common(entries[a][1], entries[b][1]) for a, b in zip(order, order[1:]))])
    place, rights_ = np.array(order), np.minimum(shared, reach)
    low, high = np.full(n, reach + 1), np.full(n, -1)
    lengths = np.array([len(e[1]) for e in entries])
    for left in range(reach + 1):
        lefts = np.empty(n, np.int64)
        lefts[place] = np.cumsum(steps < left)
        # contexts cut short by the text's own ends have no such window
        whole = (lengths >= left) & (np.array(rights) >= reach - left + gram)
        key = lefts * n + np.cumsum(rights_ < reach - left)
        own = np.flatnonzero(whole)
        _, at, times = np.unique(key[own], return_inverse=True, return_counts=True)
        hit = own[times[at] > 1]
        low[hit] = np.minimum(low[hit], left)
        high[hit] = np.maximum(high[hit], left)
    return [(int(h), int(reach - l)) if h >= 0 else (-1, -1) for l, h in zip(low, high)]


def _needed(src: DataFrame, want: DataFrame) -> DataFrame:
    """src (sha, id, text) joined to want (sha, id, ...): a Bloom filter keeps texts that nobody wants from moving."""
    n_blocks = bloom.blocks_for(want.count())
    words = bloom.build(want.select("sha"), "sha", n_blocks).scalar()
    picked = src.where(bloom.may_contain(words, F.col("sha"), n_blocks))
    return picked.join(want.withColumnsRenamed({"sha": "s", "id": "i"}), F.col("sha").eqNullSafe(F.col("s")) & F.col("id").eqNullSafe(F.col("i"))).drop("s", "i")


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(src, marks, spans): src (id, text, sha) of all rows; marks (row, id, sha, n, rep, copies), one per row of docs; spans (row, a, b) of the representative rows of texts that occur once, overlapping as found."""
    reach = width - gram
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("sha", F.sha2("text", 256))

    def sample(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            pos, h, ctx, size = [], [], [], []
            for t in pdf["text"]:
                data = t.encode()
                p, g, c = anchors(data, width, gram)
                pos.append(p.astype(np.int32))
                h.append(g)
                ctx.append(c)
                size.append(len(data))
            yield pd.DataFrame({"id": pdf["id"], "sha": pdf["sha"], "n": size, "pos": pos, "h": h, "ctx": ctx})

    read = map_ids(src, sample, "id bigint, sha string, n bigint, pos array<int>, h array<bigint>, ctx array<bigint>")
    read = materialise(read.withColumn("row", F.monotonically_increasing_id()), "anchors")
    texts = materialise(read.groupBy("sha").agg(F.min("row").alias("rep"), F.count("*").alias("copies")), "texts")
    marks = read.select("row", "id", "sha", "n").join(texts, "sha")
    marks = materialise(marks, "marks")
    own = marks.where("row = rep").select("row", F.when(F.col("copies") > 1, 2).otherwise(1).alias("w"))
    flat = read.select("row", F.explode(F.arrays_zip("pos", "h", "ctx")).alias("x")).select("row", "x.pos", "x.h", "x.ctx").join(own, "row")

    often = materialise(flat.groupBy("h").agg(F.sum("w").alias("n")).where("n > 1").select("h"), "grams")
    n_blocks = bloom.blocks_for(often.count())
    words = bloom.build(often, "h", n_blocks).scalar()
    kept = flat.where(bloom.may_contain(words, F.col("h"), n_blocks)).join(often, "h")
    kept = materialise(kept, "kept")
    contexts = kept.groupBy("h", "ctx").agg(F.sum("w").alias("c"), F.min(F.struct("row", "pos")).alias("at"))
    contexts = materialise(contexts.select("h", "ctx", "c", "at.row", "at.pos"), "contexts")
    sizes = materialise(contexts.groupBy("h").agg(F.count("*").alias("g")), "gram-sizes")
    settled = kept.join(contexts.where("c > 1").select("h", "ctx"), ["h", "ctx"]).join(marks.select("row", "n"), "row")
    settled = settled.select("row", F.greatest(F.col("pos") - reach, F.lit(0)).alias("a"), F.least(F.col("pos") + width, "n").cast("int").alias("b"))

    open_ = contexts.join(sizes.where("g > 1"), "h").join(marks.select("row", "id", "sha"), "row")
    wanted = open_.groupBy("row", "id", "sha").agg(F.collect_list(F.struct("pos", F.when(F.col("c") > 1, 1).otherwise(0).alias("done"), F.when(F.col("g") > GROUP, 1).otherwise(0).alias("big"), "h")).alias("at"))
    wanted = materialise(wanted, "wanted")
    n_open = open_.count()
    dests = max(1, -(-n_open * 2 * width // RUN_BYTES))
    there = _needed(src, wanted).select("row", "text", "at")

    def runs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Sorted front-coded runs by destination; windows of big groups as hashes (dest -1)."""
        by: dict[int, list[tuple[bytes, bytes]]] = {}
        held = 0

        def flush():
            out = [(d, front_code(sorted(by[d]))) for d in sorted(by)]
            by.clear()
            return pd.DataFrame(out, columns=["dest", "blob"]).assign(key=None, row=0, a=0, done=0)

        seen = set()
        for pdf in parts:
            hashed = []
            for row, text, at in zip(pdf["row"], pdf["text"], pdf["at"]):
                if row in seen:  # the same document given twice
                    continue
                seen.add(row)
                data = text.encode()
                for x in at:
                    p = x["pos"]
                    left, right = data[max(0, p - reach) : p], data[p : p + width]
                    if x["big"]:
                        base = p - len(left)
                        body = left + right
                        for o in range(len(body) - width + 1):
                            hashed.append((hashlib.blake2b(body[o : o + width], digest_size=16).digest(), row, base + o, x["done"]))
                        continue
                    key = right.ljust(width, b"\0") + left[::-1]
                    value = bytes([len(right), x["done"]]) + int(row).to_bytes(8, "little") + int(p).to_bytes(8, "little")
                    by.setdefault((x["h"] & 0x7FFFFFFFFFFFFFFF) % dests, []).append((key, value))
                    held += len(key)
                if len(hashed) > 50_000:
                    yield pd.DataFrame(hashed, columns=["key", "row", "a", "done"]).assign(dest=-1, blob=None)[RUN_COLUMNS]
                    hashed = []
                if held > 2 * RUN_BYTES:
                    yield flush()[RUN_COLUMNS]
                    held = 0
            if hashed:
                yield pd.DataFrame(hashed, columns=["key", "row", "a", "done"]).assign(dest=-1, blob=None)[RUN_COLUMNS]
        if by:
            yield flush()[RUN_COLUMNS]

    made = materialise(there.mapInPandas(frugal(runs), "dest bigint, blob binary, key binary, row bigint, a bigint, done int"), "runs")

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, group = [], []

        def close():
            if len(group) > 1:
                found = group_spans([(i, g[1]) for i, g in enumerate(group)], [g[0] for g in group], [g[2] for g in group], reach, gram)
                for (size, _, _, value), (left, right) in zip(group, found):
                    if left >= 0 and not value[1]:
                        row, p = int.from_bytes(value[2:10], "little"), int.from_bytes(value[10:18], "little")
                        rows.append((row, p - left, p + gram + right))
            group.clear()

        last = None
        for key, value, k in merge_runs([bytes(b) for b in pdf["blob"]]):
            size = value[0]
            k = min(k, size, last) if last is not None else 0
            if k < gram:
                close()
            group.append((size, key[width:], k - gram, value))
            last = size
        close()
        del pdf
        give_back()
        return pd.DataFrame(rows, columns=["row", "a", "b"]).astype({"row": "int64", "a": "int32", "b": "int32"})

    sorted_ = made.where("dest >= 0").select("dest", "blob").groupBy("dest").applyInPandas(merge, "row bigint, a int, b int")
    windows = made.where("dest = -1").select("key", "row", "a", "done")
    # a settled context stands for two places; one window may be listed by several anchors
    places = windows.groupBy("key", "row", "a").agg(F.max("done").alias("done"))
    twice = materialise(places.groupBy("key").agg((F.count("*") + F.max("done")).alias("n")).where("n > 1").select("key"), "windows")
    counted = windows.where("done = 0").join(twice, "key").select("row", F.col("a").cast("int").alias("a"), (F.col("a") + width).cast("int").alias("b"))
    once = marks.where("row = rep and copies = 1").select("row")
    spans = settled.unionByName(sorted_).unionByName(counted.distinct()).join(once, "row")
    return src, marks, spans


RUN_COLUMNS = ["dest", "blob", "key", "row", "a", "done"]


def _merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def suffix_dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256[, kept_text]), one row per row of docs.

    Every byte under a `width`-byte string that also starts elsewhere, in any
    document or the same one, is removed; all strings are judged on the input.
    Texts that occur twice as a whole are settled without a look inside. kept_text
    is what remains as UTF-8; a character cut in two by a span is dropped from it.

    Null and empty texts have nothing to remove. Null ids and repeated rows
    count as documents of their own (so repeated rows remove each other's
    text). An empty table gives no rows; other columns are ignored.
    """
    src, marks, spans = repeated_spans(docs, width, gram, id_col, text_col)
    listed = spans.groupBy("row").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    listed = listed.join(marks.select("row", "id", "sha"), "row").select("sha", "id", "spans")
    listed = materialise(listed, "spans")

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for sha, text, spans_ in zip(pdf["sha"], pdf["text"], pdf["spans"]):
                data, at, kept, removed = text.encode(), 0, [], 0
                merged = _merged(spans_)
                for a, b in merged:
                    kept.append(data[at:a])
                    removed += b - a
                    at = b
                kept.append(data[at:])
                left = b"".join(kept)
                rows.append((sha, removed, len(merged), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if with_text else None))
            yield pd.DataFrame(rows, columns=["sha", "n_removed", "n_spans", "kept_sha256", "kept_text"])

    done = _needed(src, listed).select("sha", "text", "spans").mapInPandas(frugal(cut), "sha string, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string")
    done = materialise(done.dropDuplicates(["sha"]), "cut")
    gone = (F.col("copies") > 1) & (F.col("n") >= width)
    out = marks.join(done, "sha", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_bytes"),
        F.when(gone, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        *([F.when(gone, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"), F.col("sha").alias("text_sha256")] if with_text else []),
    )
    return out
