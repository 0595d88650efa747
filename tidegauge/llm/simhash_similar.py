"""SimHash near-duplicates decided by the similarity of shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .buckets import bucket_links
from .common import frugal, materialise, map_ids
from .components import components
from .simhash import covering_masks

SEED = 42
#: Chance to miss a pair exactly at the threshold; more similar pairs are missed less.
MISS = 1e-5
ROWS = 6
SHINGLES_AT_ONCE = 1 << 11


def bands_for(threshold: float) -> int:
    """Bands of ROWS minima each such that a pair at the threshold agrees in none with probability MISS at most."""
    return math.ceil(math.log(MISS) / math.log1p(-(threshold**ROWS)))


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `size` words; fewer words make one shingle of them all, no words none."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) < size:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    return np.unique(np.array([digest(b" ".join(s), SEED) for s in zip(*[words[i:] for i in range(size)])], np.uint64))


def band_keys(own: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A key for each ROWS of the minima of `own` under multiplication by odd factors."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(own), SHINGLES_AT_ONCE):
        np.minimum(least, (factors[:, None] * own[None, i : i + SHINGLES_AT_ONCE]).min(axis=1), out=least)
    rows = least.reshape(-1, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(rows)], np.uint64).view(np.int64)


def covering_keys(own: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """A key for the SimHash of a set of hashes under each mask."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(own), 1 << 16):
        ones += np.unpackbits(own[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    print_ = np.packbits(ones * 2 > len(own), bitorder="little").view(np.uint64)[0]
    return np.array([xxhash.xxh64_intdigest((print_ & m).tobytes(), 1000 + i) for i, m in enumerate(masks)], np.uint64).view(np.int64)


class _Members:
    """What tells which members of a bucket are linked; pairs that are connected already are not compared again."""

    def __init__(self, pdf: pd.DataFrame):
        _, self.at = np.unique(pdf["id"].to_numpy(), return_inverse=True)
        self.sets = [np.frombuffer(x, "<u8") for x in pdf["shingles"]]
        self.n = np.array([len(x) for x in self.sets])
        self.up = np.arange(self.at.max() + 1 if len(pdf) else 0)

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def linked(self, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
        while (self.up != (above := self.up[self.up])).any():
            self.up = above
        ok = np.zeros(len(i), bool)
        small, large = np.minimum(self.n[i], self.n[j]), np.maximum(self.n[i], self.n[j])
        for p in np.flatnonzero((self.up[self.at[i]] != self.up[self.at[j]]) & (small >= threshold * large - 1e-9)):
            a, b = self.root(self.at[i[p]]), self.root(self.at[j[p]])
            if a == b:
                continue
            x, y = self.sets[i[p]], self.sets[j[p]]
            both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            if both >= threshold * (len(x) + len(y) - both) - 1e-9:
                self.up[max(a, b)] = min(a, b)
                ok[p] = True
        return ok


def distinct_buckets(keyed: DataFrame) -> DataFrame:
    """(key) of the buckets of (node, key) with two members or more; of buckets with the same members one. Members are compared by count and 128 bits of summed hashes."""
    sums = [F.sum(h.cast("decimal(38,0)")).alias(f"h{i}") for i, h in enumerate((F.xxhash64("node"), F.xxhash64(F.lit(1), F.col("node"))))]
    buckets = keyed.groupBy("key").agg(F.count("*").alias("c"), *sums).where("c > 1")
    return materialise(buckets.groupBy("c", "h0", "h1").agg(F.min("key").alias("key")).select("key"), "near-buckets")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, threshold: float = 0.8, radius: int = 3) -> DataFrame:
    """(id_col, text_sha256, keep_id, keep_sha256) of the rows in groups of near copies, one a row.

    Rows link where the sets of their shingles of `size` words (A-Z lower-cased) have
    a Jaccard similarity of at least `threshold`; a group is what links connect. The row
    with the smallest id stays, null ids last, then the smallest digest.

    Covering LSH proposes all pairs whose 64-bit SimHash over those shingles differs in at most
    `radius` bits. A pair at a similarity of 0.8 differs in about ten, out of reach of any
    covering of a size that could be afforded, so bands of shingle minima propose beside the
    masks (one at the threshold is missed with probability MISS). Pairs are compared only inside the bucket of a
    key, exactly, by 64-bit hashes of shingles, and what leaves a bucket are star edges of verified links; components are taken of those alone.
    So chains of rows that merely share keys never run together, and no work is larger than the largest bucket, which is dealt out in blocks. Buckets
    with the same members are searched once. Only texts of rows that share a key are read a second time and moved.

    Null and empty texts and those without words are in no group. Null ids take part; repeated rows give
    repeated results; an empty table gives none; other columns are ignored.
    """
    factors = np.random.RandomState(23).randint(0, 1 << 62, bands_for(threshold) * ROWS, dtype=np.int64).astype(np.uint64) * np.uint64(4) + np.uint64(1)
    masks = np.array(covering_masks(radius), np.uint64)

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            keys = []
            for t in pdf.pop("text"):
                own = shingle_set(t, size)
                keys.append(np.concatenate([band_keys(own, factors), covering_keys(own, masks)]) if len(own) else np.zeros(0, np.int64))
            pdf["keys"] = keys
            yield pdf

    def sets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"sha": pdf["sha"], "shingles": [shingle_set(t, size).astype("<u8").tobytes() for t in pdf["text"]]})

    # numbers are fixed by writing them
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("sha", F.sha2("text", 256))
    marks = src.select(F.monotonically_increasing_id().alias("node"), "id", "sha", "text")
    marks = materialise(map_ids(marks, read, "node bigint, id bigint, sha string, keys array<bigint>"), "near-marks")
    keyed = marks.select("node", F.explode("keys").alias("key"))
    shared = materialise(keyed.join(distinct_buckets(keyed), "key"), "near-shared")
    some = materialise(marks.select("node", "id", "sha").join(shared.select("node").distinct(), "node"), "near-some")
    wanted = materialise(some.select("sha").distinct(), "near-wanted")
    n_blocks = bloom.blocks_for(wanted.count())
    words = bloom.build(wanted, "sha", n_blocks).scalar()
    # a filter of the members' digests picks their rows, so that the other texts do not move
    texts = src.select("sha", "text").where(bloom.may_contain(words, F.col("sha"), n_blocks))
    found = texts.mapInPandas(frugal(sets), "sha string, shingles binary").join(wanted, "sha", "left_semi").groupBy("sha").agg(F.first("shingles").alias("shingles"))
    payload = some.select("sha", F.col("node").alias("id"), F.lit(1).cast("bigint").alias("weight")).join(materialise(found, "near-sets"), "sha").drop("sha")
    links = bucket_links(shared.select("key", F.col("node").alias("id")), ["key"], payload, _Members, lambda data, i, j: data.linked(i, j, threshold), "near")
    roots = materialise(components(links.select(F.col("id").alias("u"), F.col("root").alias("v"))).distinct(), "near-found")
    members = materialise(some.select("node", "id", "sha").join(roots, "node").select("root", "id", "sha"), "near-members")
    first = members.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "sha")).alias("keep"))
    kept = materialise(first.select("root", F.col("keep.id").alias("keep_id"), F.col("keep.sha").alias("keep_sha256")), "near-kept")
    return members.join(kept, "root").select(F.col("id").alias(id_col), F.col("sha").alias("text_sha256"), "keep_id", "keep_sha256")
