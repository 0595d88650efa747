"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import bucket_links
from .common import materialise, map_ids
from .components import components

SEED = 42
WORDS_AT_ONCE = 1 << 16


def fingerprint(text: str, size: int = 3) -> int:
    """64-bit SimHash over word shingles, each occurrence with weight one.

    Fewer than `size` words make one shingle of them all; no words give 0.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, WORDS_AT_ONCE):
        part = words[at : min(n, at + WORDS_AT_ONCE) + size - 1]
        hashes = [digest(b" ".join(s), SEED) for s in zip(*[part[i:] for i in range(size)])]
        raw = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """2**(radius+1) - 1 masks such that any two values that differ in at most radius bits agree under one (Pagh, 2016).

    Bit i has the vector m(i) in {0,1}**(radius+1); mask v keeps the bits
    with <m(i), v> = 1. At most `radius` vectors leave some v orthogonal to
    them all, so that mask hides every differing bit. The vectors are dealt
    out evenly, so each mask keeps half the bits; vector zero is dealt too and its
    bits are kept by none.
    """
    size = 1 << (radius + 1)
    vectors = [(i * 5 + i // size) % size for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if bin(m & v).count("1") % 2) for v in range(1, size)]


def _prepare(pdf: pd.DataFrame) -> np.ndarray:
    return pdf["id"].to_numpy().view(np.uint64)


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 3) -> DataFrame:
    """(id_col, fingerprint, component_id), one row per row of docs.

    Rows link where their fingerprints differ in at most `radius` bits;
    component_id is the smallest id reachable over links. Equal fingerprints
    are grouped first, so copies are never paired; each distinct fingerprint goes to
    2**(radius+1)-1 tables under a structured mask, and exact Hamming distances
    decide inside the buckets. No link is lost.

    Null text counts as empty (fingerprint zero, linked like any other). Null
    ids take part, but a component of only null ids has component_id null.
    Repeated rows give repeated results; an empty table gives none; other
    columns are ignored.
    """
    def prints(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame({"id": pdf["id"], "fp": np.array([_signed(fingerprint(t, size)) for t in pdf["text"]], np.int64)})

    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marks = materialise(map_ids(src, prints, "id bigint, fp bigint"), "simhash")
    classes = materialise(marks.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")

    masks = F.array(*[F.lit(_signed(m)) for m in covering_masks(radius)])
    keyed = classes.select(F.col("fp").alias("id"), F.posexplode(masks).alias("t", "mask")).select("t", F.col("id").bitwiseAND(F.col("mask")).alias("key"), "id")
    payload = classes.select(F.col("fp").alias("id"), F.lit(1).cast("bigint").alias("weight"))

    def near(data, i, j):
        return np.bitwise_count(data[i] ^ data[j]) <= radius

    edges = bucket_links(keyed, ["t", "key"], payload, _prepare, near, "simhash").select(F.col("id").alias("u"), F.col("root").alias("v"))
    found = components(edges)
    rooted = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, "simhash-roots")
    smallest = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-components")
    of = materialise(rooted.join(smallest, "root").select("fp", "component_id"), "simhash-of")
    return marks.join(of, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
