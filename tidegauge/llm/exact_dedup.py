"""Exact duplicates by composable polynomial fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import materialise, map_ids

# Two primes below 2**26 and a base for each. With bytes below 2**8 and chunks of 2**13 bytes
# every partial sum stays below 2**47, so float64 dot products are exact.
PRIMES = (67108859, 67108837)
BASES = (31415921, 27182819)
CHUNK = 8192
#: Characters of a long text that one task hashes, and of the pieces in which texts are compared.
PART = 4 << 20
PIECE = 1 << 16

_POWERS = None


def _powers() -> np.ndarray:
    """CHUNK x 2: base**(CHUNK-1-i) modulo each prime."""
    global _POWERS
    if _POWERS is None:
        made = np.empty((CHUNK, 2))
        for j, (p, b) in enumerate(zip(PRIMES, BASES)):
            x = 1
            for i in range(CHUNK - 1, -1, -1):
                made[i, j] = x
                x = x * b % p
        _POWERS = made
    return _POWERS


def combine(left: tuple[int, int], right: tuple[int, int], right_len: int) -> tuple[int, int]:
    """Fingerprint of a concatenation from those of its parts."""
    return tuple((l * pow(b, right_len, p) + r) % p for l, r, p, b in zip(left, right, PRIMES, BASES))


def chunk_hashes(data: bytes) -> np.ndarray:
    """n x 2 hashes of the full and last chunks, each computed on its own."""
    powers = _powers()
    n, rest = divmod(len(data), CHUNK)
    a = np.frombuffer(data, np.uint8)
    out = np.zeros((n + bool(rest), 2), np.int64)
    for i in range(0, n, 256):
        j = min(n, i + 256)
        out[i:j] = (a[i * CHUNK : j * CHUNK].reshape(-1, CHUNK).astype(np.float64) @ powers).astype(np.int64)
    if rest:
        out[n] = (a[n * CHUNK :].astype(np.float64) @ powers[CHUNK - rest :]).astype(np.int64)
    return out % np.array(PRIMES)


def fingerprint(data: bytes) -> int:
    """52-bit polynomial fingerprint of any number of bytes."""
    parts = chunk_hashes(data)
    rest = len(data) % CHUNK
    h = (0, 0)
    for i, part in enumerate(parts):
        h = combine(h, (int(part[0]), int(part[1])), rest if rest and i == len(parts) - 1 else CHUNK)
    return h[0] << 26 | h[1]


def _hash_parts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Both hashes of each text, its bytes, and what a hash before it is multiplied by: base**bytes."""
    for pdf in parts:
        rows = []
        for t in pdf.pop("text"):
            data = t.encode()
            h = fingerprint(data)
            rows.append((len(data), h >> 26, h & ((1 << 26) - 1), *(pow(b, len(data), p) for b, p in zip(BASES, PRIMES))))
        yield pd.concat([pdf, pd.DataFrame(rows, columns=["n", "h0", "h1", "s0", "s1"], index=pdf.index)], axis=1)


HASHES = "n bigint, h0 bigint, h1 bigint, s0 bigint, s1 bigint"


def fingerprints(src: DataFrame) -> DataFrame:
    """(id, sha, n, fp) of (id, text, sha), one row each.

    Texts of up to PART characters are hashed where they are read. Longer ones are written as rows of PART characters,
    which are hashed by as many tasks, and their hashes combined in order, each shifted by the length of what follows.
    """
    whole = map_ids(src.where(F.length("text") <= PART).select("id", "sha", "text"), _hash_parts, f"id bigint, sha string, {HASHES}")
    marks = whole.select("id", "sha", "n", (F.shiftleft("h0", 26).bitwiseOR(F.col("h1"))).alias("fp"))
    long = src.where(F.length("text") > PART).withColumn("row", F.monotonically_increasing_id())  # fixed by writing it
    long = long.select("row", "id", "sha", F.posexplode(_cut("text", PART)).alias("part", "text"))
    parts = materialise(long, "long-texts")
    hashed = map_ids(parts, _hash_parts, f"row bigint, id bigint, sha string, part int, {HASHES}")
    listed = F.array_sort(F.collect_list(F.struct("part", "n", "h0", "h1", "s0", "s1")))
    joined = hashed.groupBy("row").agg(F.first("id").alias("id"), F.first("sha").alias("sha"), F.sum("n").alias("n"), listed.alias("x"))


    def combined(j: int):
        return F.aggregate("x", F.lit(0).cast("bigint"), lambda h, x: F.pmod(h * x[f"s{j}"] + x[f"h{j}"], F.lit(PRIMES[j]).cast("bigint")))

    return materialise(marks.unionByName(joined.select("id", "sha", "n", F.shiftleft(combined(0), 26).bitwiseOR(combined(1)).alias("fp"))), "fingerprints")


def _cut(text: str, size: int):
    """A text as an array of pieces of `size` characters, in one pass over it; an empty one has one piece."""
    return F.when(F.col(text) == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0)))


def collisions(src: DataFrame, marks: DataFrame, repeated: DataFrame) -> DataFrame:
    """(fp, n, odd): digests of texts that differ from the representative of their fingerprint and length.

    src: (id, text, sha); repeated: (fp, n, rep_sha). A Bloom filter of the wanted digests picks the rows; texts are
    compared with the representative's in pieces of PIECE characters, so no task holds
    two whole texts, and the pieces of one hot group are many keys.
    """
    wanted = materialise(marks.join(repeated, ["fp", "n"]).select(F.col("sha").alias("of"), "fp", "n", "rep_sha").distinct(), "wanted")
    n_blocks = bloom.blocks_for(wanted.count())
    words = bloom.build(wanted, "of", n_blocks).scalar()
    texts = src.where(bloom.may_contain(words, F.col("sha"), n_blocks)).join(wanted, F.col("sha") == F.col("of"))
    pieces = materialise(texts.select("fp", "n", "sha", "rep_sha", F.posexplode(_cut("text", PIECE)).alias("at", "piece")), "pieces")
    first = materialise(pieces.where("sha = rep_sha").groupBy("fp", "n", "at").agg(F.min("piece").alias("rep_piece")), "representatives")
    differ = pieces.join(first, ["fp", "n", "at"], "left").where(~F.col("piece").eqNullSafe(F.col("rep_piece")))
    return materialise(differ.select("fp", "n", F.col("sha").alias("odd")).distinct(), "collisions")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """(id_col, keep_id, group_size, kept, text_sha256), one row per row of docs.

    Equal texts (null counts as empty) form a group; the row with the largest
    (keep="max") or smallest id stays. Rows whose fingerprint and length are
    alone are settled at once. The others' texts are compared piece by piece with the
    text of their group's representative; those that only share a fingerprint
    are grouped by their digest instead, so the result is exact whatever collides.
    Joins have one representative a key, so adaptive execution can split a hot
    group, and counts are combined before shuffles.

    Null ids: counted in group_size; a group of only null ids has keep_id null
    and keeps its rows. Rows repeated with one id are the same document: each
    has that id's verdict. Empty tables give no rows; other columns are ignored.
    """
    pick = {"max": F.max, "min": F.min}[keep]
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("sha", F.sha2("text", 256))
    marks = fingerprints(src)
    # written, so that the join back has an exchange of its own on either side and a hot group can be split
    groups = materialise(marks.groupBy("fp", "n").agg(F.count("*").alias("size"), pick("id").alias("rep"), F.min("sha").alias("rep_sha")), "groups")
    repeated = groups.where("size > 1").select("fp", "n", "rep_sha")
    odd = collisions(src, marks, repeated) if repeated.head(1) else None
    if odd is not None and odd.head(1):
        marks = marks.join(odd.withColumnsRenamed({"fp": "f", "n": "m"}), (F.col("fp") == F.col("f")) & (F.col("n") == F.col("m")) & (F.col("sha") == F.col("odd")), "left")
        marks = materialise(marks.select("id", "sha", "n", "fp", F.coalesce("odd", F.lit("")).alias("class")), "classed")
        groups = materialise(marks.groupBy("fp", "n", "class").agg(F.count("*").alias("size"), pick("id").alias("rep")), "groups")
        settled = marks.join(groups, ["fp", "n", "class"])
    else:
        settled = marks.join(groups, ["fp", "n"])
    return settled.select(
        F.col("id").alias(id_col),
        F.col("rep").alias("keep_id"),
        F.col("size").cast("bigint").alias("group_size"),
        F.coalesce(F.col("id") == F.col("rep"), F.col("rep").isNull()).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
