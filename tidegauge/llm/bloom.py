"""A blocked Bloom filter in DataFrame expressions.

A key goes to one block of four 64-bit words and sets one bit in each word, so
a test touches one block. The filter is one array, made by aggregation and read
as a scalar subquery. Its size is bounded by `max_blocks` whatever the
number of keys: a fuller filter only lets more false hits through, and callers
remove those by an exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 4
MAX_BLOCKS = 1 << 18  # 8 MB


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def _mask(key: Column, word: int) -> Column:
    """1 << (six bits of a second hash of the key)."""
    shift = F.shiftrightunsigned(F.xxhash64(key, F.lit(1)), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)


def blocks_for(n_keys: int, max_blocks: int = MAX_BLOCKS) -> int:
    """About 16 bits a key, as a power of two up to max_blocks."""
    want = max(1, n_keys * 16 // (64 * WORDS))
    return min(max_blocks, 1 << (want - 1).bit_length()) if want > 1 else 1


def build(keys: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """One row, one column `words`: array<bigint> of n_blocks * WORDS words.

    Null keys set no bit. No keys give a filter of zeros.
    """
    spark = keys.sparkSession
    k = F.col(key)
    made = (
        keys.where(k.isNotNull())
        .select(_block(k, n_blocks).alias("b"), *[_mask(k, i).alias(f"m{i}") for i in range(WORDS)])
        .groupBy("b")
        .agg(*[F.bit_or(f"m{i}").alias(f"m{i}") for i in range(WORDS)])
    )
    dense = (
        spark.range(n_blocks)
        .select(F.col("id").cast("int").alias("b"))
        .join(made, "b", "left")
        .select("b", F.array(*[F.coalesce(F.col(f"m{i}"), F.lit(0).cast("bigint")) for i in range(WORDS)]).alias("w"))
    )
    return dense.agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("b", "w"))), lambda s: s["w"])).alias("words"))


def may_contain(words: Column, key: Column, n_blocks: int) -> Column:
    """False only where key is certainly not among the keys of the filter."""
    at = _block(key, n_blocks) * WORDS
    test = F.lit(True)
    for i in range(WORDS):
        m = _mask(key, i)
        test = test & (F.element_at(words, at + (i + 1)).bitwiseAND(m) != 0)
    return test
