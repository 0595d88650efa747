"""Functional dependencies, bands, first-seen choices and positional joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.scan import number, sequences
from tidegauge.sources.shared import stage


def dependency_violations(df: DataFrame, left: list[str], right: str, seen: str) -> DataFrame:
    """(left..., right, n, best, n_best, score): values of `right` other than the most frequent of their `left`.

    On a tie the first seen (least `seen`) is the best; the score is 8 + n_best - n.
    """
    counts = df.groupBy(*left, right).agg(F.count("*").alias("n"), F.min(seen).alias("_s"))
    w = Window.partitionBy(*left)
    ranked = counts.withColumn("_k", F.row_number().over(w.orderBy(F.col("n").desc(), "_s")))
    ranked = ranked.withColumn("best", F.max(F.when(F.col("_k") == 1, F.col(right))).over(w)).withColumn("n_best", F.max(F.when(F.col("_k") == 1, F.col("n"))).over(w))
    return ranked.where("_k > 1").select(*left, right, "n", "best", "n_best", (8 + F.col("n_best") - F.col("n")).alias("score"))


#: Bands that are compared with all keys at once; more go in blocks of about so many.
BAND_BLOCK = 10_000


def classify_bands(values: DataFrame, key: list[str], value: str, bands: DataFrame) -> DataFrame:
    """(key..., band): the only band (name, lo, hi; both closed) that holds all known values of a key, else null.

    Bands are compared with a key's least and largest value, so the join has one row a key. Bands
    are sent to all tasks, in blocks of about BAND_BLOCK if there are more.
    """
    ends = values.groupBy(*key).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    blocks = -(-bands.count() // BAND_BLOCK) or 1
    if blocks > 1:
        ends = stage(ends, "ends")
    found = None
    for i in range(blocks):
        own = bands.where(F.pmod(F.xxhash64("name", "lo", "hi"), F.lit(blocks)) == i) if blocks > 1 else bands
        fits = ends.join(F.broadcast(own), (F.col("_lo") >= F.col("lo")) & (F.col("_hi") <= F.col("hi"))).groupBy(*key).agg(F.count("name").alias("_n"), F.min("name").alias("_b"))
        found = fits if found is None else found.unionByName(fits)
    found = found.groupBy(*key).agg(F.sum("_n").alias("_n"), F.min("_b").alias("_b"))
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    out = ends.join(found.withColumnsRenamed({k: f"_k_{k}" for k in key}), same, "left")
    return out.select(*key, F.when(F.col("_n") == 1, F.col("_b")).alias("band"))


def first_seen(df: DataFrame, keys: list[str], order: list[str], flag: str = "first") -> DataFrame:
    """df with `flag`: true on the rows with the least `order` of their key value (nulls equal).

    The least is pre-aggregated and joined back, so a key that very many rows share meets in no window.
    """
    df = stage(df, "unseen")
    least = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(F.struct(*order)).alias("_least"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(least, same).withColumn(flag, F.struct(*order) == F.col("_least")).drop("_least", *[f"_k{i}" for i in range(len(keys))])


def zip_streams(a: DataFrame, b: DataFrame, keys: list[str], order_a: list[str], order_b: list[str]) -> DataFrame:
    """Rows of two streams joined by position inside a key; what either has over stays, with nulls.

    Positions of a key with very many rows are counted by ranges and offsets (`scan`), and the join's key holds the position, so
    few keys spread over many tasks.
    """
    x = sequences(a, keys, order_a).add(pos=number()).rows()
    y = sequences(b, keys, order_b).add(pos=number()).rows()
    return x.join(y, [*keys, "pos"], "full_outer")


def rank_findings(findings: DataFrame, severity: str, score: str, n_rules: str, seq: list[str]) -> DataFrame:
    """findings with `weighted` and `rank`: severity first, then score raised by half for each further rule, then order of emission.

    Ranks are counted per range partition and offset, so no task holds all rows.
    """
    weighted = F.col(score) * (1 + F.lit(0.5) * (F.col(n_rules) - 1))
    return number_rows(findings.withColumn("weighted", weighted), [F.col(severity), F.col("weighted").desc(), *[F.col(c) for c in seq]], "rank")


#: Rows of a range partition.
RANGE_ROWS = 1_000_000


def number_rows(df: DataFrame, order: list, out: str) -> DataFrame:
    """df with its 1-based place in a total order: range partitions are numbered on their own and offset by the counts before them."""
    df = stage(df, "unranked")
    parts = max(1, -(-df.count() // RANGE_ROWS))
    ranged = stage(df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()), "ranged")
    before = ranged.groupBy("_p").agg(F.count("*").alias("_n"))  # one row a partition
    before = before.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return ranged.withColumn("_k", local).join(F.broadcast(before), "_p").withColumn(out, F.col("_k") + F.col("_before")).drop("_p", "_k", "_before")


def unmatched(findings: DataFrame, ignores: DataFrame, on: list[str], rules: str, values: str) -> tuple[DataFrame, DataFrame]:
    """(findings that no entry excuses, entries that excuse nothing).

    An entry excuses a finding with the same place (nulls equal) and values whose
    rules are a subset of the entry's.
    """
    e = ignores.select(*[F.col(c).alias(f"_e_{c}") for c in [*on, rules, values]])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_e_{c}"))
    cond = cond & F.col(values).eqNullSafe(F.col(f"_e_{values}")) & (F.size(F.array_except(F.col(rules), F.col(f"_e_{rules}"))) == 0)
    left = findings.join(e, cond, "left_anti")
    f = findings.select(*[F.col(c).alias(f"_f_{c}") for c in [*on, rules, values]])
    back = F.lit(True)
    for c in on:
        back = back & F.col(c).eqNullSafe(F.col(f"_f_{c}"))
    back = back & F.col(values).eqNullSafe(F.col(f"_f_{values}")) & (F.size(F.array_except(F.col(f"_f_{rules}"), F.col(rules))) == 0)
    return left, ignores.join(f, back, "left_anti")
