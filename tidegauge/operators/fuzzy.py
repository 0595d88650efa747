"""Fuzzy pairing of names and components of what pairs."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.sources.shared import stage


def _edits(shorter, max_dist: int, ratio: float | None):
    """Most edits that a pair may have whose shorter string has that length."""
    return F.lit(max_dist) if ratio is None else F.least(F.lit(max_dist), F.floor(shorter * F.lit(float(ratio)) + 1e-9).cast("int"))


def _segment(length, parts, seg):
    """(start, size) of the seg-th of `parts` even segments of a string of that length."""
    start = F.floor(seg * length / parts).cast("int")
    return start, F.floor((seg + 1) * length / parts).cast("int") - start


def within_distance(names: DataFrame, probes: DataFrame, max_dist: int, key: str = "key", ratio: float | None = None) -> DataFrame:
    """(x, y, d): keys x of names and y of probes with 0 < levenshtein <= max_dist and x <> y, and d at most `ratio` of the shorter length. Exact.

    A string within k edits of another keeps one of k + 1 even segments whole, moved by
    k places at most (Li et al., 2011); k follows from the shorter length where there is a ratio. Segments
    and substrings meet in an equi-join on (length, k, segment, text), so no pair is formed without
    a common segment; one is empty only where a string has no more than k characters, and
    then all strings of that length are within k edits of each other.
    """
    a = names.select(F.col(key).alias("x")).where("x is not null").distinct().withColumn("lx", F.length("x"))
    b = probes.select(F.col(key).alias("y")).where("y is not null").distinct().withColumn("ly", F.length("y"))
    shorter = F.transform(F.sequence(F.greatest(F.col("lx") - max_dist, F.lit(0)), F.col("lx")), lambda n: _edits(n, max_dist, ratio))
    left = a.withColumn("k", F.explode(F.array_distinct(shorter))).where("k > 0").withColumn("seg", F.explode(F.sequence(F.lit(0), F.col("k"))))
    start, size = _segment(F.col("lx"), F.col("k") + 1, F.col("seg"))
    left = left.select("x", "lx", "k", "seg", F.substring(F.col("x"), start + 1, size).alias("part"))
    probe = b.withColumn("lx", F.explode(F.sequence(F.greatest(F.col("ly") - max_dist, F.lit(0)), F.col("ly") + max_dist)))
    probe = probe.withColumn("k", _edits(F.least("lx", "ly"), max_dist, ratio)).where("k > 0 and abs(lx - ly) <= k").withColumn("seg", F.explode(F.sequence(F.lit(0), F.col("k"))))
    start, size = _segment(F.col("lx"), F.col("k") + 1, F.col("seg"))
    probe = probe.withColumn("at", F.explode(F.sequence(F.greatest(start - F.col("k"), F.lit(0)), start + F.col("k"))))
    probe = probe.where(F.col("at") + size <= F.col("ly")).select("y", "lx", "k", "seg", F.substring(F.col("y"), F.col("at") + 1, size).alias("part")).distinct()
    pairs = left.join(probe, ["lx", "k", "seg", "part"]).where("x <> y").select("x", "y").distinct()
    pairs = pairs.withColumn("d", F.levenshtein("x", "y", max_dist)).where(F.col("d").between(1, max_dist))
    return pairs if ratio is None else pairs.where(F.col("d") / F.least(F.length("x"), F.length("y")) <= ratio)


def fuzzy_pairs(names: DataFrame, max_dist: int, ratio: float, key: str = "key") -> DataFrame:
    """(x, y, d) with x < y, d edits, 0 < d <= max_dist and d over the shorter length at most `ratio`."""
    return within_distance(names, names, max_dist, key, ratio).where("x < y")


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp ratio of the letters and digits, lower-cased; 1 where they are equal. No built-in function computes it."""
    keep = lambda s: "".join(c for c in s.lower() if c.isalnum())
    return pd.Series([1.0 if (x := keep(p)) == (y := keep(q)) else difflib.SequenceMatcher(None, x, y).ratio() for p, q in zip(a, b)])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of edges (u, v): the least node reachable, by min-label rounds with pointer jumping, written to the shared folder."""
    both = stage(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "both")
    labels = stage(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("c")).withColumnRenamed("u", "node"), "labels")
    for _ in range(max_rounds):
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("c").alias("m")).withColumnRenamed("u", "node")
        new = labels.join(near, "node").select("node", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        jump = new.select(F.col("node").alias("c"), F.col("c").alias("cc"))
        new = stage(new.join(jump, "c", "left").select("node", "old", F.coalesce(F.least("c", "cc"), "c").alias("c")), "labels")
        changed = new.where("old <> c").limit(1).count()
        labels = new.select("node", "c")
        if not changed:
            return labels.select("node", F.col("c").alias("component"))
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
