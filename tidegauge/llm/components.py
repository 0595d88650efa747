"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): for each node of an edge its component's smallest node.

    Edges are (u, v) of one orderable type; nulls are ignored, self-loops and
    repeats harmless, no edges give no rows. Alternating large-star and
    small-star rounds (Kiveris et al., 2014): every node's edges are moved to
    the smallest neighbour until only stars are left. Each round is written to
    the shared folder, and only counts reach the driver. The minimum per
    node is pre-aggregated before its shuffle, and the join back is an equi-join
    that adaptive execution can split where a node has very many edges.
    """

    def tidy(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = materialise(tidy(edges.where("u is not null and v is not null")), "edges")
    seen = mark(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(materialise(least, "least"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(tidy(large), "large")
        small_m = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "small")
        small = large.join(small_m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small_m.select("u", F.col("m").alias("v")))
        now = materialise(tidy(small), "edges")
        last, seen = seen, mark(now)
        if last == seen:
            break
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
