"""Merging several readings of the same cells by vote, and pruning what has been settled."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.scan import number, sequences


def vote(readings: DataFrame, cell: list[str], run: str, value: str, extra: str | None = None, name: str | None = None) -> DataFrame:
    """(cell..., value, votes, n_readings, agreed, readings[, detail]), one row per cell.

    Equal votes of the voters; ties go to a value that an extra run backs, then to the
    one the first voter gave. `readings` lists the values in that order, extras' own values
    last, as `a ¦ b` with ∅ for an empty one. With `name`, the column of the runs' names, `detail` is
    `a (run, run); b (run)`. Runs are not joined: their union is
    grouped by cell, so counts combine before the shuffle.
    """
    ex = F.coalesce(F.col(extra), F.lit(False)) if extra else F.lit(False)
    who = F.col(name) if name else F.col(run).cast("string")
    votes = readings.select(*cell, F.col(run).alias("_run"), who.alias("_name"), F.coalesce(value, F.lit("")).alias("_v"), ex.alias("_x"))
    votes = votes.groupBy(*cell, "_v").agg(
        F.count_if(~F.col("_x")).alias("_n"), F.max("_x").alias("_backed"), F.min(F.when(~F.col("_x"), F.col("_run"))).alias("_first"), F.min("_run").alias("_any"),
        *([F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_run", "_name"))), lambda r: r["_name"]), ", ").alias("_who")] if name else []),
    )
    order = [F.col("_n").desc(), F.when(F.col("_backed"), 0).otherwise(1), F.col("_first").asc_nulls_last(), F.col("_any")]
    votes = votes.withColumn("_k", F.row_number().over(Window.partitionBy(*cell).orderBy(*order)))
    shown = F.when(F.col("_v") == "", "∅").otherwise(F.col("_v"))
    return votes.groupBy(*cell).agg(
        F.max(F.when(F.col("_k") == 1, F.col("_v"))).alias("value"),
        F.max(F.when(F.col("_k") == 1, F.col("_n"))).alias("votes"),
        F.count("*").alias("n_readings"),
        (F.count_if(F.col("_n") > 0) == 1).alias("agreed"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", shown.alias("s")))), lambda x: x["s"]), " ¦ ").alias("readings"),
        *([F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_k", F.concat(shown, F.lit(" ("), F.col("_who"), F.lit(")")).alias("s")))), lambda x: x["s"]), "; ").alias("detail")] if name else []),
    )


def layout_majority(layouts: DataFrame, unit: list[str], run: str, signature: str, unknown: str = "UNKNOWN") -> DataFrame:
    """(unit..., signature, n_runs, kept): the layout of most voters, kept if two or more share it, none ties with it, and it is known or the only one."""
    n = layouts.groupBy(*unit, signature).agg(F.countDistinct(run).alias("n_runs"), F.min(run).alias("_first"))
    w = Window.partitionBy(*unit).orderBy(F.col("n_runs").desc(), "_first", signature)
    n = n.withColumn("_k", F.row_number().over(w)).withColumn("_next", F.lead("n_runs").over(w)).where("_k = 1")
    tied = F.coalesce(F.col("_next") == F.col("n_runs"), F.lit(False))
    return n.select(*unit, signature, "n_runs", ((F.col("n_runs") >= 2) & ~tied & ((F.col(signature) != unknown) | F.col("_next").isNull())).alias("kept"))


def count_majority(pages: DataFrame, unit: list[str], run: str, n_pages: str) -> DataFrame:
    """(unit..., n_pages): the page count of most runs, the first run's on a tie."""
    n = pages.groupBy(*unit, n_pages).agg(F.count("*").alias("_n"), F.min(run).alias("_first"))
    return n.withColumn("_k", F.row_number().over(Window.partitionBy(*unit).orderBy(F.col("_n").desc(), "_first"))).where("_k = 1").select(*unit, n_pages)


def text_groups(texts: DataFrame, unit: list[str], run: str, text: str) -> DataFrame:
    """(unit..., text, runs, n_lines): runs with identical text, in run order."""
    return texts.groupBy(*unit, text).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(run)), lambda r: r.cast("string")), ",").alias("runs"), F.size(F.split(F.first(text), "\n")).alias("n_lines")
    )


def prune(claims: DataFrame, occurrences: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Claims that an occurrence of their mark still backs: the first k of a mark's claims, k its occurrences (a multiset semi join).

    Occurrences are counted before they shuffle; the claims of a mark with very many are numbered by ranges (`scan`).
    """
    have = occurrences.groupBy(*keys).agg(F.count("*").alias("_have"))
    return sequences(claims, keys, order).add(_k=number()).rows().join(have, keys).where("_k <= _have").drop("_k", "_have")
