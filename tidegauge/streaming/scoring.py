"""Scoring a stream of samples against statistics of a batch: an extension beyond the batch checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.stats import deviation, group_stats


def group_statistics(samples: DataFrame, keys: list[str], value: str, min_n: int = 5) -> DataFrame:
    """(keys, n, med, mad) of a batch, one row a key."""
    return group_stats(samples, keys, value, min_n)


def score_stream(stream: DataFrame, statistics: DataFrame, keys: list[str], value: str, z: float = 3.5, ratio: float = 1.5, min_diff: float = 0) -> DataFrame:
    """Samples of a stream (or batch) that deviate from their group's statistics.

    A stream-static equi-join without state: each micro-batch is scored on its own, so
    results do not depend on arrival order, and a restart repeats nothing but its batch.
    """
    s = stream.join(statistics, keys).withColumn("dev", deviation(F.col(value).cast("double"), F.col("med"), F.col("mad")))
    limit = F.when(F.col("mad") != 0, z).otherwise(ratio)
    return s.where((F.col("dev") > limit) & (F.abs(F.col(value) - F.col("med")) >= min_diff))
