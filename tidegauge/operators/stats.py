"""Robust statistics: medians, deviations and outlier scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.scan import running_sum, same_keys, sequences
from tidegauge.sources.shared import stage


def deviation(x: Column, med: Column, mad: Column) -> Column:
    """Modified z score; where MAD is 0 the ratio to the median, which is infinite where either is 0 and they differ."""
    ratio = F.when((med == 0) | (x == 0), F.when(x == med, 0.0).otherwise(float("inf"))).when(x > med, F.try_divide(x, med)).otherwise(F.try_divide(med, x))
    return F.when(mad != 0, F.abs(F.try_divide(F.lit(0.6745) * (x - med), mad))).otherwise(ratio)


def value_counts(samples: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, x, c): how often a key has each of its known values. Combined before the shuffle; written, as medians and deviations both read it."""
    own = samples.select(*keys, F.col(value).cast("double").alias("x")).where("x is not null and not isnan(x)")
    return stage(own.groupBy(*keys, "x").agg(F.count("*").alias("c")), "counts")


def weighted_medians(counts: DataFrame, keys: list[str], out: str = "med") -> DataFrame:
    """(keys, n, out): exact medians of values x that occur c times each, one row a key.

    Occurrences are summed along each key's distinct values, by ranges where a key has very many (`scan`).
    """
    total = counts.groupBy(*[F.col(k).alias(f"_t_{k}") for k in keys]).agg(F.sum("c").alias("n"))
    upto = sequences(counts, keys, ["x"]).add(_upto=running_sum("c")).rows()
    found = upto.join(total, same_keys(keys, lambda k: F.col(f"_t_{k}")))
    at = lambda rank: F.min(F.when(F.col("_upto") > rank, F.col("x")))
    middle = (at(F.floor((F.col("n") - 1) / 2)) + at(F.floor(F.col("n") / 2))) / 2
    return found.groupBy(*keys, "n").agg(middle.alias(out))


def group_medians(samples: DataFrame, keys: list[str], value: str, out: str = "med") -> DataFrame:
    """(keys, n, out): exact medians of the non-null values, one row a key."""
    return weighted_medians(value_counts(samples, keys, value), keys, out)


def group_stats(samples: DataFrame, keys: list[str], value: str, min_n: int = 1) -> DataFrame:
    """(keys, n, med, mad), one row a key with at least min_n values. Samples are read once; medians and deviations come from the counts of their values."""
    counts = value_counts(samples, keys, value)
    med = stage(weighted_medians(counts, keys).where(F.col("n") >= min_n), "medians")
    named = med.select(*[F.col(k).alias(f"_m_{k}") for k in keys], "med")
    off = counts.join(named, same_keys(keys, lambda k: F.col(f"_m_{k}"))).groupBy(*keys, F.abs(F.col("x") - F.col("med")).alias("x")).agg(F.sum("c").alias("c"))
    mad = weighted_medians(stage(off, "deviations"), keys, "mad").select(*[F.col(k).alias(f"_d_{k}") for k in keys], "mad")
    return stage(med.join(mad, same_keys(keys, lambda k: F.col(f"_d_{k}"))).select(*keys, "n", "med", "mad"), "statistics")


def with_group_stats(samples: DataFrame, keys: list[str], value: str, min_n: int = 1) -> DataFrame:
    """samples with n, med and mad of their group; groups under min_n drop out, and so do rows with a null key.

    The statistics are written, one row a key, so the rows of a hot key join them without meeting in one task.
    """
    return samples.join(group_stats(samples, keys, value, min_n), keys)


def group_outliers(samples: DataFrame, keys: list[str], value: str, min_n: int = 5, z: float = 3.5, ratio: float = 1.5, min_diff: float = 0) -> DataFrame:
    """Samples that deviate from their group: z score over `z`, or ratio over `ratio` where MAD is 0, and at least min_diff off the median."""
    s = with_group_stats(samples, keys, value, min_n)
    s = s.withColumn("dev", deviation(F.col(value).cast("double"), F.col("med"), F.col("mad")))
    limit = F.when(F.col("mad") != 0, z).otherwise(ratio)
    return s.where((F.col("dev") > limit) & (F.abs(F.col(value) - F.col("med")) >= min_diff))


def exact_median(df: DataFrame, value: str) -> float | None:
    """Median of a whole column, as that of one group; None for no values."""
    found = group_medians(df.select(F.lit(0).alias("_g"), F.col(value).alias("_v")), ["_g"], "_v").first()
    return found.med if found else None


def global_outliers(samples: DataFrame, value: str, min_n: int = 5, z: float = 3.5) -> DataFrame:
    """Samples over `z` against all others as one group; none where there are under min_n or MAD is 0."""
    found = group_stats(samples.select(F.lit(0).alias("_g"), F.col(value).alias("_v")), ["_g"], "_v", min_n).first()
    if found is None or not found.mad:
        return samples.withColumns({"med": F.lit(0.0), "mad": F.lit(0.0), "dev": F.lit(0.0)}).where("false")
    dev = F.abs(F.lit(0.6745) * (F.col(value) - found.med) / F.lit(found.mad))
    return samples.withColumns({"med": F.lit(found.med), "mad": F.lit(found.mad), "dev": dev}).where(F.col("dev") > z)
