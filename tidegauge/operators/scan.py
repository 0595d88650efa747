"""Scans along sequences of any length: what a row takes from the rows before or after it in its key.

Keys of up to RANGE_ROWS rows are read by plain windows. Longer ones are cut into ranges of their order, each of which is
read on its own and gives one summary row (its number of rows, sum, maximum, last value, ...). The summaries of a key are
combined in order, one row a range, and handed back to the ranges as what came before or after them. So no task
reads more than a range of a key, but for rows that tie in the order, and every result is that of the plain window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.sources.shared import stage

#: Rows of a key that are read at once, and of a range.
RANGE_ROWS = 1_000_000


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def same_keys(keys: list[str], other: Callable[[str], Column]) -> Column:
    """Keys equal to other(key), nulls equal."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(other(k))
    return out


@dataclass(frozen=True)
class Take:
    """One result of a scan.

    within: its value inside a range, from a window; summary: of a range, from its last row (or its first, where `ahead`);
    carry: the summaries before (or after) a range as one value; both: the two together, given (within, carry, first row of the range, last row).
    """

    within: Callable
    carry: Callable
    both: Callable
    ahead: bool = False
    summary: Callable | None = None


def number() -> Take:
    """The place of the row, from 1."""
    return Take(lambda w: F.row_number().over(w).cast("bigint"), F.sum, lambda v, c, first, last: v + F.coalesce(c, F.lit(0)))


def lag(x: str | Column) -> Take:
    """The value of the row before."""
    return Take(lambda w: F.lag(col(x)).over(w), lambda s: F.last(s), lambda v, c, first, last: F.when(first, c).otherwise(v), summary=lambda: col(x))


def lead(x: str | Column) -> Take:
    """The value of the row after."""
    return Take(lambda w: F.lead(col(x)).over(w), lambda s: F.first(s), lambda v, c, first, last: F.when(last, c).otherwise(v), ahead=True, summary=lambda: col(x))


def _upto(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_sum(x: str | Column) -> Take:
    """The sum of the non-null values up to the row; null before the first."""
    return Take(lambda w: F.sum(col(x)).over(_upto(w)), F.sum, lambda v, c, first, last: F.coalesce(v + c, v, c))


def running_last(x: str | Column) -> Take:
    """The last non-null value up to the row."""
    return Take(lambda w: F.last(col(x), ignorenulls=True).over(_upto(w)), lambda s: F.last(s, ignorenulls=True), lambda v, c, first, last: F.coalesce(v, c))


def next_known(x: str | Column) -> Take:
    """The first non-null value after the row."""
    after = lambda w: w.rowsBetween(1, Window.unboundedFollowing)
    here = lambda w: w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return Take(
        lambda w: F.first(col(x), ignorenulls=True).over(after(w)), lambda s: F.first(s, ignorenulls=True), lambda v, c, first, last: F.coalesce(v, c),
        ahead=True, summary=lambda w: F.first(col(x), ignorenulls=True).over(here(w)),
    )


def running_max(x: str | Column) -> Take:
    """The greatest value up to the row."""
    return Take(lambda w: F.max(col(x)).over(_upto(w)), F.max, lambda v, c, first, last: F.greatest(v, c))


@dataclass(frozen=True)
class Sequences:
    """Rows of keys in an order: `short` keys whole, `long` ones with the number of their range in __p (None: there are none)."""

    keys: list[str]
    order: list[Column]
    short: DataFrame
    long: DataFrame | None

    def each(self, run: Callable[[DataFrame], DataFrame]) -> Sequences:
        """run on every row of either part; it may add, drop and filter, but the keys, the order and __p stay."""
        return replace(self, short=run(self.short), long=self.long and run(self.long))

    def add(self, **takes: Take) -> Sequences:
        """The rows with a column for each of `takes`."""
        w = Window.partitionBy(*self.keys).orderBy(*self.order)
        short = self.short.withColumns({n: t.within(w) for n, t in takes.items()})
        return replace(self, short=short, long=self.long and self._over_ranges(takes))

    def _over_ranges(self, takes: dict[str, Take]) -> DataFrame:
        w = Window.partitionBy(*self.keys, "__p").orderBy(*self.order)
        made = self.long.withColumns({n: t.within(w) for n, t in takes.items()}).withColumns({"__first": F.lag(F.lit(1)).over(w).isNull(), "__last": F.lead(F.lit(1)).over(w).isNull()})
        sums = {}
        for i, (n, t) in enumerate(takes.items()):
            given = t.summary(w) if t.summary and t.summary.__code__.co_argcount else t.summary() if t.summary else F.col(n)
            sums[f"__s{i}"] = F.when(F.col("__first" if t.ahead else "__last"), F.struct(given.alias("v")))
        made = stage(made.withColumns(sums), "ranges")
        ends = made.groupBy(*self.keys, "__p").agg(*[F.first(s, ignorenulls=True)["v"].alias(s) for s in sums])  # one value a range: the others are null
        order = Window.partitionBy(*self.keys).orderBy("__p")
        before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
        carried = [t.carry(F.col(s)).over(after if t.ahead else before).alias(f"__c{i}") for i, (s, t) in enumerate(zip(sums, takes.values()))]
        ends = stage(ends.select(*[F.col(k).alias(f"__k_{k}") for k in self.keys], F.col("__p").alias("__q"), *carried), "carried")
        joined = made.join(ends, same_keys(self.keys, lambda k: F.col(f"__k_{k}")) & (F.col("__p") == F.col("__q")))
        joined = joined.withColumns({n: t.both(F.col(n), F.col(f"__c{i}"), F.col("__first"), F.col("__last")) for i, (n, t) in enumerate(takes.items())})
        return joined.drop("__first", "__last", "__q", *sums, *[f"__c{i}" for i in range(len(takes))], *[f"__k_{k}" for k in self.keys])

    def over_key(self, **aggregates: Column) -> Sequences:
        """The rows with an aggregate of their whole key: a window for short keys, a join with one row a key for long ones."""
        short = self.short.withColumns({n: a.over(Window.partitionBy(*self.keys)) for n, a in aggregates.items()})
        if self.long is None:
            return replace(self, short=short)
        long = stage(self.long, "long")
        found = long.groupBy(*[F.col(k).alias(f"__k_{k}") for k in self.keys]).agg(*[a.alias(n) for n, a in aggregates.items()])
        return replace(self, short=short, long=long.join(found, same_keys(self.keys, lambda k: F.col(f"__k_{k}"))).drop(*[f"__k_{k}" for k in self.keys]))

    def rows(self) -> DataFrame:
        return self.short if self.long is None else self.short.unionByName(self.long.drop("__p"))


def split_long(df: DataFrame, keys: list[str], most: int | None = None) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows of short keys, rows of keys with more than `most` rows or None, how many rows those are).

    A table of no more rows has no such key, and to count one needs no columns and no shuffle; counts by key are combined before theirs.
    """
    most = most or RANGE_ROWS
    if df.count() <= most:
        return df, None, 0
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    n = counts.agg(F.sum("_n")).first()[0]
    if not n:
        return df, None, 0
    named = stage(counts.select(*[F.col(k).alias(f"__k_{k}") for k in keys]), "long-keys")
    same = same_keys(keys, lambda k: F.col(f"__k_{k}"))
    return df.join(named, same, "left_anti"), df.join(named, same, "left_semi"), n


def ranged(long: DataFrame, keys: list[str], order: list[Column], n: int, most: int | None = None) -> DataFrame:
    """Rows of long keys with __p, the number of their range: about `most` rows each, in the order's order. Written, so that a row's range is settled."""
    parts = -(-n // (most or RANGE_ROWS)) + 1
    return stage(long.repartitionByRange(parts, *[F.col(k) for k in keys], *order).withColumn("__p", F.spark_partition_id()), "ranged")


def sequences(df: DataFrame, keys: list[str], order: list[str | Column], desc: bool = False) -> Sequences:
    """The rows of df as sequences of their keys (nulls equal) in an order, ascending unless its columns say otherwise."""
    by = [(c.desc() if desc else c.asc()) if isinstance(o, str) else c for o in order for c in [col(o)]]
    short, long, n = split_long(df, keys)
    return Sequences(keys, by, short, long if long is None else ranged(long, keys, by, n))
