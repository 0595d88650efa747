"""Ordered sequences: clocks, directions, gaps, legs, zones, runs. One exchange and sort per key serves them all.

All go through `scan`, which cuts long keys into ranges, so one very long sequence is the work of many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.scan import Sequences, lag, lead, next_known, number, ranged, running_last, running_max, running_sum, sequences, split_long

DAY = 86400


def along(keys: list[str], order: list, desc: bool = False):
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    return Window.partitionBy(*keys).orderBy(*[c.desc() if desc else c.asc() for c in cols])


def clock(df: DataFrame, keys: list[str], order: list[str], seconds: str, at_stop: Column | None = None) -> DataFrame:
    """df with `v` (seconds past the first midnight), `wrapped` and `back` (the clock steps back).

    At most one wrap a sequence: the first 24.00, or the first step back from
    20.00 or later to 08.00 or earlier; inside a stop only if at most an hour
    passes. Until the wrap plain lags suffice, so the cumulative clock is a
    closed form over scans.
    """
    s, p = F.col(seconds), F.col("_p_")
    stop = at_stop if at_stop is not None else F.lit(False)
    candidate = (s == DAY) | ((s < p) & (F.pmod(p, F.lit(DAY)) >= 72000) & (s <= 28800) & (~stop | (s + DAY - p <= 3600)))
    rows = sequences(df, keys, order).add(_p_=lag(seconds), _i=number())
    rows = rows.over_key(_w=F.min(F.when(candidate, F.col("_i"))))
    late = F.col("_w").isNotNull() & (F.col("_i") >= F.col("_w")) & ~((F.col("_i") == F.col("_w")) & (s == DAY))
    rows = rows.each(lambda d: d.withColumn("v", F.when(late, s + DAY).otherwise(s).cast("bigint")).withColumn("wrapped", late).drop("_p_", "_i", "_w"))
    rows = rows.add(_before=lag("v"))
    return rows.rows().withColumn("back", F.coalesce(F.col("v") < F.col("_before"), F.lit(False))).drop("_before")


def direction(df: DataFrame, keys: list[str], row: list[str], value: str, side: list[str] | None = None) -> DataFrame:
    """(keys, down, up, direction): falls of the value in row order and in reversed row order (`side` runs forwards both ways).

    Fewer falls win; an even tie of no falls is 1 (down); a tie of some is null.
    """
    ways = {"_d": [F.col(c).asc() for c in [*row, *(side or [])]], "_u": [*[F.col(c).desc() for c in row], *[F.col(c).asc() for c in side or []]]}
    short, long, n = split_long(df.where(F.col(value).isNotNull()), keys)
    falls = short.select(*keys, *[(F.col(value) < F.lag(value).over(Window.partitionBy(*keys).orderBy(*by))).alias(way) for way, by in ways.items()])
    for way, by in ways.items() if long is not None else ():
        far = Sequences(keys, by, short.where("false"), ranged(long, keys, by, n)).add(_b=lag(value)).rows()
        falls = falls.unionByName(far.select(*keys, *[((F.col(value) < F.col("_b")) if w == way else F.lit(False)).alias(w) for w in ways]))
    out = falls.groupBy(*keys).agg(F.count_if("_d").alias("down"), F.count_if("_u").alias("up"))
    return out.withColumn("direction", F.when(F.col("down") < F.col("up"), 1).when(F.col("up") < F.col("down"), -1).when(F.col("down") == 0, 1))


def isolated_gaps(df: DataFrame, keys: list[str], order: list[str], served: Column) -> DataFrame:
    """Unserved rows whose both neighbours are served (a longer gap is none)."""
    rows = sequences(df.withColumn("_s", served), keys, order).add(_b=lag("_s"), _a=lead("_s"))
    return rows.rows().where("not _s and _b and _a").drop("_s", "_b", "_a")


def legs(df: DataFrame, keys: list[str], order: list[str], name: str, leaves: Column, arrives: Column) -> DataFrame:
    """df with `from_`, `to_` and `dt` to the next row of its key; last rows and negative times drop out."""
    out = sequences(df, keys, order).add(to_=lead(name), _at=lead(arrives)).rows()
    out = out.withColumn("from_", F.col(name)).withColumn("dt", F.col("_at") - leaves).drop("_at")
    return out.where("to_ is not null and from_ <> '' and to_ <> '' and dt >= 0")


def carry_forward(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """The last non-null value at or before each row."""
    return sequences(df.withColumn("_v", value), keys, order).add(**{out: running_last("_v")}).rows().drop("_v")


def islands(df: DataFrame, keys: list[str], order: list[str], member: Column, min_size: int = 1) -> DataFrame:
    """(keys, first, last, size) of runs of consecutive member rows, by position in the key."""
    rows = sequences(df.withColumn("_m", F.coalesce(member, F.lit(False))), keys, order).add(_i=number(), _k=running_sum(F.when(F.col("_m"), 1)))
    rows = rows.rows().where("_m").withColumn("_g", F.col("_i") - F.col("_k"))
    out = rows.groupBy(*keys, "_g").agg(F.min("_i").alias("first"), F.max("_i").alias("last"), F.count("*").alias("size"))
    return out.where(F.col("size") >= min_size).drop("_g")


def running_groups(df: DataFrame, keys: list[str], order: list[str], low: Column, high: Column, out: str = "grp") -> DataFrame:
    """Rows joined to the open group while their `low` is under the largest `high` so far; groups number from 1."""
    rows = sequences(df.withColumn("_lo", low).withColumn("_hi", high), keys, order).add(_upto=running_max("_hi"))
    rows = rows.add(_m=lag("_upto"))
    rows = rows.each(lambda d: d.withColumn("_n", F.when(F.col("_m").isNull() | (F.col("_lo") >= F.col("_m")), 1).otherwise(0)))
    return rows.add(**{out: running_sum("_n")}).rows().drop("_lo", "_hi", "_upto", "_m", "_n")


def trailing(df: DataFrame, keys: list[str], order: list[str], blank: Column) -> DataFrame:
    """The blank rows at the end of each key."""
    rows = sequences(df.withColumn("_b", blank), keys, order).add(_i=number()).over_key(_l=F.max(F.when(~F.col("_b"), F.col("_i"))))
    return rows.rows().where(F.col("_i") > F.coalesce("_l", F.lit(0))).drop("_i", "_b", "_l")


def zones(df: DataFrame, keys: list[str], order: list[str], value: str, jump: float) -> DataFrame:
    """(keys, pos, value, zone): a new zone where a step exceeds `jump` or turns against the zone's direction, which a break forgets.

    An unknown value stays in the zone. After a jump, let the steps up and down form runs of one direction each. A run's
    first step breaks unless it is the first of all or the run before has one step and broke itself. So of runs
    that follow a longer one (or the first) directly every second breaks while they are of one step, which counting says
    without a walk: a run breaks if the number of runs since the last such one is odd.
    """
    own = df.select(*keys, *[c for c in order if c not in keys], F.col(value).cast("double").alias("_x"))
    known = F.when(F.col("_x").isNotNull() & ~F.isnan("_x"), F.col("_x"))
    rows = sequences(own.withColumn("_v", known), keys, order).add(pos=number(), _last=running_last("_v"))
    rows = rows.add(_b=lag("_last"))
    step = F.col("_v") - F.col("_b")
    rows = rows.each(lambda d: d.withColumn("_j", F.coalesce(F.abs(step) > jump, F.lit(False))).withColumn("_t", F.when(~F.col("_j") & (step != 0), F.signum(step))))
    rows = rows.add(_seg=running_sum(F.col("_j").cast("int")))
    mine = lambda d: d.withColumn("_st", F.when(F.col("_t").isNotNull(), F.struct("_seg", "_t")))
    rows = rows.each(mine).add(_sofar=running_last("_st"), _next=next_known("_st")).add(_prev=lag("_sofar"))
    inside = lambda other: F.coalesce(F.col(f"{other}._seg") == F.col("_seg"), F.lit(False))
    differs = lambda other: ~(inside(other) & (F.col(f"{other}._t") == F.col("_t")))
    turns = F.col("_t").isNotNull()
    rows = rows.each(lambda d: d.withColumn("_new", turns & differs("_prev")).withColumn("_first", turns & ~inside("_prev")).withColumn("_end", turns & differs("_next")))
    rows = rows.add(_run=running_sum(F.col("_new").cast("int")))
    # the runs after which the next one breaks for certain: the first of a segment, and those of more than one step
    sure = F.when(F.col("_first") | (turns & ~(F.col("_new") & F.col("_end"))), F.col("_run"))
    rows = rows.each(lambda d: d.withColumn("_sure", sure)).add(_known=running_last("_sure")).add(_since=lag("_known"))
    breaks = F.col("_new") & ~F.col("_first") & ((F.col("_run") - F.col("_since")) % 2 == 1)
    rows = rows.each(lambda d: d.withColumn("_z", (F.col("_j") | F.coalesce(breaks, F.lit(False))).cast("int"))).add(zone=running_sum("_z"))
    return rows.rows().select(*keys, F.col("pos").cast("int").alias("pos"), F.col("_x").alias(value), F.col("zone").cast("int").alias("zone"))
