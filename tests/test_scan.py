"""Long sequences cut into ranges give what whole ones give."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import findings, scan, sequence
from tidegauge.sources import sinks

KEYS, ORDER = ["k"], ["t", "i"]


@pytest.fixture(scope="module")
def rows(spark):
    """One key with most rows, some small ones and a null one; ties in t, nulls in x."""
    rng = random.Random(2)
    made = []
    for i in range(700):
        k = "hot" if rng.random() < 0.8 else rng.choice(["a", "b", None])
        made.append((k, rng.randrange(300), i, rng.choice([None, *range(12)]), rng.random() < 0.4, rng.randrange(0, 86401, 3600)))
    return spark.createDataFrame(made, "k string, t int, i int, x int, m boolean, s bigint").repartition(3)


OPERATORS = {
    "clock": lambda d: sequence.clock(d, KEYS, ORDER, "s"),
    "direction": lambda d: sequence.direction(d, KEYS, ["t"], "x", ["i"]),
    "isolated_gaps": lambda d: sequence.isolated_gaps(d, KEYS, ORDER, F.col("m")),
    "legs": lambda d: sequence.legs(d, KEYS, ORDER, "k", F.col("s"), F.col("s")),
    "carry_forward": lambda d: sequence.carry_forward(d, KEYS, ORDER, F.when(F.col("m"), F.col("x")), "c"),
    "islands": lambda d: sequence.islands(d, KEYS, ORDER, F.col("m"), 2),
    "running_groups": lambda d: sequence.running_groups(d, KEYS, ORDER, F.col("t"), F.col("t") + F.col("x")),
    "trailing": lambda d: sequence.trailing(d, KEYS, ORDER, F.col("x").isNull() | F.col("m") | (F.col("t") > 280)),
    "zones": lambda d: sequence.zones(d, KEYS, ORDER, "x", 6),
    "zones of steps": lambda d: sequence.zones(d, KEYS, ORDER, "x", 100),
    "merge_runs": lambda d: findings.merge_runs(d.where("m"), KEYS, "t", "t", ties=["i"]),
    "head_spans": lambda d: sinks.head_spans(d.withColumn("c", F.col("t") * 1000 + F.col("i")), KEYS, "c", "k"),
}


def taken(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_ranges_change_nothing(rows, monkeypatch, name):
    want = taken(OPERATORS[name](rows))
    monkeypatch.setattr(scan, "RANGE_ROWS", 40)
    made = OPERATORS[name](rows)
    assert taken(made) == want
    assert want


def test_no_task_reads_more_than_ranges(rows, monkeypatch):
    monkeypatch.setattr(scan, "RANGE_ROWS", 40)
    found = scan.sequences(rows, KEYS, ORDER)
    sizes = [r["count"] for r in found.long.groupBy("k", "__p").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 160
    assert {r.k for r in found.long.select("k").distinct().collect()} == {"hot", "a", "b", None} - {r.k for r in found.short.select("k").distinct().collect()}
    plan = found.add(n=scan.number()).rows()._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(k#" in plan and "__p#" in plan


def test_zones_like_a_walk(rows):
    by_key: dict = {}
    for r in rows.orderBy("t", "i").collect():
        by_key.setdefault(r.k, []).append(r.x)
    for jump in (3, 100):
        want = []
        for k, xs in by_key.items():
            prev, way, zone = None, 0, 0
            for pos, x in enumerate(xs, 1):
                if x is not None:
                    turn = 0 if prev is None else (x > prev) - (x < prev)
                    if prev is not None and (abs(x - prev) > jump or turn * way < 0):
                        zone, way = zone + 1, 0
                    elif turn:
                        way = turn
                    prev = x
                want.append((k, pos, x, zone))
        got = [(r.k, r.pos, None if r.x is None else int(r.x), r.zone) for r in sequence.zones(rows, KEYS, ORDER, "x", jump).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_empty(spark, monkeypatch):
    none = spark.createDataFrame([], "k string, t int, i int, x int, m boolean, s bigint")
    for run in OPERATORS.values():
        assert run(none).collect() == []
