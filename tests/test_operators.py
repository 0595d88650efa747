"""Operators on hand-made rows: edges that the driver's tables do not hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.operators import consistency, findings, fuzzy, sequence, stats, vote


def test_deviation_without_mad(spark):
    df = spark.createDataFrame([(2.0, 1.0, 0.0), (1.0, 1.0, 0.0), (0.0, 0.0, 0.0), (3.0, 0.0, 0.0), (0.5, 1.0, 0.0), (5.0, 1.0, 1.0)], "x double, m double, d double")
    got = [r.o for r in df.select(stats.deviation(F.col("x"), F.col("m"), F.col("d")).alias("o")).collect()]
    assert got == [2.0, 1.0, 0.0, float("inf"), 2.0, 0.6745 * 4]


def test_exact_median_narrows(spark):
    df = spark.range(10001).select((F.col("id") * 7 % 10007).cast("double").alias("x"))
    values = sorted(i * 7 % 10007 for i in range(10001))
    assert stats.group_medians(df.withColumn("k", F.lit(None).cast("string")).unionByName(df.withColumn("k", F.lit("a"))).where("k = 'a'"), ["k"], "x").first().med == values[5000]
    assert stats.exact_median(df, "x") == values[5000]
    assert stats.exact_median(df.where("false"), "x") is None


def test_clock(spark):
    def v(seconds):
        df = spark.createDataFrame([(1, i, s) for i, s in enumerate(seconds)], "k int, i int, s bigint")
        return [(r.v, r.back) for r in sequence.clock(df, ["k"], ["i"], "s").orderBy("i").collect()]

    assert [x for x, _ in v([86280, 210])] == [86280, 86610]
    assert [x for x, _ in v([86400, 210])] == [86400, 86610]
    assert v([57360, 21600]) == [(57360, False), (21600, True)]
    assert v([36660, 36300])[1] == (36300, True)


def test_zone_memory_resets_at_a_break(spark):
    df = spark.createDataFrame([(1, i, float(x)) for i, x in enumerate([10, 20, 15, 25, 30])], "k int, i int, x double")
    assert [r.zone for r in sequence.zones(df, ["k"], ["i"], "x", 60).orderBy("pos").collect()] == [0, 0, 1, 1, 1]


def test_direction(spark):
    df = spark.createDataFrame([("d", 1, 1), ("d", 2, 2), ("u", 1, 2), ("u", 2, 1), ("t", 1, 2), ("t", 2, 1), ("t", 3, 3), ("o", 1, 5)], "k string, r int, v int")
    got = {r.k: r.direction for r in sequence.direction(df, ["k"], ["r"], "v").collect()}
    assert got == {"d": 1, "u": -1, "t": None, "o": 1}


def test_vote_ties_and_extras(spark):
    rows = [(1, 0, "a", False), (1, 1, "b", False), (1, 2, "b", True), (2, 0, "a", False), (2, 1, "", False), (3, 0, "x", False), (3, 1, "x", False)]
    df = spark.createDataFrame(rows, "cell int, run int, v string, extra boolean")
    got = {r.cell: (r.value, r.agreed, r.readings) for r in vote.vote(df, ["cell"], "run", "v", "extra").collect()}
    assert got == {1: ("b", False, "b ¦ a"), 2: ("a", False, "a ¦ ∅"), 3: ("x", True, "x")}


def test_within_distance_equals_brute_force(spark):
    words = ["", "a", "ab", "abc", "abd", "xabc", "abcx", "kitten", "sitting", "mitten", "smitten", "bitter", None]

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    df = spark.createDataFrame([(w,) for w in words], "key string")
    got = {(r.x, r.y): r.d for r in fuzzy.within_distance(df, df, 3).collect()}
    known = [w for w in words if w is not None]
    assert got == {(a, b): lev(a, b) for a in known for b in known if a != b and lev(a, b) <= 3}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101)], "u long, v long")
    got = {r.node: r.component for r in fuzzy.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


def test_collapse_does_not_bridge(spark):
    df = spark.createDataFrame([(1, 1, ["a"]), (1, 2, ["b"]), (1, 3, ["a", "b"]), (1, 4, ["b"]), (1, 5, [])], "k int, seq int, cells array<string>")
    got = sorted(sorted(r.seqs) for r in findings.collapse(df, ["k"], "seq", "cells", seqs=F.collect_list("seq")).collect())
    assert got == [[1, 3, 4], [2], [5]]


def test_runs_of_findings(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 2, 3), (1, 4, 4), (1, 9, 9)], "k int, a int, b int")
    assert [tuple(r) for r in findings.merge_runs(df, ["k"], "a", "b").collect()] == [(1, 1, 4, 3)]


def test_bands_keep_only_one_fit(spark):
    values = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", 5.0), ("z", 99.0)], "k string, v double")
    bands = spark.createDataFrame([("low", 0.0, 5.0), ("high", 5.0, 10.0)], "name string, lo double, hi double")
    assert {r.k: r.band for r in consistency.classify_bands(values, ["k"], "v", bands).collect()} == {"x": "low", "y": None, "z": None}


def test_unmatched_is_null_safe_and_by_subset(spark):
    f = spark.createDataFrame([(1, None, [4], ["a"]), (2, 3, [2, 4], ["b"])], "scan int, folio int, rules array<int>, vals array<string>")
    e = spark.createDataFrame([(1, None, [2, 4], ["a"]), (2, 3, [4], ["b"])], "scan int, folio int, rules array<int>, vals array<string>")
    left, stale = consistency.unmatched(f, e, ["scan", "folio"], "rules", "vals")
    assert [r.scan for r in left.collect()] == [2] and [r.scan for r in stale.collect()] == [2]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k int, i int, s bigint, v string, run int")
    assert sequence.clock(none, ["k"], ["i"], "s").count() == 0
    assert vote.vote(none, ["k"], "run", "v").count() == 0
    assert fuzzy.fuzzy_pairs(none.select(F.col("v").alias("key")), 2, 0.5).count() == 0
    assert stats.global_outliers(none, "s").count() == 0


def test_group_medians_are_exact(spark):
    import statistics

    groups = {"a": [5.0], "b": [1.0, 2.0], "c": [float(i * 37 % 1009) for i in range(1009)], "d": [3.0] * 500 + [4.0] * 500, "e": [float(i) for i in range(100)], "f": [1.0] * 9 + [7.0]}
    df = spark.createDataFrame([(k, x) for k, v in groups.items() for x in v] + [("a", None), ("g", None)], "k string, x double")
    assert {r.k: (r.n, r.med) for r in stats.group_medians(df, ["k"], "x").collect()} == {k: (len(v), statistics.median(v)) for k, v in groups.items()}
