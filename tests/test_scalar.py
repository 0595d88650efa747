"""Cell functions on hand-made values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import scalar


def run(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clean_cell(spark):
    given = [" 10.05 ", "**10.05**", "_x_", "\\*", "9.05", "9.05,5", "**", "*a* b", "\t a ", ""]
    assert run(spark, scalar.clean_cell, given) == ["10.05", "10.05", "x", "*", "09.05", "09.05,5", "**", "*a* b", "a", ""]


def test_time_seconds(spark):
    given = ["10.05", "10.05,5", "24.00", "24.01", "25.00", "10.60", "9.05", "x", "", "10,05", "24.00,5", None]
    assert run(spark, scalar.time_seconds, given) == [36300, 36330, 86400, None, None, None, 32700, None, None, None, 86430, None]


def test_cell_kind(spark):
    assert run(spark, scalar.cell_kind, ["", "—", "-", "10.05", "1O.05", "note", "10.60"]) == ["blank", "pass", "pass", "time", "bad", "note", "bad"]


def test_km(spark):
    assert run(spark, scalar.km_tenths, ["0,0", "922.8", "12345,1", "1,23", ""]) == [0, 9228, None, None, None]


def test_clock_text(spark):
    assert run(spark, scalar.hhmm, [0, 36330, 86400 + 60], "bigint") == ["00.00", "10.05,5", "00.01"]
    assert run(spark, scalar.mmss, [0.0, -90.0, 62.5, 63.5], "double") == ["0:00", "-1:30", "1:02", "1:04"]


def test_readings_and_variants(spark):
    assert run(spark, scalar.readings, ["⟨a ¦ ∅⟩", "x"]) == [["a", ""], ["x"]]
    assert run(spark, scalar.variants, [["a", ""]], "array<string>") == ["⟨a ¦ ∅⟩"]


@pytest.mark.parametrize("line,noise", [("", True), ("12", True), ("1234", False), ("7 — 8", True), ("12 *", True), ("text", False)])
def test_noise(spark, line, noise):
    assert run(spark, scalar.is_noise, [line]) == [noise]


def test_clean_cell_and_tokens(spark):
    cases = {
        "7.10": "07.10", "7.10 8.20": "07.10 08.20", "1,25": "1,25", "7.16,5": "07.16,5", "О/п. 56 км": "О/п. 56 км", "**7.45**": "07.45", "6609*/6620*": "6609*/6620*", "\\*x": "*x", " __Огре__ ": "Огре",
        "12.05": "12.05", "\\*\\*": "**", "**": "**", "6301**": "6301**", "x7.10": "x7.10",
    }
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = {r.c: (r.padded, r.kept) for r in df.select("c", scalar.clean_cell(F.col("c")).alias("padded"), scalar.clean_cell(F.col("c"), pad_time=False).alias("kept")).collect()}
    assert {c: p for c, (p, _) in got.items()} == cases and got["7.10"][1] == "7.10" and got["**7.45**"][1] == "7.45"
    words = spark.createDataFrame([("Блок- пост 856 км",), ("О/п. X.Y",), ("",)], "c string").select(scalar.tokens(F.col("c")).alias("t")).collect()
    assert [[tuple(x) for x in r.t] for r in words] == [[("", "Блок"), ("- ", "пост"), (" ", "856"), (" ", "км")], [("", "О"), ("/", "п."), (" ", "X.Y")], []]
    marks = spark.createDataFrame([("6305*",), ("6320** Д",), ("6533 Д*",), ("6870 ДР*",), ("a*",), ("_b",), ("6305***",), ("plain",)], "c string")
    odd = {r.c for r in marks.where(scalar.stray_markup(F.col("c"))).collect()}
    assert odd == {"a*", "_b", "6305***"}
    n = spark.createDataFrame([(0.25, 1234.5), (0.35, 2.5)], "x double, y double")
    assert [tuple(r) for r in n.select(scalar.fixed_decimals(F.col("x"), 1), scalar.fixed_decimals(F.col("y"), 0)).collect()] == [("0.2", "1234"), ("0.3", "2")]


def test_strip_is_linear_and_takes_all_white_space(spark):
    """A stretch of blanks inside a text costs no more than its length."""
    import time

    white = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and chr(c).isspace() and not 0x1C <= c < 0x20]
    given = [f"{c}a{c}b{c}{c}" for c in white] + ["\x1ca\x1f", "᠎a​", "".join(white), "", None]
    assert run(spark, scalar.strip, given) == [f"a{c}b" for c in white] + ["\x1ca\x1f", "᠎a​", "", "", None]
    assert sorted(white) == sorted(scalar.WHITE)
    df = spark.range(1).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), F.lit(300_000)), F.lit("b")).alias("v"))
    begun = time.monotonic()
    assert df.select(F.length(scalar.strip(F.concat("v", F.col("v")))).alias("n")).first().n == 600_004
    assert time.monotonic() - begun < 10
