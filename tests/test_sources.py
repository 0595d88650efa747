"""Readers, repairs, names and writers on hand-made inputs."""

from __future__ import annotations

import re

import json

from tidegauge.operators import names
from tidegauge.sources import ocr, sinks

W = {"width": 1000, "height": 800, "dpi": 100}


def block(kind, text, x0, y0, x1, y1):
    return {"type": kind, "content": text, "topLeftX": x0, "topLeftY": y0, "bottomRightX": x1, "bottomRightY": y1}


def snake(b):
    names_ = {"topLeftX": "top_left_x", "topLeftY": "top_left_y", "bottomRightX": "bottom_right_x", "bottomRightY": "bottom_right_y"}
    return {names_.get(k, k): v for k, v in b.items()}


BLOCKS = [
    block("header", "left top", 10, 10, 200, 30), block("header", "right of it", 210, 12, 400, 28), block("header", "below", 10, 50, 200, 70),
    block("text", "Alpha\nBeta", 10, 200, 100, 300), block("list", "Gamma", 10, 310, 100, 400), block("table", "| № поездов | 1 | 2 | 3 |", 10, 100, 480, 150),
    block("table", "| 10.05 |", 150, 500, 480, 700), block("footer", "12", 10, 780, 30, 795), block("text", "right page", 600, 200, 900, 300),
]


def test_ocr_layouts_and_repairs(spark, tmp_path):
    a, b = tmp_path / "a" / "pages" / "page-7", tmp_path / "b"
    a.mkdir(parents=True)
    b.mkdir()
    (a / "page-metadata.json").write_text(json.dumps({"index": 1, "dimensions": W, "blocks": BLOCKS}))
    (b / "scan-07.json").write_text(json.dumps({"pages": [{"dimensions": W, "blocks": [snake(x) for x in BLOCKS]}]}))
    x, y = ocr.read_pages(spark, str(tmp_path / "a")), ocr.read_api(spark, str(b))
    assert sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect())) and x.count() == 9
    halves = ocr.split_halves(ocr.drop_noise(x))
    assert {r.half: r.n for r in halves.groupBy("half").agg({"block": "count"}).withColumnRenamed("count(block)", "n").collect()} == {0: 7, 1: 1}
    first = halves.where("half = 0")
    assert [r.text for r in ocr.caption_lines(first, ["scan", "half"]).orderBy("line").collect()] == ["left top · right of it", "below"]
    fused = ocr.fuse_stations(ocr.station_blocks(ocr.header_span(first.where("type <> 'header'"), ["scan", "half"])), ["scan", "half"])
    assert [r.g_rows for r in fused.where("block = 3").collect()] == [[[n, "", "", ""] for n in ("Alpha", "Beta", "Gamma")]]
    assert [r.g_rows for r in fused.where("block = 6").collect()] == [[["10.05", "", "", ""]]]


def test_notations(spark):
    words = [
        "Рига пасс.", "Рига пассажирская", "Линия 5", "Линия 6", "Пост 78 км", "78 км", "79 км", "Парк 5 км", "Парк 7 км", "Огре", "Огра", "Вентспилс-1", "Вентспилс-I", "Вентспилс-2",
        "Б/п. 856 км", "Блок пост 856 км", "Блок- пост 867 км", "О. п. Сигасте", "о. п. Сигасте", "Резекне II", "Тукумс-II", "Б.", "Блок", None,
    ]
    df = spark.createDataFrame([(w,) for w in words], "name string")
    got = {(r.why, r.x, r.y) for r in names.notation_links(df, "name").collect()}
    assert got == {
        ("abbreviation", "Рига пасс.", "Рига пассажирская"), ("number", "Вентспилс-#", "Вентспилс-I"), ("word before a milepost", "# км", "Пост # км"),
        ("abbreviation", "Б/п. # км", "Блок пост # км"), ("abbreviation", "Б/п. # км", "Блок- пост # км"),
    }
    parts = {(r.place, r.key, r.printed) for r in names.notation_parts(df, "name").collect()}
    assert {("front", "оп", "О. п. …"), ("front", "оп", "о. п. …"), ("front", "бп", "Б/п. …"), ("end", "Roman number", "… I…"), ("end", "Roman number", "…-I…"), ("end", "пасс", "… пасс.")} == parts
    found = names.notations(df, "name").collect()
    why = lambda name: {r.why for r in found if r.name == name}
    assert why("О. п. Сигасте") == {"front part printed 2 ways"} and why("Вентспилс-2") == {"number"} and why("79 км") == {"word before a milepost"} and why("Огре") == set()
    groups = {tuple(sorted({r.printed for r in found if r.group == g})) for g in {r.group for r in found if r.why == "abbreviation"}}
    assert ("Б/п. # км", "Блок пост # км", "Блок- пост # км") in groups
    rows = names.set_against(spark.createDataFrame(found)).collect()
    pairs = {(a.name, b.name) for a in rows for b in rows if a.group == b.group and a.printed != b.printed}
    assert ("78 км", "Пост 78 км") in pairs and ("79 км", "Пост 78 км") in pairs and ("78 км", "79 км") not in pairs
    assert {r.name: r.n_against for r in rows if r.printed in ("# км", "Пост # км")} == {"78 км": 1, "79 км": 1, "Пост 78 км": 2}


def test_many_shapes_of_the_same_initials_form_no_pairs(spark):
    """Two thousand names that share their initials, of which one is abbreviated."""
    words = [f"Река{chr(1072 + i // 32 % 32)}{chr(1072 + i % 32)} Север" for i in range(1000)]
    df = spark.createDataFrame([(w,) for w in [*words, "Рекааб. Север", "Р. Юг", "Река Юг"]], "name string")
    links = names.notation_links(df, "name")
    assert {(r.x, r.y) for r in links.collect()} == {("Р. Юг", "Река Юг")}


def test_patterns_meet_names_by_their_text(spark):
    words = ["Рига", "Рига пасс.", "Б. п. Огре", "78 км", "Пост 78 км", "а.б", "", "Рр"]
    asked = ["Рига…", "… пасс.", "# км", "…", "#", "Рр", "а.б", "Пост # км", "…иг…", "нет…"]
    got = {(r.id, r.name) for r in names.match_patterns(spark.createDataFrame([(w,) for w in words], "name string"), list(enumerate(asked))).collect()}
    want = {(i, w) for i, p in enumerate(asked) for w in words if re.match("".join({"…": ".*", "#": r"[\d,]+"}.get(c, re.escape(c)) for c in p) + r"\Z", w)}
    assert got == want and len(want) > 10
    plan = names.match_patterns(spark.createDataFrame([(w,) for w in words], "name string"), list(enumerate(asked)))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_names(spark):
    df = spark.createDataFrame([("РИГА—Валга · Огре.",), ("№ 606 — 12",)], "t string")
    assert [r.name for r in names.route_names(df, "t").collect()] == ["Рига", "Валга", "Огре"]
    df = spark.createDataFrame([("Мая-кова",), ("Маякова",), ("Riga",), ("Парк- депо",), ("Тукумс-II",)], "name string")
    assert [tuple(r) for r in names.hyphen_lookups(df, "name").collect()] == [("Мая-кова", "Мая-кова", "Маякова")]
    got = {(r.name, r.why) for r in names.checks(df, "name").collect()}
    assert got == {
        ("Riga", "letter " + ", ".join(f"{c} (LATIN {k} LETTER {c.upper()})" for c, k in zip("Riga", ("CAPITAL", "SMALL", "SMALL", "SMALL")))),
        ("Парк- депо", "«- » from a line break"), ("Мая-кова", "«-» from a line break: Мая-кова joins into Маякова"),
    }


def test_names_are_collected_by_column(spark):
    text = ["# Рига—Огре", "| № | Разд. пункты |", "|===|===|", "| 1 | Рига |", "| x | ⟨Огре ¦ Огрэ⟩ |", "| Валка—Рига | 12,5 |", "", "| На Ригу | Цесис |", "text", "| Айвиексте | — |", "Рига—Цесис", "Поезд Рига—Цесис"]
    df = spark.createDataFrame([("f", i + 1, t) for i, t in enumerate(text)], "file string, line int, text string")
    assert sorted((r.line, r.name) for r in names.collect_names(df).collect()) == [
        (4, "Рига"), (5, "Огре"), (5, "Огрэ"), (6, "Валка"), (6, "Рига"), (8, "На Ригу"), (8, "Цесис"), (10, "Айвиексте"), (11, "Рига"), (11, "Цесис"),
    ]


def test_golden_score(spark):
    df = spark.createDataFrame([(n,) for n in ("Рига", "Рига", "Ригя", "Мая-кова", "Маякова", "78 км", "Пост 78 км", "Огре", "Б. п. Огре", "Б/п. Огре")], "name string")
    golden = [
        ("mistake", "Ригя", "Рига", "1"), ("artifact", "Мая-кова", "Маякова", "1"), ("mistake", "Ригб", "Рига", "1"), ("mistake", "Огре", "Таллин", "1"), ("form", "# км", "Пост # км", "1"),
        ("form", "Б. п. …", "Б/п. …", "1"), ("form", "Ваг. …", "Вагон …", "1"), ("form", "78 км", "Пост 78 км", "1"), ("mistake", "Огре", "Рига", "1"), ("form", "Огре…", "Рига…", "1"),
    ]
    got = [(r.got, r.result) for r in names.golden_score(df, golden, 2, 0.5).orderBy("line").collect()]
    assert got == [
        (1, "found at d1"), (1, "found at d1; flagged by checks"), (0, "MISS form not in dir"), (1, "MISS target not printed"), (1, "found by notations (1 names ~ 1 names)"),
        (1, "found by notations (1 names ~ 1 names)"), (0, "MISS form not in dir"), (1, "found by notations"), (1, "MISS d4, ratio 1.00"), (1, "MISS notation, 1 of 1 names not set against the target: Огре"),
    ]
    assert {r.outcome: r.n for r in names.golden_tally(names.golden_score(df, golden, 2, 0.5)).collect()} == {"found": 5, "MISS": 5}
    pairs = names.pair_levels(df, "name", 2, 0.5)
    assert {(r.x, r.y, r.d) for r in pairs.collect()} == {("Рига", "Ригя", 1), ("Мая-кова", "Маякова", 1), ("Б. п. Огре", "Б/п. Огре", 2)}
    assert [(r.x, r.y) for r in names.unexplained(pairs, golden[1:2]).orderBy("x").collect()] == [("Б. п. Огре", "Б/п. Огре"), ("Рига", "Ригя")]


def test_cell_ranges_and_head_spans(spark):
    df = spark.createDataFrame([(1, 11, 5), (1, 12, 5), (1, 13, 5), (1, 12, 2), (1, 20, 5)], "k int, r int, c int")
    assert sinks.cell_ranges(df, ["k"], "r", "c").first().ranges == "r11–13c5 r12c2 r20c5"
    head = spark.createDataFrame([(1, 0, "A"), (1, 1, ""), (1, 2, "B"), (1, 3, ""), (1, 4, "")], "k int, c int, t string")
    assert [(r.first, r.colspan, r.text) for r in sinks.head_spans(head, ["k"], "c", "t").orderBy("first").collect()] == [(0, 2, "A"), (2, 3, "B")]


def test_finished_folder(spark, tmp_path):
    folder = str(tmp_path / "out-01")
    assert not sinks.finished(spark, folder)
    sinks.finish(spark, folder, source="x")
    assert sinks.finished(spark, folder)
