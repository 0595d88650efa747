"""A small book of its own through all plans: from OCR blocks over two runs and their merge to findings."""

from __future__ import annotations

import pytest
from test_books import block, scan

from tidegauge.plans import steps
from tidegauge.sources import runs, sinks

TABLE = "| № поездов | 61 | |\n|---|---|---|\n| Разд. пункты | приб. | отпр. |\n| Рига | | 7.00 |\n| Огре | {0} | 7.31 |\n| Икшкиле | 7.40 | 7.41 |\n| Лиелварде | 8.00 | |"


def book(folder, time):
    scan(folder, 5, [block("header", "№ 61", 10, 10, 100, 30), block("table", TABLE.format(time), 10, 100, 480, 700), block("text", "A note", 520, 100, 900, 120)])
    scan(folder, 6, [block("text", "left", 10, 100, 100, 120), block("table", "| what | is |", 600, 100, 900, 200)])


def test_a_book_from_scans_to_findings(spark, tmp_path):
    path = lambda *p: str(tmp_path.joinpath(*p))
    for n, time in enumerate(("7.30", "7.30", "6.30")):
        book(tmp_path / f"ocr-0{n}", time)
        made = steps.extract_book(spark, path(f"ocr-0{n}"), path(f"run-0{n}"))
        assert (made.status, made.counts) == (0, {"scans": 2, "skipped": 0, "problems": 1, "pages_suburban": 1, "pages_prose": 2, "pages_UNKNOWN": 1})
        assert [r.line.split("|")[2].strip() for r in made.lines.orderBy("n").collect()][2:] == ["unrecognized table shape"]
        sinks.require_finished(spark, path(f"run-0{n}"))
    with pytest.raises(FileExistsError):
        steps.extract_book(spark, path("ocr-00"), path("run-00"))

    merged = steps.merge_book(spark, [path("run-00"), path("run-02")], [], path("merged"))
    assert (merged.status, merged.counts["scans"], merged.counts["disputes"]) == (0, 2, 1)
    text = {r.file: r.text for r in runs.read_texts(spark, path("merged")).collect()}["scan-05.md"]
    assert "⟨07.30 ¦ 06.30⟩" in text

    lines = [r.value for r in spark.read.text(path("merged", "disputes")).collect()]
    (tmp_path / "disputes.txt").write_text("\n".join(sorted(lines, key=lambda t: (t.lstrip("|").strip()[:1].isdigit(), t))) + "\n")
    pruned = steps.prune_book(spark, path("merged"), path("disputes.txt"), path("open"))
    assert (pruned.status, pruned.counts) == (0, {"resolved": 0, "open": 1, "notes": merged.lines.count() - 3, "stray": 0})
    (tmp_path / "merged" / "scan-05.md").write_text(text.replace("⟨07.30 ¦ 06.30⟩", "07.30") + "⟨by hand⟩\n")
    pruned = steps.prune_book(spark, path("merged"), path("disputes.txt"), path("later"))
    assert (pruned.status, pruned.counts["resolved"], pruned.counts["open"], pruned.counts["stray"]) == (1, 1, 0, 1)

    clean, broken = (steps.validate_book(spark, path(f"run-0{n}"), path(f"report-{n}")) for n in (0, 2))
    assert clean.counts["columns"] == broken.counts["columns"] == 1
    assert broken.counts["impossible"] > clean.counts["impossible"] and broken.status == 1
    assert steps.validate_book(spark, path("run-02"), rules=[99]).status == 0
    report = spark.read.text(path("report-2")).count()
    assert report == broken.counts["findings"] + 2 == broken.lines.count()
