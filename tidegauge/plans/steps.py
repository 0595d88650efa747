"""One call for each plan: it reads folders, writes a finished folder, and says what it did in counts and a status."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.plans import extract, merge, timetable
from tidegauge.sources import runs, sinks


@dataclass(frozen=True)
class Step:
    """status: 0, or 1 where a check found something; counts: what was read, written and found; lines: the report as (n, line)."""

    status: int
    counts: dict[str, int]
    lines: DataFrame


def _write_report(lines: DataFrame, folder: str) -> None:
    """The lines of a report as text, in order over the parts of a folder."""
    lines.orderBy("n").select("line").write.text(folder)


def extract_book(spark: SparkSession, ocr: str, dest: str, mode: str = "errorifexists") -> Step:
    """Scan files of an OCR run, and the table of what was repaired or dropped on the way, in dest/problems."""
    texts, problems, shapes = extract.extract(extract.read_ocr(spark, ocr))
    written, skipped = sinks.write_texts(texts, dest, mode)
    lines = extract.problem_table(problems)
    _write_report(lines, f"{dest}/problems")
    counts = {"scans": written, "skipped": skipped, "problems": problems.count()} | {f"pages_{r.shape}": r.n for r in extract.shape_tally(shapes).collect()}  # a handful of shapes
    sinks.finish(spark, dest, **counts)
    return Step(0, counts, lines)


def merge_book(spark: SparkSession, voters: list[str], extras: list[str], dest: str) -> Step:
    """The merge of finished or hand-made folders of scan files, and the table of what they dispute, in dest/disputes."""
    merged, disputes = merge.merge_runs(merge.read_runs(spark, voters, extras))
    written, _ = sinks.write_texts(merged, dest)
    lines = merge.dispute_table(disputes)
    _write_report(lines, f"{dest}/disputes")
    n = merged.agg(F.coalesce(F.sum("n_alternatives"), F.lit(0)).alias("a")).first().a
    counts = {"scans": written, "disputes": disputes.where("where <> 'layout'").count(), "alternatives": int(n)}
    sinks.finish(spark, dest, **counts)
    return Step(0, counts, lines)


def prune_book(spark: SparkSession, folder: str, listed: str, dest: str) -> Step:
    """The disputes of a list that the pages of a folder still show, as a new list in dest; status 1 if marks are on pages that no dispute accounts for."""
    disputes = runs.read_disputes(spark, listed)
    kept, stray = merge.prune(disputes, runs.page_texts(runs.page_sections(runs.read_texts(spark, folder)), ["scan"]))
    lines = merge.dispute_table(kept, "line")
    _write_report(lines, dest)
    open_, notes = kept.where("where <> 'layout'").count(), kept.where("where = 'layout'").count()
    marks = stray.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    counts = {"resolved": disputes.count() - open_ - notes, "open": open_, "notes": notes, "stray": int(marks)}
    return Step(int(marks != 0), counts, lines)


def validate_book(spark: SparkSession, src: str, dest: str | None = None, ignores: str | None = None, rules: list[int] | None = None, impossible: bool = False, limit: int = 0) -> Step:
    """The findings on a folder of scan files, less what the list `ignores` excuses, as a report in dest; status 1 if there are any. limit shows the first so many."""
    columns, found = timetable.validate(spark, src)
    every = found.count()
    ignored = 0
    if ignores:
        found = timetable.apply_ignores(found, runs.read_ignores(spark, ignores))
        ignored = every - found.where("shape <> 'ignore'").count()
    found = timetable.select_findings(found, rules, impossible)
    lines = timetable.findings_lines(found, limit)
    if dest:
        _write_report(lines, dest)
    n = found.agg(F.count("*").alias("n"), F.count_if(F.col("severity") == 0).alias("hard")).first()
    return Step(int(n.n > 0), {"columns": columns.count(), "findings": n.n, "impossible": n.hard, "ignored": ignored}, lines)
