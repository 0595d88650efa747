"""Any table as the aligned lines of a report, in two passes: widths by aggregation, lines by their numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.consistency import number_rows
from tidegauge.sources.shared import stage


def numbered_lines(rows: DataFrame, n: str, head: list[str], cells: list[str | Column]) -> DataFrame:
    """(n, line) of rows that have their number: an aligned table, its head at -1 and a rule of = at 0; no rows for no rows. Null cells are blank.

    Only the widths, one row, are sent to all tasks; the lines are made where the rows are.
    """
    text = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")).alias(f"c{i}") for i, c in enumerate(cells)]
    shown = stage(rows.select(F.col(n).cast("bigint").alias("n"), *text), "report")
    wide = shown.agg(*[F.greatest(F.max(F.length(f"c{i}")), F.lit(len(h))).alias(f"w{i}") for i, h in enumerate(head)], F.count("*").alias("rows"))  # one row
    pad = lambda c, i: F.rpad(c, F.col(f"w{i}"), " ")
    ends = lambda parts: F.concat(F.lit("| "), F.concat_ws(" | ", *parts), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.concat_ws("|", *[F.repeat(F.lit("="), F.col(f"w{i}") + 2) for i in range(len(head))]), F.lit("|"))
    title = ends([pad(F.lit(h), i) for i, h in enumerate(head)])
    top = wide.where("rows > 0").select("*", F.explode(F.array(F.lit(-1), F.lit(0))).alias("n"))
    first = top.select(F.col("n").cast("bigint").alias("n"), F.when(F.col("n") == -1, title).otherwise(rule).alias("line"))
    body = shown.join(F.broadcast(wide), F.lit(True)).select("n", ends([pad(F.col(f"c{i}"), i) for i in range(len(head))]).alias("line"))
    return first.unionByName(body)


def report_lines(rows: DataFrame, order: list[str | Column], head: list[str], cells: list[str | Column]) -> DataFrame:
    """(n, line) of rows in an order, as numbered_lines; rows are numbered by range partitions and offsets, so no task holds the report."""
    return numbered_lines(number_rows(rows, [F.col(o) if isinstance(o, str) else o for o in order], "__n"), "__n", head, cells)
