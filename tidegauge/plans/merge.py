"""Several readings of one book merged into one: pages of the same layout cell by cell, by vote, and the disputes that remain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions.scalar import cite
from tidegauge.operators import tables, vote
from tidegauge.operators.report import report_lines
from tidegauge.sources import runs
from tidegauge.sources.shared import stage

# The marks and notes that a merge leaves.
UNKNOWN = "UNKNOWN"
PAGE = ["scan", "k"]
PART = [*PAGE, "signature"]


def read_runs(spark: SparkSession, voters: list[str], extras: list[str]) -> DataFrame:
    """(file, text, run, ord, extra): the files of all folders; a run is named by what follows the last - of its folder, or by its whole path where two would share a name.

    A file that fewer than two voters have fails.
    """
    if len(voters) < 2:
        raise ValueError("two voting folders at least")
    short = {p: p.rstrip("/").rsplit("/", 1)[-1].rsplit("-", 1)[-1] for p in [*voters, *extras]}
    if len(set(short.values())) != len(short):
        short = {p: p for p in short}
    out = None
    for i, p in enumerate([*voters, *extras]):
        one = runs.read_texts(spark, p).select("file", "text", F.lit(short[p]).alias("run"), F.lit(i).alias("ord"), F.lit(i >= len(voters)).alias("extra"))
        out = one if out is None else out.unionByName(one)
    # files of extras alone are not wanted; those of one voter are an error
    n = out.groupBy("file").agg(F.count_if(~F.col("extra")).alias("n")).where("n > 0")
    n = n.select("file", F.when(F.col("n") >= 2, F.col("n")).otherwise(F.raise_error(F.concat("file", F.lit(": in fewer than two voting folders")))).alias("n"))
    return out.join(n, "file").where("n >= 2").drop("n")


def merge_runs(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged, disputes): (file, scan, text, n_alternatives), and (scan, page, where, readings, seq), from (file, text, run, ord, extra).

    Runs whose number of pages is not that of most voters sit a scan out. A page is merged if two
    voters or more share a layout that no other ties with and whose shape is known (or nobody
    disagrees); else each layout is merged on its own and given as an alternative. Readings are grouped by cell:
    runs are never joined with one another.
    """
    sections = runs.page_sections(files).withColumn("n_pages", F.size("pages"))
    most = vote.count_majority(sections.where("not extra"), ["file"], "ord", "n_pages")
    sections = stage(sections.join(most, ["file", "n_pages"]), "sections")
    blocks = stage(runs.page_blocks(sections, ["scan", "run", "ord", "extra"]), "blocks")
    shape_of = F.concat(F.lit("table:"), F.concat_ws(":", "t_width", "t_head", F.array_join(F.transform("t_items", lambda r: F.substring(F.when(r["kind"] == "band", "band").otherwise("row"), 1, 1)), "")))
    sign = F.when(F.col("is_table"), shape_of).otherwise("text")
    signed = blocks.groupBy("scan", "k", "ord").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", sign.alias("s")))), lambda x: x["s"]), "|").alias("signature"))
    pages = sections.select("scan", "run", "ord", "extra", "shapes", F.posexplode("pages").alias("k", "p")).select("scan", "run", "ord", "extra", "k", "p.page", F.get("shapes", F.col("k")).alias("shape"))
    pages = stage(pages.join(signed, ["scan", "k", "ord"], "left").fillna("", ["signature"]), "pages")

    # layouts of a page: most voters first, then the first run's
    groups = pages.groupBy(*PART).agg(
        F.count_if(~F.col("extra")).alias("votes"), F.min("ord").alias("first"), F.min_by("shape", "ord").alias("shape"), F.min_by("page", F.when(~F.col("extra"), F.col("ord"))).alias("page"),
        F.min(F.when(~F.col("extra"), F.struct("ord", "shape")))["shape"].alias("voted_shape"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "run"))), lambda r: r["run"]), ", ").alias("who"),
    )
    w = Window.partitionBy(*PAGE).orderBy(F.col("votes").desc(), "first")
    groups = groups.withColumn("rank", F.row_number().over(w)).withColumn("next", F.lead("votes").over(w)).withColumn("n", F.count("*").over(Window.partitionBy(*PAGE)))
    good = (F.col("votes") >= 2) & ~F.coalesce(F.col("next") == F.col("votes"), F.lit(False)) & ((F.col("voted_shape") != UNKNOWN) | (F.col("n") == 1))
    groups = groups.withColumn("merged", F.max(F.when(F.col("rank") == 1, good)).over(Window.partitionBy(*PAGE)))
    groups = stage(groups, "layouts")
    chosen = groups.where("not merged or rank = 1").select(*PART, "rank", "votes", "merged")
    own = pages.join(chosen, PART).select("scan", "k", "ord", "signature", "rank", (F.col("extra") & (F.col("votes") > 0)).alias("extra"))
    own = stage(blocks.drop("extra", "page").join(own, ["scan", "k", "ord"]), "chosen")

    unit = [*PART, "rank", "b"]
    base = own.groupBy(*unit).agg(F.min(F.when(~F.col("extra"), F.struct("ord", "is_table", "t_items", "t_width", "t_head"))).alias("o"), F.min(F.size(F.split("text", "\n"))).alias("lo"), F.max(F.size(F.split("text", "\n"))).alias("hi"))
    base = stage(base.select(*unit, "o.is_table", "o.t_items", "o.t_width", "o.t_head", (F.col("lo") == F.col("hi")).alias("same_lines")), "bases")
    own = own.drop("is_table", "t_items", "t_width", "t_head").join(base.select(*unit, "is_table", "same_lines"), unit).join(blocks.select("scan", "k", "ord", "b", "t_items"), ["scan", "k", "ord", "b"])
    cells = own.where("is_table").select(*unit, "run", "ord", "extra", F.posexplode("t_items").alias("i", "r"))
    cells = cells.select(*unit, "run", "ord", "extra", "i", F.posexplode(F.when(F.col("r.kind") == "band", F.slice("r.cells", 1, 1)).otherwise(F.col("r.cells"))).alias("c", "v"))
    lines = own.where("not is_table and same_lines").select(*unit, "run", "ord", "extra", F.posexplode(F.split("text", "\n")).alias("i", "v")).withColumn("c", F.lit(-1))
    voted = vote.vote(cells.unionByName(lines), [*unit, "i", "c"], "ord", "v", "extra", "run")
    voted = stage(voted.withColumn("v", F.when(F.col("agreed"), F.col("value")).otherwise(cite(F.col("readings")))).select(*unit, "i", "c", "v", "agreed", "detail"), "voted")

    # back to blocks
    rows = voted.where("c >= 0").groupBy(*unit, "i").agg(F.transform(F.array_sort(F.collect_list(F.struct("c", "v"))), lambda x: x["v"]).alias("cells"))
    whole = rows.groupBy(*unit).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "cells"))), lambda x: x["cells"]).alias("cells")).join(base.select(*unit, "t_items", "t_width", "t_head"), unit)
    whole = whole.withColumn("rows", F.transform("cells", lambda c, i: F.struct(F.get("t_items", i)["kind"].alias("kind"), c.alias("cells"))))
    made = tables.table_text(whole, "rows", "t_width", "t_head", "part").select(*unit, "part")
    texts = voted.where("c < 0").groupBy(*unit).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]), "\n").alias("part"))
    split = own.where("not is_table and not same_lines").groupBy(*unit, "text").agg(F.min(F.struct("extra", "ord")).alias("first"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("extra", "ord", "run"))), lambda r: r["run"]), ", ").alias("who"))
    split = split.withColumn("mark", F.concat(F.lit("⟨text from "), F.col("who"), F.lit("⟩\n"), F.col("text"))).withColumn("note", F.concat(F.size(F.split("text", "\n")).cast("string"), F.lit(" lines ("), F.col("who"), F.lit(")")))
    listed = lambda c, sep: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", c))), lambda x: x[c]), sep)
    split = stage(split.groupBy(*unit).agg(listed("mark", "\n\n").alias("part"), listed("note", "; ").alias("detail")), "split")
    parts = made.unionByName(texts).unionByName(split.select(*unit, "part"))
    alone = groups.where("not merged").select(*PART, "rank", F.lit(-1).alias("b"), F.concat(F.lit("⟨alternative from "), F.col("who"), F.lit(" ("), F.col("shape"), F.lit(")⟩")).alias("part"))
    body = parts.unionByName(alone).groupBy(*PAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "b", "part"))), lambda x: F.concat(x["part"], F.lit("\n"))), "\n").alias("body"))
    page = groups.where("rank = 1").select(*PAGE, "page", "merged", F.when(F.col("merged"), F.col("voted_shape")).otherwise(UNKNOWN).alias("shape")).join(body, PAGE, "left")
    text = F.concat(F.lit("## page"), F.when(F.col("page") == "", "").otherwise(F.concat(F.lit(" "), F.col("page"))), F.lit("\n\n"), F.coalesce("body", F.lit("")))
    scans = page.groupBy("scan").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", text.alias("t")))), lambda x: x["t"]), "\n").alias("body"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "shape"))), lambda x: x["shape"]), ", ").alias("shapes"), F.count_if(~F.col("merged")).alias("n_alternatives"),
    )
    heads = sections.where("not extra").groupBy("file", "scan").agg(F.min_by("head", "ord").alias("head"))
    merged = heads.join(scans, "scan").select("file", "scan", F.concat(F.regexp_replace("head", r"(?m)^shapes:.*$", F.concat(F.lit("shapes: ["), F.col("shapes"), F.lit("]"))), F.lit("\n\n"), F.col("body")).alias("text"), "n_alternatives")
    return merged, _disputes(groups, base, voted, split)


def _disputes(groups: DataFrame, base: DataFrame, voted: DataFrame, split: DataFrame) -> DataFrame:
    """(scan, page, where, readings, seq): what was outvoted, given as alternatives, or read in several ways, in page order."""
    unit = [*PART, "rank", "b"]
    names = groups.groupBy(*PAGE).agg(
        F.max("page").alias("page"), F.first("merged").alias("merged"), F.transform(F.array_sort(F.collect_list(F.struct("rank", "who"))), lambda g: g["who"]).alias("who")
    )
    page = groups.where("rank = 1").select(*PAGE, "page")
    names = names.drop("page").join(page, PAGE)
    left = F.concat(F.lit("outvoted, not merged: "), F.array_join(F.slice("who", F.lit(2), F.size("who")), ", "))
    several = F.concat(F.size("who").cast("string"), F.lit(" alternatives: "), F.array_join("who", " / "))
    order = lambda *x: F.array(*[F.col(c).cast("int") if isinstance(c, str) else F.lit(c) for c in x])
    layout = names.where("not merged or size(who) > 1").select("scan", "page", F.lit("layout").alias("where"), F.when(F.col("merged"), left).otherwise(several).alias("readings"), order("k", 0, 0, 0, 0).alias("seq"))
    odd = voted.where("not agreed").join(base.select(*unit, "t_items", "t_head"), unit)
    row = F.get("t_items", F.col("i"))
    heads = F.filter(F.slice("t_items", F.lit(1), F.col("t_head")), lambda r: r["kind"] != "band")
    # the train of a column: the nearest head cell at it or left of it, the first column aside
    left_of = F.filter(F.reverse(F.slice(F.get(heads, F.lit(0))["cells"], F.lit(2), F.greatest(F.col("c"), F.lit(0)))), lambda t: t != "")
    tail = F.regexp_replace(F.concat(F.lit(" · "), F.get(row["cells"], F.lit(0)), F.lit(" · "), F.coalesce(F.get(left_of, F.lit(0)), F.lit(""))), r"[ ·]+\z", "")
    place = F.concat(F.lit("row "), (F.col("i") + 1).cast("string"), F.lit(" col "), (F.col("c") + 1).cast("string"), F.when(F.col("i") >= F.col("t_head"), tail).otherwise(""))
    n = (F.col("b") + 1).cast("string")
    where = (
        F.when(F.col("c") < 0, F.concat(F.lit("text block "), n, F.lit(", line "), (F.col("i") + 1).cast("string")))
        .when(row["kind"] == "band", F.concat(F.lit("table "), n, F.lit(", band, row "), (F.col("i") + 1).cast("string")))
        .otherwise(F.concat(F.lit("table "), n, F.lit(", "), place))
    )
    cells = odd.join(page, PAGE).select("scan", "page", where.alias("where"), F.col("detail").alias("readings"), order("k", 1, "rank", "b", "i").alias("seq"), "c")
    cells = cells.withColumn("seq", F.concat("seq", F.array(F.col("c").cast("int")))).drop("c")
    texts = split.join(page, PAGE).select("scan", "page", F.concat(F.lit("text block "), n).alias("where"), F.col("detail").alias("readings"), order("k", 1, "rank", "b", 0).alias("seq"))
    return layout.unionByName(cells).unionByName(texts)


def dispute_marks(disputes: DataFrame) -> DataFrame:
    """disputes with `marks`: the marks each row left on its page, rebuilt from its readings; none for a note."""
    groups = F.transform(F.split("readings", "; "), lambda g: F.struct(F.regexp_replace(g, r"(?s) \([^(]*\z", "").alias("value"), F.regexp_extract(g, r"(?s) \(([^(]*)\z", 1).alias("who")))
    several = F.transform(F.split(F.regexp_extract("readings", r"(?s)\A[^:]*: (.*)\z", 1), " / "), lambda r: F.concat(F.lit("⟨alternative from "), F.trim(r), F.lit(" (")))
    none = F.array().cast("array<string>")
    marks = (
        F.when(F.col("where") == "layout", F.when(F.contains("readings", F.lit(" alternatives: ")), several).otherwise(none))
        .when(F.contains("readings", F.lit(" lines (")), F.transform(groups, lambda g: F.concat(F.lit("⟨text from "), F.regexp_replace(g["who"], r"\)\z", ""), F.lit("⟩"))))
        .otherwise(F.array(cite(F.array_join(F.transform(groups, lambda g: g["value"]), " ¦ "))))
    )
    return disputes.withColumn("marks", marks)


def prune(disputes: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(disputes whose marks are still on their page, (scan, n) marks on pages that no kept row accounts for).

    disputes: (scan, page, where, readings, line); pages: (scan, page, text), of equal page names the last. Notes stay. A mark that
    is printed k times backs the first k rows that left it; a row with several marks stays while one of them is
    backed, which for the few such rows (alternatives) is decided by their first rank on any mark.
    """
    from tidegauge.operators.vote import prune as backed

    marked = stage(dispute_marks(disputes), "marked")
    claims = marked.where(F.size("marks") > 0).select("scan", "page", "line", F.explode("marks").alias("mark"))
    asked = claims.select("scan", "page", "mark").distinct()
    # of pages that share a name the last counts, as an index by name keeps it
    found = asked.join(pages, ["scan", "page"]).withColumn("n", ((F.length("text") - F.length(F.replace("text", F.col("mark"), F.lit("")))) / F.length("mark")).cast("int"))
    occurrences = found.where("n > 0").select("scan", "page", "mark", F.explode(F.sequence(F.lit(1), "n")).alias("at"))
    live = backed(claims, occurrences, ["scan", "page", "mark"], ["line"]).select("line").distinct()
    kept = stage(marked.join(live.withColumn("live", F.lit(True)), "line", "left").where("live or size(marks) = 0"), "kept")
    there = pages.groupBy("scan").agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("⟨"), F.lit("")))).alias("there"))
    listed = kept.groupBy("scan").agg(F.sum(F.size("marks")).alias("listed"))
    stray = there.join(listed, "scan", "left").select("scan", (F.col("there") - F.coalesce("listed", F.lit(0))).cast("bigint").alias("n")).where("n <> 0")
    return kept.drop("live", "marks"), stray


def dispute_table(disputes: DataFrame, order: str = "seq") -> DataFrame:
    """(n, line): the disputes in order as the lines of an aligned table; none for no disputes."""
    head = ["scan", "page", "where", "readings"]
    return report_lines(disputes, ["scan", order], head, head)
