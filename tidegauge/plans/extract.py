"""From an OCR service's blocks to scan files: halves, repairs, shapes, rows, realignment and text, with a report of every repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions.scalar import cite, clean_cell, one_cell, stray_markup, strip
from tidegauge.operators import realign, tables
from tidegauge.operators.report import report_lines
from tidegauge.sources import ocr
from tidegauge.sources.shared import stage

HALF = ["scan", "half"]
# Shapes of tables with their station column and the columns that hold no times, the words that
# tell them, a change of railway, and the texts of reports.
SHAPES = {"suburban": (0, [0]), "two-way": (2, [2]), "distance": (0, [0, 1])}
POINTS, DISTANCE = "Раздельные пункты", "асстоян"
RAILWAY = r"(?U)ж\.\s*д\.\z"
UNKNOWN, PROSE = "UNKNOWN", "prose"


def table_shape(head):
    """The shape that a table's first row shows; null for one that has no rules."""
    cell = lambda i: F.coalesce(F.get(head, F.lit(i)), F.lit(""))
    return (
        F.when(F.contains(cell(0), F.lit(ocr.TRAINS)), "suburban").when((F.size(head) > 2) & F.contains(cell(2), F.lit(POINTS)), "two-way")
        .when(F.contains(cell(0), F.lit(POINTS)) & F.exists(head, lambda c: F.contains(c, F.lit(DISTANCE))), "distance")
    )


def _of_shape(column: str, values: list):
    """A value for each shape, in the order of SHAPES."""
    out = None
    for name, v in zip(SHAPES, values):
        out = F.when(F.col(column) == name, v) if out is None else out.when(F.col(column) == name, v)
    return out


def page_shapes(blocks: DataFrame) -> DataFrame:
    """(half, shape, width, has_table), one row a half: the shape of its topmost table that has rows; null where that one is unknown, whatever stands below it."""
    top = F.min(F.when(F.col("g_rows").isNotNull() & (F.col("type") == "table"), F.struct("y0", "pos", "g_rows", "g_width")))
    found = blocks.groupBy(*HALF).agg(top.alias("t"), F.coalesce(F.max(F.col("type") == "table"), F.lit(False)).alias("has_table"))
    return found.select(*HALF, table_shape(F.get("t.g_rows", F.lit(0))).alias("shape"), F.col("t.g_width").alias("width"), "has_table")


def _rows(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, problems) of the halves with a shape: rows (half, shape, width, pos, line, kind, cells, head) in reading order."""
    b = blocks.where("shape is not null and not coalesce(type in ('header', 'footer'), false)").withColumn("sc", _of_shape("shape", [F.lit(c) for c, _ in SHAPES.values()]))
    b = b.withColumn("bare", _of_shape("shape", [F.array(*map(F.lit, p)) for _, p in SHAPES.values()]))
    key = [*HALF, "shape", "width", "sc", "bare", "pos"]
    stations = (F.col("shape") == "suburban") & F.col("station")
    title = ~stations & ((F.col("type") == "title") | F.startswith(strip(F.col("content")), F.lit("#")))
    b = b.withColumn("what_is", F.when(stations, "stations").when(title, "title").when(F.col("type") == "table", "table").when(F.col("content").rlike(r"(?U)\d[.,]\d"), "text").otherwise("other"))
    lines = b.where("what_is = 'stations' or what_is = 'text' and shape = 'suburban'").select(*key, "what_is", F.posexplode(F.split("content", "\n")).alias("line", "t")).where(strip(F.col("t")) != "")
    none = F.lit(0).alias("head")
    loose = lines.where("what_is = 'stations'").select(*key, "line", F.lit("row").alias("kind"), one_cell(clean_cell(F.col("t")), F.col("sc"), F.col("width")).alias("cells"), none)
    placed = realign.text_rows(lines.where("what_is = 'text'"), "t", F.col("sc"), F.col("width"))
    name = clean_cell(strip(F.regexp_replace("content", r"\A[# ]+", "")))
    titles = b.where("what_is = 'title'").select(*key, F.lit(0).alias("line"), F.lit("band").alias("kind"), name.alias("n"), none).where("n <> ''")
    titles = titles.select(*key, "line", "kind", one_cell(F.col("n"), F.col("sc"), F.col("width")).alias("cells"), "head")
    body = b.where("what_is = 'table' and g_rows is not null").select(*key, F.col("g_head").alias("head"), F.posexplode("g_rows").alias("line", "r"))
    padded = F.concat(F.slice("r", F.lit(1), F.col("width")), F.array_repeat(F.lit(""), F.greatest(F.col("width") - F.size("r"), F.lit(0)).cast("int")))
    cells = F.transform(padded, lambda c, i: clean_cell(c, pad_time=~F.array_contains("bare", i)))
    body = body.select(*key, "line", cells.alias("cells"), "head")
    alone = F.get("cells", F.col("sc")).rlike(RAILWAY) & ~F.exists(F.transform("cells", lambda c, i: (i != F.col("sc")) & (c != "")), lambda x: x)
    body = body.withColumn("kind", F.when(alone, "band").otherwise("row"))
    rows = loose.unionByName(placed.where("cells is not null").select(*key, "line", F.lit("row").alias("kind"), "cells", none)).unionByName(titles).unionByName(body)
    # only what comes first may bring the head
    w = Window.partitionBy(*HALF)
    rows = rows.withColumn("head", F.min_by("head", F.struct("pos", "line")).over(w)).withColumn("n", F.row_number().over(w.orderBy("pos", "line")) - 1)
    outside = b.where("what_is = 'text' and shape <> 'suburban'").select(*HALF, F.array("pos", F.lit(0)).alias("o"), F.lit("DROPPED text with times").alias("what"), F.concat(cite(strip(F.col("content"))), F.lit(" -- the OCR gave it outside the "), F.col("shape"), F.lit(" table")).alias("detail"))
    problems = placed.where("what is not null").select(*HALF, F.array("pos", "line").alias("o"), "what", "detail").unionByName(outside)
    return rows, problems


def extract(blocks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scans (scan, file, text), problems (scan, seq, what, detail), shapes (scan, half, shape)) of OCR blocks as sources.ocr reads them."""
    scans = blocks.select("scan", "page_w", "page_h").distinct().withColumn("spread", F.col("page_w") >= F.col("page_h"))
    scans = stage(scans, "scans")
    halves = scans.select("scan", "spread", F.explode(F.when(F.col("spread"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("half"))
    halves = halves.withColumn("folio", F.when(F.col("spread") & (F.col("scan") != 2), 2 * F.col("scan") - 4 + F.col("half")))
    own = ocr.split_halves(ocr.drop_noise(blocks.where("content is not null")))
    own = ocr.reading_order(ocr.fuse_stations(ocr.station_blocks(ocr.header_span(own, HALF)), HALF).drop("pos"), HALF)
    own = stage(own, "repaired")
    shaped = stage(halves.join(page_shapes(own), HALF, "left"), "shapes")
    rows, problems = _rows(own.join(shaped.select(*HALF, "shape", "width"), HALF))
    rows = stage(rows, "rows")

    far = rows.where("shape = 'distance'")
    top = F.greatest("head", F.lit(1))
    fixed = stage(realign.realign(far.where(F.col("n") >= top).select(*HALF, F.col("n").alias("pos"), (F.col("kind") == "band").alias("band"), "cells"), HALF, 0, 1), "realigned")
    about = far.select(*HALF, "shape", "width", "head").distinct()
    body = fixed.where("kind <> 'problem'").join(about, HALF).select(*HALF, "width", "head", F.struct(F.lit(1).alias("part"), F.col("pos").cast("int").alias("n")).alias("n"), "kind", "cells")
    kept = rows.where((F.col("shape") != "distance") | (F.col("n") < top)).select(*HALF, "width", "head", F.struct(F.lit(0).alias("part"), F.col("n").cast("int").alias("n")).alias("n"), "kind", "cells")
    built = stage(kept.unionByName(body), "built")
    listed = built.groupBy(*HALF, "width", "head").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "kind", "cells"))), lambda r: F.struct(r["kind"].alias("kind"), r["cells"].alias("cells"))).alias("rows"))
    made = tables.table_text(listed, "rows", "width", "head", "table").select(*HALF, "table")

    captions = stage(ocr.caption_lines(own, HALF), "captions")
    text = F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("pos", strip(F.col("content")).alias("t")))), lambda s: s["t"]), lambda t: t != ""), "\n\n")
    prose = own.where("not coalesce(type in ('header', 'footer'), false)").groupBy(*HALF).agg(text.alias("prose"))
    above = captions.groupBy(*HALF).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda s: F.concat(s["text"], F.lit("\n\n"))), "").alias("above"))
    page = shaped.join(made, HALF, "left").join(prose, HALF, "left").join(above, HALF, "left")
    page = stage(page.withColumn("shape", F.when(F.col("table").isNotNull(), F.col("shape")).when(F.col("has_table"), UNKNOWN).otherwise(PROSE)), "halves")
    head = F.concat(F.lit("## page"), F.when(F.col("folio").isNotNull(), F.concat(F.lit(" "), F.col("folio").cast("string"))).otherwise(""), F.lit("\n\n"))
    part = F.concat(head, F.coalesce("above", F.lit("")), F.coalesce("table", "prose", F.lit("")), F.lit("\n"))
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("half", c))), lambda s: s[1])
    whole = page.groupBy("scan", "spread").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("half", part.alias("t")))), lambda s: s["t"]), "\n").alias("body"),
        F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("half", F.col("folio").cast("string").alias("f")))), lambda s: s["f"]), lambda f: f.isNotNull()), ", ").alias("folios"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("half", "shape"))), lambda s: s["shape"]), ", ").alias("shapes"),
    )
    front = F.concat(F.lit("---\nscan: "), F.col("scan").cast("string"), F.lit("\nkind: "), F.when(F.col("spread"), "spread").otherwise("cover"), F.lit("\nfolios: ["), F.col("folios"), F.lit("]\nshapes: ["), F.col("shapes"), F.lit("]\n---\n\n"))
    number = F.col("scan").cast("string")
    texts = whole.select("scan", F.concat(F.lit("scan-"), F.when(F.col("scan") < 10, F.concat(F.lit("0"), number)).otherwise(number), F.lit(".md")).alias("file"), F.concat(front, "body").alias("text"))

    check = lambda df, k, t, *o: df.where(stray_markup(F.col(t))).select(*HALF, F.lit(k).alias("k"), F.array(*o).alias("o"), F.lit("markup left").alias("what"), F.concat(cite(F.col(t)), F.lit(" -- check the scan")).alias("detail"))
    cells = built.select(*HALF, "n", F.posexplode("cells").alias("c", "t"))
    strange = page.where(F.col("shape") == UNKNOWN).select(*HALF, F.lit(4).alias("k"), F.array(F.lit(0)).alias("o"), F.lit("unrecognized table shape").alias("what"), F.lit("").alias("detail"))
    repairs = fixed.where("kind = 'problem'").select(*HALF, F.lit(2).alias("k"), F.array(F.col("pos").cast("int")).alias("o"), "what", "detail")
    found = check(captions, 0, "text", F.col("line").cast("int")).unionByName(problems.select(*HALF, F.lit(1).alias("k"), "o", "what", "detail")).unionByName(repairs)
    found = found.unionByName(check(cells, 3, "t", "n.part", "n.n", "c")).unionByName(strange)
    return texts, found.select("scan", F.struct("half", "k", "o").alias("seq"), "what", "detail"), page.select(*HALF, "shape")


def problem_table(problems: DataFrame) -> DataFrame:
    """(n, line): the problems in order as the lines of an aligned table; none for no problems."""
    return report_lines(problems, ["scan", "seq"], ["scan", "what", "detail"], ["scan", "what", "detail"])


def shape_tally(shapes: DataFrame) -> DataFrame:
    """(shape, n): halves by shape."""
    return shapes.groupBy("shape").agg(F.count("*").alias("n"))


def read_ocr(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of an OCR run in either layout, whichever its folder holds."""
    from pyspark.errors import AnalysisException

    try:
        return ocr.read_pages(spark, path)
    except AnalysisException:
        return ocr.read_api(spark, path)
