"""Scans as an OCR service returns them: JSON in two layouts, one row per block, and the repairs of lost structure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions.scalar import clean_cell, is_noise, one_cell, strip
from tidegauge.operators import tables

# Fixed value: the mark of a train-number table.
TRAINS = "№ поездов"

CAMEL = "type string, content string, topLeftX int, topLeftY int, bottomRightX int, bottomRightY int"
SNAKE = "type string, content string, top_left_x int, top_left_y int, bottom_right_x int, bottom_right_y int"
NAMES = ("type", "content", "x0", "y0", "x1", "y1")


def _blocks(df: DataFrame, scan, dims, blocks, names) -> DataFrame:
    rows = df.select(scan.alias("scan"), dims["width"].alias("page_w"), dims["height"].alias("page_h"), F.posexplode_outer(blocks).alias("block", "b"))
    return rows.select("scan", "page_w", "page_h", "block", *[F.col(f"b.{a}").alias(b) for a, b in zip(names, NAMES)])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of `pages/page-N/page-metadata.json` (camel case); the scan's number is the folder's."""
    schema = f"dimensions struct<dpi:int,height:int,width:int>, blocks array<struct<{CAMEL.replace(' ', ':').replace(',:', ',')}>>"
    df = spark.read.schema(schema).option("multiLine", True).json(f"{path}/pages/page-*/page-metadata.json")
    scan = F.regexp_extract(F.col("_metadata.file_path"), r"page-(\d+)/[^/]*$", 1).cast("int")
    return _blocks(df, scan, F.col("dimensions"), F.col("blocks"), [c.split()[0] for c in CAMEL.split(", ")])


def read_api(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of `scan-NN.json` (snake case, the first of its pages)."""
    inner = f"dimensions:struct<dpi:int,height:int,width:int>,blocks:array<struct<{SNAKE.replace(' ', ':').replace(',:', ',')}>>"
    df = spark.read.schema(f"pages array<struct<{inner}>>").option("multiLine", True).json(f"{path}/scan-*.json")
    scan = F.regexp_extract(F.col("_metadata.file_path"), r"scan-(\d+)\.json$", 1).cast("int")
    page = F.col("pages")[0]
    return _blocks(df, scan, page["dimensions"], page["blocks"], [c.split()[0] for c in SNAKE.split(", ")])


def split_halves(blocks: DataFrame) -> DataFrame:
    """blocks with `half`: a portrait page is one half; else a block left of the middle is on the first."""
    left = (F.col("x0") + F.col("x1")) / 2 < F.col("page_w") / 2
    return blocks.withColumn("half", F.when((F.col("page_w") < F.col("page_h")) | left, 0).otherwise(1))


def drop_noise(blocks: DataFrame) -> DataFrame:
    """Without blank blocks, page numbers and sheet marks."""
    return blocks.where(~is_noise(strip(F.col("content"))))


def reading_order(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """blocks with `pos`, from top to bottom and left to right."""
    return blocks.withColumn("pos", F.row_number().over(Window.partitionBy(*keys).orderBy("y0", "x0", "block")))


def caption_lines(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, line, text): heads and feet in the top eighth of a page as printed lines, each from left to right.

    A block joins the open line while its middle is above the line's lowest
    bottom, so lines are islands under a running maximum.
    """
    top = blocks.where(F.col("type").isin("header", "footer") & (F.col("y0") < 0.12 * F.col("page_h")))
    top = top.withColumn("mid", (F.col("y0") + F.col("y1")) / 2)
    w = Window.partitionBy(*keys).orderBy("y0", "x0", "block")
    top = top.withColumn("_m", F.max("y1").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    top = top.withColumn("line", F.sum(F.when(F.col("_m").isNull() | (F.col("mid") >= F.col("_m")), 1).otherwise(0)).over(w))
    return top.groupBy(*keys, "line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "block", clean_cell(F.col("content")).alias("content")))), lambda s: s["content"]), " · ").alias("text"))


def header_span(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """blocks with g_rows, g_head, g_width of their tables, and head_width, head_left, head_span of the page: the width of its first
    train-number table of more than three columns, and the place of its first train-number table."""
    read = tables.read_gfm(blocks.withColumn("_t", F.when(F.col("type") == "table", strip(F.col("content")))), "_t").drop("_t")
    w = Window.partitionBy(*keys)
    numbers = (F.col("type") == "table") & F.contains("content", F.lit(TRAINS))
    first = F.min(F.when(numbers, F.struct("block", "x0", "x1"))).over(w)
    wide = F.min(F.when(numbers & (F.col("g_width") > 3), F.struct("block", "g_width"))).over(w)
    return read.withColumn("_f", first).withColumn("head_width", wide["g_width"]).withColumn("head_left", F.col("_f.x0")).withColumn("head_span", F.col("_f.x1") - F.col("_f.x0")).drop("_f")


def station_blocks(blocks: DataFrame) -> DataFrame:
    """blocks (with header_span) with `station`: text at the left edge of the train-number table, narrow and without times, is a station column that lost its table."""
    near = (F.col("x0") - F.col("head_left") <= 0.12 * F.col("head_span")) & (F.col("x1") - F.col("x0") <= 0.30 * F.col("head_span"))
    return blocks.withColumn("station", F.coalesce(F.col("type").isin("list", "text") & ~F.col("content").rlike(r"(?U)\d[.,]\d") & near, F.lit(False)))


def extents(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, x0, y0, x1, y1): the box round all blocks of each key; unknown edges are left out."""
    return blocks.groupBy(*keys).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def fuse_stations(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks (with `station`) in which each run of station blocks in reading order is one table of names and blanks, and narrow tables have the page's width; pages without a width stay as they are."""
    rows = reading_order(blocks, keys)
    rows = rows.withColumn("_run", F.col("station") & F.col("head_width").isNotNull())
    w = Window.partitionBy(*keys)
    rows = rows.withColumn("_g", F.when(F.col("_run"), F.col("pos") - F.sum(F.col("_run").cast("int")).over(w.orderBy("pos"))))
    names = F.filter(F.transform(F.split("content", "\n"), strip), lambda n: n != "")
    fused = rows.where("_run").groupBy(*keys, "page_w", "page_h", "head_width", "head_left", "head_span", "_g").agg(
        F.min("pos").alias("pos"), F.min("block").alias("block"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", names.alias("n")))), lambda s: s["n"])).alias("names"),
    )
    fused = fused.withColumn("g_rows", F.transform("names", lambda n: one_cell(n, F.lit(0), F.col("head_width"))))
    fused = fused.withColumns({"g_head": F.lit(0), "g_width": F.col("head_width"), "type": F.lit("table"), "content": F.array_join("names", "\n"), "station": F.lit(False)}).drop("names", "_g")
    narrow = F.col("g_width") < F.col("head_width")
    rest = rows.where("not _run").drop("_run", "_g")
    rest = rest.withColumn("g_rows", F.when(narrow, F.transform("g_rows", lambda r: tables.widen(r, F.lit(False), F.col("head_width")))).otherwise(F.col("g_rows")))
    rest = rest.withColumn("g_width", F.when(narrow, F.col("head_width")).otherwise(F.col("g_width")))
    return rest.unionByName(fused)


def folio(scan, half, first_spread: int = 3, last_spread: int = 102):
    """Printed page number of a half: 2n - 4 and 2n - 3 on spreads; the first spread before them and covers have none."""
    return F.when(scan.between(first_spread, last_spread), 2 * scan - 4 + half)
