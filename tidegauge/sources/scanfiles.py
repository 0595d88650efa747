"""Book pages kept as text: front matter, pages, items and pipe tables, as long frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions.scalar import strip


def read_scan_files(spark: SparkSession, path: str) -> DataFrame:
    """(scan, kind, shapes, text), one row a file `scan-*.md`; scan, kind and shapes default to 0, spread and none."""
    files = spark.read.text(f"{path}/scan-*.md", wholetext=True).withColumnRenamed("value", "text")
    head = F.regexp_extract("text", r"(?s)\A---\n(.*?)\n---", 1)
    field = lambda k: strip(F.regexp_extract(head, rf"(?m)^\s*{k}\s*:(.*)$", 1))
    shapes = F.transform(F.split(F.regexp_replace(field("shapes"), r"[\[\]]", ""), ","), lambda s: strip(s))
    return files.select(
        F.coalesce(field("scan").try_cast("int"), F.lit(0)).alias("scan"),
        F.when(field("kind") == "", "spread").otherwise(field("kind")).alias("kind"),
        F.filter(shapes, lambda s: s != "").alias("shapes"),
        F.regexp_replace("text", r"(?s)\A---\n.*?\n---\n?", "").alias("text"),
    )


def contiguous(files: DataFrame) -> DataFrame:
    """Scans 1, 2, 3 and so on, up to the first gap."""
    own = files.where("scan > 0")
    after = own.select((F.col("scan") + 1).alias("scan")).unionByName(own.sparkSession.sql("select 1 as scan")).distinct()
    gap = after.join(own.select("scan").distinct(), "scan", "left_anti").agg(F.min("scan").alias("gap"))  # one row
    return own.join(F.broadcast(gap), F.col("scan") < F.col("gap")).drop("gap")


def page_items(files: DataFrame) -> DataFrame:
    """(scan, half, folio, shape, item, line, kind, text): non-blank lines of pages, with their item's number and kind.

    Items are runs of lines between blank ones: table (first character |),
    heading (#), caption (before the page's first table) or para.
    """
    lines = files.select("scan", "shapes", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    w = Window.partitionBy("scan").orderBy("line")
    starts = F.startswith("text", F.lit("## page"))
    lines = lines.withColumn("half", F.sum(starts.cast("int")).over(w) - 1).where("half >= 0")
    of_page = Window.partitionBy("scan", "half")
    label = strip(F.regexp_replace("text", r"\A## page", ""))
    lines = lines.withColumn("folio", F.max(F.when(starts, label.try_cast("int"))).over(of_page))
    lines = lines.withColumn("shape", F.coalesce(F.try_element_at("shapes", (F.col("half") + 1).cast("int")), F.lit("UNKNOWN")))
    lines = lines.where(~starts).withColumn("text", strip(F.col("text")))
    in_page = Window.partitionBy("scan", "half").orderBy("line")
    lines = lines.withColumn("_gap", F.sum((F.col("text") == "").cast("int")).over(in_page)).where("text <> ''")
    lines = lines.withColumn("item", F.dense_rank().over(Window.partitionBy("scan", "half").orderBy("_gap")) - 1)
    first = F.first("text").over(Window.partitionBy("scan", "half", "item").orderBy("line"))
    lines = lines.withColumn("_first", first).withColumn("kind", F.when(F.startswith("_first", F.lit("|")), "table").when(F.startswith("_first", F.lit("#")), "heading").otherwise("para"))
    table = F.min(F.when(F.col("kind") == "table", F.col("item"))).over(of_page)
    return lines.withColumn("_t", table).select(
        "scan", "half", "folio", "shape", "item", "line", F.when((F.col("kind") == "para") & (F.col("item") < F.col("_t")), "caption").otherwise(F.col("kind")).alias("kind"), "text"
    )


def table_rows(items: DataFrame) -> DataFrame:
    """(scan, half, folio, shape, item, line, kind, cells, width) of tables: kind is head, row, rule or band.

    A rule of = makes the data rows above it the head; a row of one cell in
    a wider table is a band; other rows are padded to the widest.
    """
    t = items.where("kind = 'table' and substring(text, 1, 1) = '|'").drop("kind")
    t = t.withColumn("cells", F.transform(F.split(F.regexp_replace("text", r"\A\|+|\|+\z", ""), r"\|"), lambda c: strip(c)))
    ruled = F.forall("cells", lambda c: c.rlike(r"\A[-=: ]+\z"))
    whole = Window.partitionBy("scan", "half", "item")
    t = t.withColumn("kind", F.when(ruled & F.exists("cells", lambda c: F.contains(c, F.lit("="))), "head rule").when(ruled, "rule"))
    t = t.withColumn("width", F.max(F.when(F.col("kind").isNull(), F.size("cells"))).over(whole))
    t = t.withColumn("kind", F.coalesce("kind", F.when((F.size("cells") == 1) & (F.col("width") > 1), "band").otherwise("row")))
    data = F.sum((F.col("kind") == "row").cast("int")).over(whole.orderBy("line"))
    t = t.withColumn("_n", data).withColumn("_head", F.max_by("_n", F.when(F.col("kind") == "head rule", F.col("line"))).over(whole))
    t = t.withColumn("kind", F.when((F.col("kind") == "row") & (F.col("_n") <= F.coalesce("_head", F.lit(0))), "head").otherwise(F.col("kind")))
    pad = F.concat("cells", F.array_repeat(F.lit(""), F.greatest(F.col("width") - F.size("cells"), F.lit(0))))
    return t.where("kind <> 'head rule'").select("scan", "half", "folio", "shape", "item", "line", "kind", F.when(F.col("kind").isin("row", "head"), pad).otherwise(F.col("cells")).alias("cells"), "width")
