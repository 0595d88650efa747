"""Book pages as HTML: tables with heads, bands and rules, captions, headings and text, shrunk to fit where a page has too much."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalar import escape_html, fixed_decimals, strip
from tidegauge.operators import tables
from tidegauge.sources import scanfiles

# Table rows that a page holds, and what headings and text take of them.
CAPACITY, HEADING, LINE, GAP, LINE_CHARS = 47.0, 2.0, 0.9, 0.4, 60
STYLE = (
    ".scan{position:relative;break-before:page}.page{position:absolute;top:0;overflow:hidden}.content{font-size:calc(6.1pt * var(--fit,1))}"
    "table.tt{width:100%;border-collapse:collapse;table-layout:fixed}table.tt td,table.tt th{border:.2pt solid #8d8471;white-space:nowrap;overflow:hidden}"
    "tr.ruled>*{border-top:1.4pt solid #1c1a17}tr.band>td{text-align:center;font-weight:600}table.prose td{white-space:normal}.a-c{text-align:center}"
)
PAGE = ["scan", "kind_of_scan", "half", "folio"]


def page_parts(files: DataFrame) -> DataFrame:
    """(scan, kind_of_scan, half, folio, item, kind, text, t_items, t_width) of scan files (as scanfiles.read_scan_files gives them): one row an item."""
    items = scanfiles.page_items(files)
    whole = items.groupBy("scan", "half", "folio", "item", "kind").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "\n").alias("text"))
    whole = whole.join(files.select("scan", F.col("kind").alias("kind_of_scan")), "scan")
    return tables.read_book_table(whole.withColumn("_t", F.when(F.col("kind") == "table", F.col("text"))), "_t").drop("_t", "t_head")


def fit_scale(parts: DataFrame, keys: list[str], capacity: float = CAPACITY) -> DataFrame:
    """(keys, rows, scale): a page's height in table rows, and what it is shrunk by so that it fits."""
    text = F.lit(LINE) * F.greatest(F.lit(1.0), F.length(strip(F.col("text"))) / LINE_CHARS) + GAP
    height = F.when(F.col("kind") == "table", F.size(F.filter("t_items", lambda r: r["kind"] != "rule")).cast("double")).when(F.col("kind") == "heading", HEADING).otherwise(text)
    rows = parts.groupBy(*keys).agg(F.sum(height).alias("rows"))
    return rows.withColumn("scale", F.when(F.col("rows") > capacity, F.lit(capacity) / F.col("rows")).otherwise(1.0))


def _tag(name: str, inner, attributes=""):
    return F.concat(F.lit(f"<{name}"), F.lit(attributes) if isinstance(attributes, str) else attributes, F.lit(">"), inner, F.lit(f"</{name}>"))


def table_html(parts: DataFrame, out: str = "html") -> DataFrame:
    """parts with `out`: each table as HTML. Empty head cells continue the cell on their left; a rule marks the row under it; a band spans the table. No shuffle."""
    rows = F.transform("t_items", lambda r, i: F.struct(r["kind"].alias("kind"), r["cells"].alias("cells"), F.coalesce(F.get("t_items", i - 1)["kind"] == "rule", F.lit(False)).alias("ruled")))
    df = parts.withColumn("_r", F.filter(rows, lambda r: r["kind"] != "rule"))
    kinds = F.transform("_r", lambda r: r["kind"])
    df = df.withColumn("_h", F.array_position(kinds, "head") - 1).withColumn("_b", F.array_position(F.transform("_r", lambda r: r["kind"] != "head"), True) - 1)

    def cell(tag, text, j, span):
        attributes = F.concat(F.when(j == 0, " class='st'").otherwise(""), F.when(span > 1, F.concat(F.lit(" colspan='"), span.cast("string"), F.lit("'"))).otherwise(""))
        return F.concat(F.lit("<"), tag, attributes, F.lit(">"), escape_html(text), F.lit("</"), tag, F.lit(">"))

    def head_row(r):
        starts = F.filter(F.transform(r["cells"], lambda c, j: F.when((j == 0) | (c != ""), j)), lambda j: j.isNotNull())
        return F.array_join(F.transform(starts, lambda j, n: cell(F.lit("th"), F.get(r["cells"], j), j, F.coalesce(F.get(starts, n + 1), F.col("t_width")) - j)), "")

    def line(r, i):
        band = F.concat(F.lit("<tr class='band"), F.when(r["ruled"], " ruled").otherwise(""), F.lit("'><td colspan='"), F.col("t_width").cast("string"), F.lit("'>"), escape_html(F.get(r["cells"], F.lit(0))), F.lit("</td></tr>"))
        plain = F.array_join(F.transform(r["cells"], lambda c, j: cell(F.lit("td"), c, j, F.lit(1))), "")
        row = F.concat(F.when(r["ruled"], "<tr class='ruled'>").otherwise("<tr>"), F.when(r["kind"] == "head", head_row(r)).otherwise(plain), F.lit("</tr>"))
        opens = F.concat(F.when(i == F.col("_h"), "<thead>").otherwise(""), F.when(i == F.col("_b"), F.concat(F.when((F.col("_h") >= 0) & (F.col("_h") < F.col("_b")), "</thead>").otherwise(""), F.lit("<tbody>"))).otherwise(""))
        return F.concat(opens, F.when(r["kind"] == "band", band).otherwise(row))

    body = F.array_join(F.transform("_r", line), "")
    closes = F.when(F.col("_b") >= 0, "</tbody>").when(F.col("_h") >= 0, "</thead>").otherwise("")
    html = F.concat(F.lit("<table class='tt"), F.when(F.col("t_width") > 3, "").otherwise(" prose"), F.lit("'>"), body, closes, F.lit("</table>"))
    return df.withColumn(out, html).drop("_r", "_h", "_b")


def page_html(parts: DataFrame) -> DataFrame:
    """(scan, kind_of_scan, half, folio, html): each page as HTML, with its items in order and its number."""
    text = escape_html(strip(F.col("text")))
    heading = escape_html(strip(F.regexp_replace("text", r"\A#+", "")))
    made = table_html(parts, "_table").withColumn(
        "_p",
        F.when(F.col("kind") == "table", _tag("div", F.col("_table"), " class='blk'"))
        .when(F.col("kind") == "caption", _tag("div", _tag("div", text, " class='runhead'"), " class='blk a-c'"))
        .when(F.col("kind") == "heading", _tag("div", _tag("h3", heading), " class='blk a-c'"))
        .otherwise(_tag("div", _tag("p", text), " class='blk a-l'")),
    )
    pages = made.groupBy(*PAGE).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("item", "_p"))), lambda x: x["_p"]), "").alias("body"))
    scale = fit_scale(parts, ["scan", "half"])
    pages = pages.join(scale, ["scan", "half"])
    side = F.when(F.col("kind_of_scan") == "cover", "portrait").when(F.col("half") == 0, "left").otherwise("right")
    fit = F.when(F.col("scale") < 1, F.concat(F.lit(" class='content' style='--fit:"), fixed_decimals(F.col("scale"), 3), F.lit("'"))).otherwise(" class='content'")
    number = F.when(F.col("folio").isNotNull(), _tag("div", F.col("folio").cast("string"), " class='folio'")).otherwise("")
    html = _tag("div", F.concat(_tag("div", F.col("body"), fit), number), F.concat(F.lit(" class='page "), side, F.lit("'")))
    return pages.select(*PAGE, html.alias("html"))


def book_html(files: DataFrame, title: str, style: str = STYLE) -> DataFrame:
    """(n, line): the lines of one HTML document: its head at 0, then a scan a line, up to the first scan that is missing."""
    pages = page_html(page_parts(scanfiles.contiguous(files)))
    whole = pages.groupBy("scan", "kind_of_scan").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("half", "html"))), lambda x: x["html"]), "").alias("body"))
    line = _tag("div", F.col("body"), F.when(F.col("kind_of_scan") == "cover", " class='scan single'").otherwise(" class='scan'"))
    head = files.sparkSession.createDataFrame([(0, f"<meta charset='utf-8'><title>{title}</title><style>{style}</style>")], "n int, line string")
    return head.unionByName(whole.select(F.col("scan").alias("n"), line.alias("line")))
