"""Pipe tables in text: reading them into cells and writing them aligned."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.scalar import strip

# How rules are written, and the words of a second head row.
SEPARATOR = r"\A\s*\|?(\s*:?-+:?\s*\|)*\s*:?-+:?\s*\|?\s*\z"
PAIR_WORDS = r"(?iu)\A(приб|отпр)\.?\z"
HEAD_RULE = r"\A\s*\|?(\s*=+\s*\|)*\s*=+\s*\|?\s*\z"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once a row: written out, it would be computed again wherever use names it, inside lambdas for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_lines(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, line, text): the lines of each text from 0."""
    return df.select(id_col, F.posexplode(F.split(F.col(text), "\n")).alias("line", "text"))


def pipe_cells(lines: DataFrame, id_col: str) -> DataFrame:
    """(id, line, kind, col, cell) of lines that hold a pipe: outer pipes dropped, cells stripped; rules (of - or =) are kinds of their own and have no cells."""
    body = F.regexp_replace(F.regexp_replace("text", r"\A\s*\|", ""), r"\|\s*\z", "")
    kind = F.when(F.col("text").rlike(HEAD_RULE), "head rule").when(F.col("text").rlike(SEPARATOR), "rule").otherwise("row")
    rows = lines.where(F.col("text").contains("|")).select(id_col, "line", kind.alias("kind"), body.alias("body"))
    rows = rows.where("kind = 'row'").select(id_col, "line", "kind", F.posexplode(F.split("body", r"\|")).alias("col", "cell"))
    return rows.withColumn("cell", F.regexp_replace("cell", r"\A[ \t\r]+|[ \t\r]+\z", ""))


def render_table(cells: DataFrame, table: list[str], row: str, col: str, text: str) -> DataFrame:
    """(table..., row, line): rows as `| a | b |`, each column padded to its widest cell in the table."""
    w = cells.withColumn("_w", F.max(F.length(text)).over(Window.partitionBy(*table, col)))
    w = w.withColumn("_t", F.rpad(text, F.col("_w"), " "))
    line = F.concat(F.lit("| "), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(col).alias("c"), F.col("_t").alias("t")))), lambda x: x["t"]), " | "), F.lit(" |"))
    return w.groupBy(*table, row).agg(line.alias("line"))


def _lines(text):
    """Cells of the lines that begin with a pipe, outer pipes dropped."""
    found = F.filter(F.transform(F.split(text, "\n"), strip), lambda t: F.startswith(t, F.lit("|")))
    return F.transform(found, lambda t: F.transform(F.split(F.trim(t, F.lit("|")), r"\|"), strip))


def _ruled(cells, marks: str):
    return F.forall(cells, lambda c: c.rlike(rf"\A[{marks}]+\z"))


def _padded(cells, width):
    return F.concat(cells, F.array_repeat(F.lit(""), F.greatest(width - F.size(cells), F.lit(0)).cast("int")))


def read_gfm(df: DataFrame, text: str, prefix: str = "g_") -> DataFrame:
    """df with g_rows (array of cell arrays, padded), g_head (number of head rows) and g_width of the GitHub-style table in `text`; null where it has no rows.

    The rows above the last rule are the head, and so are those under it whose cells, but
    for the first one, are only the words of arrivals and departures. Everything is
    computed inside a row of df: no shuffle.
    """
    def made(lines):
        body = F.filter(lines, lambda x: ~x["rule"])
        return bind(F.struct(body.alias("body"), F.array_max(F.transform(body, lambda x: F.size(x["c"]))).alias("width")), lambda b: placed(lines, b["body"], b["width"]))

    def placed(lines, body, width):
        rules = F.transform(lines, lambda x: x["rule"])
        last = F.size(lines) - F.array_position(F.reverse(rules), True) + 1  # place of the last rule
        above = F.when(F.array_contains(rules, True), F.size(F.filter(F.slice(lines, F.lit(1), last.cast("int")), lambda x: ~x["rule"]))).otherwise(0)
        rows = F.transform(body, lambda x: _padded(x["c"], width))
        return bind(F.struct(above.alias("above"), rows.alias("rows")), lambda p: headed(p["rows"], p["above"], width))

    def headed(rows, above, width):
        words = F.transform(F.slice(rows, above + 1, F.greatest(F.size(rows) - above, F.lit(0))), lambda c: F.filter(F.slice(c, F.lit(2), F.size(c)), lambda x: x != ""))
        is_head = F.transform(words, lambda c: (F.size(c) > 0) & F.forall(c, lambda x: x.rlike(PAIR_WORDS)))
        under = bind(is_head, lambda m: F.when(F.array_position(m, False) > 0, F.array_position(m, False) - 1).otherwise(F.size(m)).cast("int"))
        return F.when(width.isNotNull(), F.struct((above + under).alias("head"), width.alias("width"), rows.alias("rows")))

    lines = F.transform(_lines(F.coalesce(F.col(text), F.lit(""))), lambda c: F.struct(c.alias("c"), (_ruled(c, "-: ") & (F.size(c) > 0)).alias("rule")))
    df = df.withColumn(f"{prefix}all", bind(lines, made))
    return df.withColumns({f"{prefix}{x}": F.col(f"{prefix}all.{x}") for x in ("head", "width", "rows")}).drop(f"{prefix}all")


def read_book_table(df: DataFrame, text: str, prefix: str = "t_") -> DataFrame:
    """df with t_items (array of (kind, cells): head, row, band or rule), t_width and t_head (rows and bands up to the last head row) of the table in `text`.

    A rule of = ends the head; a row of one cell in a wider table is a band. No shuffle.
    """
    kind = lambda c: F.when(_ruled(c, "-=: ") & F.exists(c, lambda x: F.contains(x, F.lit("="))), "head rule").when(_ruled(c, "-=: "), "rule").otherwise("row")
    kinds = lambda items: F.transform(items, lambda x: x["kind"])
    upto = lambda names, wanted: F.when(F.array_contains(names, wanted), F.size(names) - F.array_position(F.reverse(names), wanted) + 1).otherwise(0).cast("int")
    item = lambda kind, cells: F.struct(kind.alias("kind"), cells.alias("cells"))

    def made(lines):
        width = F.coalesce(F.array_max(F.transform(F.filter(lines, lambda x: x["kind"] == "row"), lambda x: F.size(x["cells"]))), F.lit(0))
        return bind(width, lambda w: bind(F.transform(lines, lambda x: item(F.when((x["kind"] == "row") & (F.size(x["cells"]) == 1) & (w > 1), "band").otherwise(x["kind"]), x["cells"])), lambda rows: marked(rows, w)))

    def marked(rows, width):
        def items(last):
            named = lambda x, n: item(F.when((x["kind"] == "row") & (n < last), "head").otherwise(x["kind"]), F.when(x["kind"] == "row", _padded(x["cells"], width)).otherwise(x["cells"]))
            return bind(F.filter(F.transform(rows, named), lambda x: x["kind"] != "head rule"), lambda found: F.struct(found.alias("items"), width.alias("width"), bind(kinds(F.filter(found, lambda x: x["kind"] != "rule")), lambda k: upto(k, "head")).alias("head")))

        return bind(kinds(rows), lambda k: bind(upto(k, "head rule"), items))

    lines = F.transform(_lines(F.coalesce(F.col(text), F.lit(""))), lambda c: F.struct(kind(c).alias("kind"), c.alias("cells")))
    df = df.withColumn(f"{prefix}all", bind(lines, made))
    return df.withColumns({f"{prefix}{x}": F.col(f"{prefix}all.{x}") for x in ("items", "width", "head")}).drop(f"{prefix}all")


def table_text(df: DataFrame, rows: str, width: str, head: str, out: str) -> DataFrame:
    """df with `out`: the table of `rows` (array of (kind, cells)) as aligned text, a rule of = under row `head` (the first at least), bands over the whole width between rules of -. No shuffle."""
    just = lambda t, size: F.rpad(t, F.greatest(size, F.length(t)), " ")
    rule = lambda w, ch: F.concat(F.lit("|"), F.array_join(F.transform(w, lambda x: F.repeat(F.lit(ch), x + 2)), "|"), F.lit("|"))
    line = lambda r, w: F.concat(F.lit("| "), F.array_join(F.zip_with(r["cells"], w, just), " | "), F.lit(" |"))
    label = lambda r: F.coalesce(F.get(F.filter(r["cells"], lambda c: c != ""), F.lit(0)), F.lit(""))

    def made(t):
        def drawn(w):
            whole = F.aggregate(w, F.lit(0), lambda a, x: a + x) + 3 * (t["width"] - 1)
            return bind(F.struct(whole.alias("n"), rule(w, "-").alias("thin"), rule(w, "=").alias("thick")), lambda k: F.array_join(F.flatten(F.transform(t["rows"], lambda r, i: shown(r, i, w, k))), "\n"))

        def shown(r, i, w, k):
            band = F.array(k["thin"], F.concat(F.lit("| "), just(label(r), k["n"]), F.lit(" |")), k["thin"])
            return F.when(r["kind"] == "band", band).when(i + 1 == F.greatest(t["head"], F.lit(1)), F.array(line(r, w), k["thick"])).otherwise(F.array(line(r, w)))

        def widths(body):
            wide = F.transform(F.sequence(F.lit(0), t["width"] - 1), lambda j: F.coalesce(F.array_max(F.transform(body, lambda r: F.length(F.get(r["cells"], j)))), F.lit(0)))
            return bind(F.when(t["width"] > 0, wide).otherwise(F.array().cast("array<int>")), drawn)

        return bind(F.filter(t["rows"], lambda r: r["kind"] != "band"), widths)

    return df.withColumn(out, bind(F.struct(F.col(rows).alias("rows"), F.col(width).alias("width"), F.col(head).alias("head")), made))


def widen(cells, rule, width):
    """A narrow row's cells filled up to `width`: with blanks, a rule's with ---."""
    return F.concat(cells, F.array_repeat(F.when(rule, "---").otherwise(""), F.greatest(width - F.size(cells), F.lit(0)).cast("int")))
