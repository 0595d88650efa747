"""Scan files as text in sections and blocks, and the tables kept beside them: disputes, ignore entries, golden lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.scalar import strip
from tidegauge.operators import tables
from tidegauge.operators.scan import number, sequences
from tidegauge.sources.named_files import NamedLines

# Columns of an ignore list and of a list of disputes, and the tags of golden lines.
IGNORE_HEAD = ["scan", "folio", "train", "where", "rules", "values", "note"]
TAGS = ["mistake", "artifact", "scatter", "form"]
#: Bytes of a file that is read as one row; longer ones, and packed ones, are read by splits.
WHOLE_BYTES = 1 << 20
PACKED = r"(?i)\.(gz|bz2|zst|snappy|lz4|deflate)\z"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of the files scan-*.md in a folder."""
    files = spark.read.text(f"{path}/scan-*.md", wholetext=True)
    return files.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\z", 1).alias("file"), F.col("value").alias("text"))


def page_sections(files: DataFrame) -> DataFrame:
    """files with head, scan, shapes, and pages: an array of (page, body), one for each heading `## page`, the body without its heading and blank line."""
    parts = F.split("text", r"(?m)^## page")
    head = F.regexp_extract(F.get(parts, F.lit(0)), r"(?s)\A(---\n.*?\n---)", 1)
    shapes = F.split(F.regexp_replace(F.regexp_extract(head, r"(?m)^shapes: (.*)$", 1), r"\A[\[\]]+|[\[\]]+\z", ""), ",")
    # each block is followed by a blank line; the end of the file may lack it, or its line end
    ends = lambda b: F.length(F.regexp_extract(b, r"\n*\z", 0))
    ended = lambda b: F.when((b != "") & (ends(b) % 2 == 1), F.concat(b, F.lit("\n"))).when((b != "") & (ends(b) == 0), F.concat(b, F.lit("\n\n"))).otherwise(b)
    page = lambda p: F.struct(strip(F.regexp_extract(p, r"\A[^\n]*", 0)).alias("page"), ended(F.regexp_replace(p, r"\A[^\n]*\n?\n?", "")).alias("body"))
    return files.select(
        *files.columns, head.alias("head"), F.regexp_extract(head, r"(?m)^scan: (\d+)", 1).try_cast("int").alias("scan"), F.transform(shapes, lambda s: strip(s)).alias("shapes"),
        F.transform(F.slice(parts, F.lit(2), F.size(parts)), page).alias("pages"),
    )


def page_blocks(sections: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, k, page, b, text, is_table, t_items, t_width, t_head): the blocks of each page, each with the blank line after it in the file; an empty block counts.

    is_table only where writing the parsed table gives the very same text. Pages without blocks have no rows.
    """
    pages = sections.select(*keys, F.posexplode("pages").alias("k", "p"))
    pieces = F.split("p.body", "\n\n")
    blocks = pages.select(*keys, "k", "p.page", F.posexplode(F.slice(pieces, F.lit(1), F.size(pieces) - 1)).alias("b", "text"))
    piped = blocks.withColumn("_t", F.when(F.startswith("text", F.lit("|")), F.col("text")))
    read = tables.read_book_table(piped, "_t")
    read = read.withColumn("t_items", F.filter("t_items", lambda x: x["kind"] != "rule"))
    read = tables.table_text(read, "t_items", "t_width", "t_head", "_again")
    return read.withColumn("is_table", F.coalesce((F.size("t_items") > 0) & (F.col("_again") == F.col("_t")), F.lit(False))).drop("_t", "_again")


def page_texts(sections: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, page, text), one row per page."""
    return sections.select(*keys, F.explode("pages").alias("p")).select(*keys, "p.page", F.col("p.body").alias("text"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, t) of text files of any size: line numbers from 1, within a row for short files, which are opened once and not shuffled.

    Lines of long files are counted by splits and offsets, so many tasks read one. A pattern in the last part of path
    chooses among the names of one listed folder; as a path, Spark would look at every file by itself first. The driver holds that
    listing, about 1 kB a file; millions of files are for read_spread_lines.
    """
    folder, _, name = path.rpartition("/")
    chosen = bool(folder) and bool(set(name) & set("*?[{"))
    opened, root = (spark.read.option("pathGlobFilter", name), folder) if chosen else (spark.read, path)
    files = opened.format("binaryFile").load(root)
    short = (F.col("_metadata.file_size") <= WHOLE_BYTES) & ~F.col("_metadata.file_path").rlike(PACKED)
    text = F.regexp_replace(F.col("content").cast("string"), r"\n\z", "")
    whole = files.where(short & (F.col("length") > 0)).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split(text, "\n")).alias("n", "t"))
    whole = whole.select("file", (F.col("n") + 1).cast("int").alias("line"), "t")
    # sizes and names are known from the listing: no file is opened for this
    if not files.where(~short).select("_metadata.file_path").head(1):
        return whole
    split, at = F.col("_metadata.file_block_start").alias("__s"), F.monotonically_increasing_id().alias("__i")  # ids grow along a split
    rows = opened.text(root, lineSep="\n").where(~short).select(F.col("_metadata.file_path").alias("file"), split, at, F.col("value").alias("t"))
    return whole.unionByName(sequences(rows, ["file"], ["__s", "__i"]).add(line=number()).rows().select("file", F.col("line").cast("int").alias("line"), "t"))


def read_spread_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(file, line, t) of the files that write_texts spread in a folder: file names without their folders, line numbers from 1.

    Tasks list the folders and read the files, long ones piece by piece; the driver lists the folders alone. The folder must be one that
    Arrow's file systems open.
    """
    spark.dataSource.register(NamedLines)
    return spark.read.format("named_lines").option("path", folder).load()


def _table_file(spark: SparkSession, path: str) -> DataFrame:
    """(line, t, cells) of the rows of a table in a text file, blank lines left out."""
    lines = read_lines(spark, path).select("line", strip(F.col("t")).alias("t"))
    cells = F.transform(F.split(F.regexp_replace("t", r"\A\|+|\|+\z", ""), r"\|"), strip)
    return lines.where("t <> ''").select("line", "t", cells.alias("cells"))


def read_ignores(spark: SparkSession, path: str) -> DataFrame:
    """(line, scan, folio, train, where, rules, values, note) of an ignore list.

    # begins a comment; the head and rules are left out. A row of another width, or whose numbers are none,
    fails with its file and line. Rule 0 is written `structure`.
    """
    rows = _table_file(spark, path).where(~F.startswith("t", F.lit("#")) & ~F.col("t").rlike(r"\A[|=\- ]+\z") & (F.col("cells") != F.array(*map(F.lit, IGNORE_HEAD))))
    at = F.concat(F.lit(f"{path}:"), F.col("line").cast("string"))
    fits = F.startswith("t", F.lit("|")) & (F.size("cells") == len(IGNORE_HEAD))
    rows = rows.withColumn("cells", F.when(fits, F.col("cells")).otherwise(F.raise_error(F.concat(at, F.lit(f": want a row of {len(IGNORE_HEAD)} cells: {' | '.join(IGNORE_HEAD)}")))))
    cell = lambda i: F.get("cells", F.lit(i))
    rules = F.transform(F.split(cell(4), ","), lambda r: F.when(strip(r) == "structure", 0).otherwise(strip(r).try_cast("int")))
    good = cell(0).try_cast("int").isNotNull() & ((cell(1) == "") | cell(1).try_cast("int").isNotNull()) & F.forall(rules, lambda r: r.isNotNull())
    wrong = F.raise_error(F.concat(at, F.lit(": scan and folio are numbers, rules like `2, 4` or `structure`")))
    return rows.select(
        "line", F.when(good, cell(0).try_cast("int")).otherwise(wrong).alias("scan"), cell(1).try_cast("int").alias("folio"), cell(2).alias("train"), cell(3).alias("where"),
        F.array_sort(rules).alias("rules"), F.when(cell(5) == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(cell(5), " / "), strip)).alias("values"), cell(6).alias("note"),
    )


def read_disputes(spark: SparkSession, path: str) -> DataFrame:
    """(line, scan, page, where, readings) of a list of disputes."""
    rows = _table_file(spark, path).where((F.size("cells") >= 4) & F.get("cells", F.lit(0)).rlike(r"\A\d+\z"))
    return rows.select("line", F.get("cells", F.lit(0)).cast("int").alias("scan"), *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(("page", "where", "readings"), 1)])


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    """(line, tag, form, target, count): lines of a golden sample whose first field is a tag."""
    cells = F.transform(F.split("t", r"\|"), strip)
    return read_lines(spark, path).select((F.col("line") - 1).alias("line"), cells.alias("c")).where(F.get("c", F.lit(0)).isin(TAGS)).select("line", *[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(("tag", "form", "target", "count"))])
