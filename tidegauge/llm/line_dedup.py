"""Lines that many documents share: exploded, hashed, counted by document, dropped, and the rest put together by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import ascii_lower, materialise

#: Fixed value: what is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased; a line of ASCII only takes the faster lower()."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(ascii_lower(bare))


def _hashes(key: str) -> list[Column]:
    """128 bits of a key as two numbers with seeds of their own."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), F.col(key)).alias("h2")]


def frequent_lines(src: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """(h1, h2, n_docs) of the keys found in at least min_docs rows of src (lines: array of strings), written once.

    A row counts a key once, so the distinct keys of a row are taken before they are exploded and counts need
    no document ids; they are combined before the shuffle, which a hot line needs.
    """
    keys = F.array_distinct(F.filter(F.transform("lines", line_key), lambda k: F.length(k) >= min_chars))
    counted = src.select(F.explode(keys).alias("key")).select(*_hashes("key")).groupBy("h1", "h2").agg(F.count("*").alias("n_docs"))
    return materialise(counted.where(F.col("n_docs") >= min_docs), "frequent-lines")


def dropped_positions(src: DataFrame, frequent: DataFrame, min_chars: int) -> DataFrame:
    """(of, gone): for rows of src (of, lines) with a frequent line the positions of all such lines, written once.

    Only hashes and positions move, and only those that a Bloom filter lets through. A hot line is one row of
    `frequent`, so adaptive execution can split its side of the join.
    """
    n_blocks = bloom.blocks_for(frequent.count())
    words = bloom.build(frequent.select("h1"), "h1", n_blocks).scalar()
    lines = src.select("of", F.posexplode(F.transform("lines", line_key)).alias("at", "key")).where(F.length("key") >= min_chars)
    hits = lines.select("of", "at", *_hashes("key")).where(bloom.may_contain(words, F.col("h1"), n_blocks))
    found = hits.join(frequent.select("h1", "h2"), ["h1", "h2"])
    return materialise(found.groupBy("of").agg(F.collect_set("at").alias("gone")), "dropped-lines")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    r"""(id_col, n_lines, n_dropped, kept_text), one row per row of docs.

    A text is split at \n. A line's key is the line without white space at its ends and with A-Z in lower case. Keys
    of at least min_chars code points that at least min_docs rows hold lose all their lines in every row; the others
    stay in their order, joined by \n. Keys are compared by 128-bit hashes.

    Null and empty texts have one empty line, which stays. Each row counts as a document, also where ids are null or
    repeated; rows with the same id and text have the same result. A text whose lines all go becomes empty.
    An empty table gives no rows; other columns are ignored. A row is the largest group: what is gathered by row are
    the positions of its own lines. Texts without a frequent line are not moved.
    """
    of = F.concat_ws(":", "id", F.sha2("text", 256))
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("lines", F.split("text", "\n"))
    frequent = frequent_lines(src, min_docs, min_chars)
    gone = dropped_positions(src.withColumn("of", of), frequent, min_chars)
    n_blocks = bloom.blocks_for(gone.count())
    words = bloom.build(gone.select("of"), "of", n_blocks).scalar()
    keyed = src.select("id", "text", of.alias("of")).withColumn("hit", bloom.may_contain(words, F.col("of"), n_blocks))
    whole = keyed.where("not hit").select("id", F.size(F.split("text", "\n")).alias("n_lines"), F.lit(0).alias("n_dropped"), F.col("text").alias("kept"))
    cut = keyed.where("hit").drop("hit").join(gone, "of", "left").select("id", F.split("text", "\n").alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.concat_ws("\n", F.transform(left, lambda at: F.get("lines", at)))
    cut = cut.select("id", F.size("lines").alias("n_lines"), F.size("gone").alias("n_dropped"), kept.alias("kept"))
    both = whole.unionByName(cut)
    return both.select(F.col("id").alias(id_col), F.col("n_lines").cast("bigint"), F.col("n_dropped").cast("bigint"), F.col("kept").alias("kept_text"))
