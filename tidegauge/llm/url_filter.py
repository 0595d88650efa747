"""Judging URLs by a list of canonical URL prefixes (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import ascii_lower

#: A list of at most so many rows is broadcast (its rows are short strings); a longer one is shuffled.
BROADCAST_ROWS = 100_000
#: Between host and path in a key, so that a path without a slash is not taken for the end of a host.
SEPARATOR = "\n"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def canonical(url):
    """(host, path) of a URL; both empty where it is null or has no ://."""
    u = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(u, URL, 1)), F.regexp_extract(u, URL, 2)


def url_filter(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Rows (id_col, host, path, rule, verdict), one per row of pages.

    `listed` has (host, path, verdict): a row fits a URL whose host is that
    host or a subdomain and whose path starts with that path. The longest
    fitting host+path wins; of equal ones the smallest verdict ("allow" before
    "block"). A URL that nothing fits has rule null and verdict `default`.

    A blocked Bloom filter of the listed hosts with their paths tests each
    URL's candidate prefixes; only possible hits reach the exact hash join,
    which removes the false ones. Rows with no possible hit never move.

    Null ids pass through; null or malformed URLs have empty host and path;
    repeated rows are judged one by one; an empty list or page table is
    allowed; other columns of pages are ignored, whatever their names.
    """
    keyed = listed.select(
        ascii_lower(F.coalesce("host", F.lit(""))).alias("lh"), F.coalesce("path", F.lit("")).alias("lp"), F.col("verdict").alias("lv")
    ).select(F.concat_ws(SEPARATOR, "lh", "lp").alias("key"), "lh", "lp", "lv")
    exact = keyed.groupBy("key").agg(F.min("lv").alias("verdict"))
    shape = keyed.agg(
        F.count("*").alias("n"),
        F.array_sort(F.collect_set(F.length("lp"))).alias("lens"),
        F.array_sort(F.collect_set(F.size(F.split("lh", r"\.")))).alias("labels"),
    ).first()
    n_blocks = bloom.blocks_for(shape.n)
    words = bloom.build(keyed.select("key"), "key", n_blocks).scalar()

    host, path = canonical(F.col(url_col))
    base = pages.select(F.col(id_col), F.col(url_col)).select(F.col(id_col), host.alias("host"), path.alias("path"))
    parts = F.split("host", r"\.")
    hosts = F.transform(
        F.filter(F.array(*[F.lit(n) for n in shape.labels]).cast("array<int>"), lambda n: n <= F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."),
    )
    lens = F.filter(F.array(*[F.lit(n) for n in shape.lens]).cast("array<int>"), lambda n: n <= F.length("path"))
    cands = F.flatten(F.transform(hosts, lambda h: F.transform(lens, lambda n: F.concat(h, F.lit(SEPARATOR), F.substring(F.col("path"), F.lit(1), n)))))
    hits = base.withColumn("words", words)  # a column of its own: a subquery may not stand inside filter()
    hits = hits.withColumn("hits", F.filter(cands, lambda k: bloom.may_contain(F.col("words"), k, n_blocks))).drop("words")

    none = hits.where(F.size("hits") == 0).select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    some = hits.where(F.size("hits") > 0).withColumn("row", F.monotonically_increasing_id()).withColumn("key", F.explode("hits")).drop("hits")
    joined = some.join(F.broadcast(exact) if shape.n <= BROADCAST_ROWS else exact, "key", "left")
    found = F.max(F.when(F.col("verdict").isNotNull(), F.struct(F.length("key").alias("n"), F.col("key"), F.col("verdict"))))
    judged = (
        joined.groupBy("row")
        .agg(F.first(id_col).alias(id_col), F.first("host").alias("host"), F.first("path").alias("path"), found.alias("found"))
        .select(id_col, "host", "path", F.regexp_replace("found.key", r"\A([^\n]*)\n", "$1").alias("rule"), F.coalesce("found.verdict", F.lit(default)).alias("verdict"))
    )
    return none.unionByName(judged)
