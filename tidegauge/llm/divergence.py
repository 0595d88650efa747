"""How the sources of a language differ in their words: counts and pair sums by DuckDB in shards, merged and ranked by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bound_batches, frugal, materialise

#: What a term is made of, what a probability is scaled to, and what is added to each count.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
ADDED = 5
#: Rows of counts that a task holds before it hands them on, and rows of a shard.
HELD = 1 << 18
SHARD = 1 << 17


def _connect() -> duckdb.DuckDBPyConnection:
    """A database in memory for one task: one thread, nothing on disk."""
    return duckdb.connect(":memory:", config={"threads": "1", "temp_directory": "", "preserve_insertion_order": "false"})


def _batches(con: duckdb.DuckDBPyConnection, sql: str) -> Iterator[pa.RecordBatch]:
    yield from con.sql(sql).to_arrow_reader(1 << 16)


COUNTS = "lang string, source string, term string, n bigint, n_docs bigint"


def _count_terms(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to COUNTS. A row is a document; the counts of a task are combined while they are few enough to hold."""
    con = _connect()
    con.execute("CREATE TABLE held (lang VARCHAR, source VARCHAR, term VARCHAR, n BIGINT, n_docs BIGINT)")
    combined = "SELECT lang, source, term, sum(n)::BIGINT AS n, sum(n_docs)::BIGINT AS n_docs FROM held GROUP BY ALL"
    rows = 0
    for batch in parts:
        docs = pa.table([batch.column(0), batch.column(1), pc.ascii_lower(batch.column(2)), pa.array(range(batch.num_rows), pa.int64())], ["lang", "source", "text", "row_id"])
        con.register("docs", docs)
        con.execute(
            f"""INSERT INTO held SELECT lang, source, term, sum(n), count(*) FROM (
                    SELECT row_id, lang, source, term, count(*) AS n
                    FROM (SELECT row_id, lang, source, unnest(regexp_extract_all(text, '{TERM}')) AS term FROM docs) GROUP BY ALL)
                GROUP BY ALL"""
        )
        con.unregister("docs")
        rows = con.execute("SELECT count(*) FROM held").fetchall()[0][0]
        if rows > HELD:
            con.execute(f"CREATE OR REPLACE TABLE held AS {combined}")
            rows = con.execute("SELECT count(*) FROM held").fetchall()[0][0]
            if 2 * rows > HELD:
                yield from _batches(con, "FROM held")
                con.execute("TRUNCATE held")
    yield from _batches(con, combined)
    con.close()


def _per_shard(sql: str, columns: str):
    """Runs sql over all rows of a partition, as a table named shard."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connect()
        con.execute(f"CREATE TABLE shard ({columns})")
        for batch in parts:
            con.register("batch", pa.Table.from_batches([batch]))
            con.execute("INSERT INTO shard BY NAME FROM batch")
            con.unregister("batch")
        yield from _batches(con, sql)
        con.close()

    return run


def kept_terms(counts: DataFrame, n_shards: int, min_docs: int) -> DataFrame:
    """(lang, source, term, n, n_lang, first): counts of the terms in at least min_docs documents of their language, with the language's count; first is 1 once a term."""
    sql = f"""SELECT lang, source, term, n, sum(n) OVER w::BIGINT AS n_lang, (row_number() OVER (w ORDER BY source) = 1)::BIGINT AS first
              FROM shard WINDOW w AS (PARTITION BY lang, term) QUALIFY sum(n_docs) OVER w >= {min_docs}"""
    run = _per_shard(sql, "lang VARCHAR, source VARCHAR, term VARCHAR, n BIGINT, n_docs BIGINT")
    return counts.repartition(n_shards, "lang", "term").mapInArrow(frugal(run), "lang string, source string, term string, n bigint, n_lang bigint, first bigint")


def shared_sums(scored: DataFrame, n_shards: int) -> DataFrame:
    """(lang, source, other, part): for source < other, over the terms that both have, what their difference adds to that of each against the other's unseen terms."""
    sql = """SELECT a.lang, a.source, b.source AS other, sum(abs(a.p - b.p) - abs(a.p - b.p0) - abs(a.p0 - b.p) + abs(a.p0 - b.p0))::BIGINT AS part
             FROM shard a JOIN shard b ON a.lang = b.lang AND a.term = b.term AND a.source < b.source GROUP BY ALL"""
    run = _per_shard(sql, "lang VARCHAR, source VARCHAR, term VARCHAR, p BIGINT, p0 BIGINT")
    sums = scored.select("lang", "source", "term", "p", "p0").repartition(n_shards, "lang", "term").mapInArrow(frugal(run), "lang string, source string, other string, part bigint")
    return sums.groupBy("lang", "source", "other").agg(F.sum("part").alias("part"))


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + ADDED) / (total + ADDED * terms)), exact beyond 64 bits; null without terms."""
    top, below = f"CAST({n} + {ADDED} AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(10, 0))", f"CAST({total} + {ADDED} * {terms} AS DECIMAL(20, 0))"
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + ({top}) div ({below}) END")


def _ranked(df: DataFrame, part: str, item: str, most: int | None = None) -> DataFrame:
    at = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), item))
    out = df.select("lang", "source", F.lit(part).alias("part"), F.col(item).alias("item"), "value", at.alias("rank"))
    return out if most is None else out.where(F.col("rank") <= most)


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 30, top: int = 50) -> DataFrame:
    r"""(lang, source, part, item, value, rank): how each source of a language differs from the others and from the language.

    Terms are the matches of TERM in the texts, A-Z lower-cased. A language keeps its V terms that at least min_docs of its
    rows hold. A source gives each kept term p = 1 + floor(SCALE (n + ADDED) / (N + ADDED V)), n its occurrences there, N their sum;
    the language does so with all its rows. Part `pair` ranks all other sources of the language by the sum of |p - q| over all
    kept terms; part `term` ranks the source's terms with p above the language's q by p - q, down to `top`. Ties go by the item's bytes.

    Null texts, languages and sources count as ''. Each row is a document, repeated or not. A source without terms takes part with n = 0; a
    language without kept terms gives pairs of value 0 and no terms; one source alone has no pairs; an empty table gives
    no rows; other columns are ignored.

    Terms that one of two sources lacks are not spelt out: with p0 the share of an unseen term, the sum over all kept terms is
    V |a0 - b0|, plus for either source the sum of |p - b0| - |a0 - b0| over its own terms (by distinct p), plus shared_sums. A term
    is at most one row for each source when it reaches its shard, however frequent it is.
    """
    bound_batches(docs.sparkSession)
    src = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    parts = src.mapInArrow(frugal(_count_terms), COUNTS)
    counts = materialise(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")), "term-counts")
    n_shards = max(docs.sparkSession.sparkContext.defaultParallelism, counts.count() // SHARD + 1)
    kept = materialise(kept_terms(counts, n_shards, min_docs), "kept-terms")

    of_lang = kept.groupBy("lang").agg(F.sum("first").alias("terms"), F.sum("n").alias("lang_total"))
    of_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = src.select("lang", "source").distinct().join(of_lang, "lang", "left").join(of_source, ["lang", "source"], "left")
    groups = groups.na.fill(0, ["terms", "lang_total", "total"]).withColumn("p0", share("0", "total", "terms"))
    groups = materialise(groups, "sources")
    scored = kept.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "terms")).withColumn("q", share("n_lang", "lang_total", "terms"))
    scored = materialise(scored.select("lang", "source", "term", "p", "p0", "q"), "shares")

    pairs = groups.select("lang", "source", "p0", "terms").join(groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("b0")), "lang").where("source <> other")
    alike = scored.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    own = pairs.join(alike, ["lang", "source"]).groupBy("lang", "source", "other").agg(F.expr("sum(times * (abs(p - b0) - abs(p0 - b0)))").alias("part"))
    both = shared_sums(scored, n_shards)

    def turned(df: DataFrame) -> DataFrame:
        return df.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "part")

    unseen = pairs.select("lang", "source", "other", F.expr("coalesce(terms * abs(p0 - b0), 0)").alias("part"))
    summed = unseen.unionByName(own).unionByName(turned(own)).unionByName(both).unionByName(turned(both))
    summed = summed.groupBy("lang", "source", "other").agg(F.sum("part").alias("value"))
    higher = scored.where("p > q").select("lang", "source", "term", F.expr("p - q").alias("value"))
    return _ranked(summed, "pair", "other").unionByName(_ranked(higher, "term", "term", top))
