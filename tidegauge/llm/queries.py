"""One query for each training-data operator, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality, toxicity
from .bpe import bpe_round_trip
from .common import table
from .divergence import source_divergence
from .exact_dedup import exact_dedup
from .hmm import lm_score
from .line_dedup import line_dedup
from .packing import pack
from .periodic import periodic_runs
from .simhash import simhash_near_dedup
from .suffix_dedup import suffix_dedup
from .url_filter import url_filter
from .vector_dedup import vector_near_dedup

#: (host, path, verdict)
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter(table(spark, sf_dir, "pages"), listed)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_near_dedup(table(spark, sf_dir, "embeddings"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.grade(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def _planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents the words from some place on repeat with some period, as the contract of op12 says."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    src = docs.select("doc_id", "text", h.alias("h"), F.expr("crc32(CAST(doc_id AS STRING)) div 10").alias("g"))
    picked = F.when(F.col("h") % 10 == 0, words)
    src = src.select("doc_id", "text", "g", picked.alias("words")).select("*", F.size("words").alias("n"))
    src = src.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int").alias("a"))
    src = src.select("*", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)").alias("p"))
    cycles = F.expr("flatten(array_repeat(slice(words, a + 1, p), CAST((n - a) div p AS INT) + 1))")
    text = F.concat_ws(" ", F.concat(F.slice("words", 1, F.col("a")), F.slice(cycles, 1, F.col("n") - F.col("a"))))
    return src.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_planted(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    spans = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws("", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    out = found.select("*", best.alias("best"))
    return out.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(spans, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_packing": op2_packing,
    "op3_vector_near_dedup": op3_vector_near_dedup,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_lm_score": op5_lm_score,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_line_dedup": op11_line_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_source_divergence": op13_source_divergence,
}

_FITS = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{{i}}}"
    for i, (h, p, _) in sorted(enumerate(URL_RULES), key=lambda r: -len(r[1][0] + r[1][1]))
)
ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": rf"""
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
            FROM pages)
        SELECT page_id, host, path,
               CASE {_FITS.format(*[f"'{h}{p}'" for h, p, _ in URL_RULES])} END AS rule,
               CASE {_FITS.format(*[f"'{v}'" for _, _, v in URL_RULES])} ELSE 'allow' END AS verdict
        FROM parts""",
    "op7_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
             g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
        FROM t JOIN g USING (text)""",
    "op11_line_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
             l AS (SELECT row_id, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
             k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
             f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row_id) >= 10),
             m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM m GROUP BY row_id, doc_id""",
    "op13_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
             t AS (SELECT row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
             k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30),
             c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
             g AS (SELECT DISTINCT lang, source FROM d),
             f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
                   FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
             p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS p
                   FROM f WINDOW w AS (PARTITION BY lang, source)),
             l AS (SELECT lang, term, sum(n) AS n FROM f GROUP BY lang, term),
             q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER w + 5 * count(*) OVER w) AS q
                   FROM l WINDOW w AS (PARTITION BY lang)),
             s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
                   FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
             pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
                       FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                       LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
             terms AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
             ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
                        UNION ALL
                        SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
        SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
}
