"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before
it kept; all but the last return the columns of documents. SQL can express
none of toxicity, SimHash, suffix matching and packing, so ORACLE_SQL is None
and tests/llm holds each stage against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import toxicity
from tidegauge.llm.common import materialise, table
from tidegauge.llm.decide import drop_rows, replace_text
from tidegauge.llm.exact_dedup import exact_dedup
from tidegauge.llm.packing import pack
from tidegauge.llm.simhash_similar import similar_groups
from tidegauge.llm.suffix_dedup import suffix_dedup


def _own_key():
    """A row's id and the digest of its text: rows that share it are the same document."""
    return F.concat_ws(":", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity operator scores below one half.

    Null and empty texts have no hits and stay; repeated rows go or stay together;
    an empty table gives an empty one.
    """
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(lexicon)(F.coalesce("text", F.lit(""))) < 0.5)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id.

    A null text counts as empty. A null doc_id is the least; a group of only null ids keeps
    its rows, as rows that share doc_id and text are the same document. An empty table gives an empty one.
    """
    marks = exact_dedup(docs).where("not kept")
    return drop_rows(docs, _own_key(), materialise(marks.select(F.concat_ws(":", "doc_id", "text_sha256").alias("key")).distinct(), "dropped"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of five-word shingles of 0.8 or more the row with the smallest doc_id, null ids last, then the smallest digest.

    Rows without words are in no group. Rows that share doc_id and text stay or go together.
    """
    marks = similar_groups(docs).select(F.concat_ws(":", "doc_id", "text_sha256").alias("key"), F.concat_ws(":", "keep_id", "keep_sha256").alias("keep"))
    return drop_rows(docs, _own_key(), materialise(marks.where("key <> keep").select("key").distinct(), "dropped"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without byte strings that repeat elsewhere; n_chars follows.

    Null and empty texts stay as they are; repeated rows remove each other's text; an
    empty table gives an empty one.
    """
    cut = suffix_dedup(docs, with_text=True).where("n_removed > 0")
    return replace_text(docs, _own_key(), materialise(cut.select(F.concat_ws(":", "doc_id", "text_sha256").alias("key"), F.col("kept_text").alias("new_text")).dropDuplicates(["key"]), "changed"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens; a null or empty text is its end token alone."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
