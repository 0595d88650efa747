"""A bounded sample of labelled documents to fit a model on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_of(id_col, folds: int):
    """crc32 of the id as text, modulo `folds`; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)), F.lit(-1)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, max_rows: int, folds: int, held: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label) of at most `max_rows` labelled ids outside fold `held`, one row an id.

    Where there are more, ids are taken by a threshold on their hash, so the choice does not depend on
    their place, source or label. Null labels and ids are left out; of an id's several
    labels the smallest holds, and of its several texts the first in order. The chosen ids are few by that bound and are broadcast.
    """
    own = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    own = own.where(fold_of(F.col("id"), folds) != held).groupBy("id").agg(F.min("label").alias("label"))
    n = own.count()
    if n > max_rows:
        own = own.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit((max_rows << 30) // n)).limit(max_rows)
    text = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return text.join(F.broadcast(own), "id").groupBy("id", "label").agg(F.min("text").alias("text")).select("text", "label")
