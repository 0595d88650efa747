"""Applying per-document decisions to a table of documents without moving the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom


def fresh(docs: DataFrame, name: str) -> str:
    """A column name like `name` that docs does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _split(docs: DataFrame, key: Column, few: DataFrame) -> tuple[DataFrame, DataFrame, str] | None:
    """(rows whose key may be in few.key, with it, the others, its name); None where few has no rows. Null keys are never in it."""
    n = few.count()
    if not n:
        return None
    n_blocks = bloom.blocks_for(n)
    words = bloom.build(few.select("key"), "key", n_blocks).scalar()
    name, hit = fresh(docs, "key"), fresh(docs, "hit")
    keyed = docs.withColumn(name, key).withColumn(hit, F.coalesce(bloom.may_contain(words, F.col(name), n_blocks), F.lit(False)))
    return keyed.where(F.col(hit)).drop(hit), keyed.where(~F.col(hit)).drop(hit, name), name


def drop_rows(docs: DataFrame, key: Column, few: DataFrame) -> DataFrame:
    """docs without the rows whose key is in few.key (unique, materialised). Only possible hits reach the exact anti join."""
    parts = _split(docs, key, few)
    if parts is None:
        return docs
    hits, rest, name = parts
    other = fresh(hits, "gone")
    return rest.unionByName(hits.join(few.select(F.col("key").alias(other)), F.col(name) == F.col(other), "left_anti").drop(name))


def replace_text(docs: DataFrame, key: Column, few: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """docs with the texts of few (key, new_text) in place of their own; the length column, if there is one, follows."""
    parts = _split(docs, key, few)
    if parts is None:
        return docs
    hits, rest, name = parts
    other, new = fresh(hits, "of"), fresh(hits, "new")
    joined = hits.join(few.select(F.col("key").alias(other), F.col("new_text").alias(new)), F.col(name) == F.col(other), "left")
    changed = {text_col: F.coalesce(new, text_col)}
    if length_col in docs.columns:
        changed[length_col] = F.when(F.col(new).isNotNull(), F.length(new).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return rest.unionByName(joined.withColumns(changed).select(*docs.columns))
