"""Collapsing findings that own the same cells into one."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.fuzzy import components
from tidegauge.operators.scan import lag, running_sum, sequences, split_long
from tidegauge.sources.shared import stage


def _parts(long: DataFrame, keys: list[str], cells: str) -> DataFrame:
    """Rows of long keys with `_part`: the least cell that their cells reach over the key's findings. Only cells of one part can have one owner."""
    long = stage(long, "long")
    first = F.struct(*keys, F.col("_a").alias("c"))
    edges = long.where(F.size(cells) > 1).select(*keys, F.get(cells, F.lit(0)).alias("_a"), F.explode(cells).alias("_b")).where("_a <> _b")
    found = components(edges.select(first.alias("u"), F.struct(*keys, F.col("_b").alias("c")).alias("v")))
    named = long.withColumn("_a", F.get(cells, F.lit(0))).withColumn("_node", first)
    return named.join(found, F.col("_node") == F.col("node"), "left").select(*long.columns, F.coalesce("component.c", "_a").alias("_part"))


def _walk(keys: list[str], seq: str, cells: str, out: str):
    """The fold over sorted rows, batch by batch; what is held are the owners of the open part's cells."""

    def plain(x):
        return tuple(x.values()) if isinstance(x, dict) else x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, owner = None, {}
        for batch in batches:
            got = []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (*keys, "_part", seq, cells)]
            for *key, part, n, own in zip(*columns):
                if at != (here := (*key, plain(part))):
                    at, owner = here, {}
                own = [plain(c) for c in own or ()]
                cluster = next((owner[c] for c in own if c in owner), n)
                owner.update(dict.fromkeys(own, cluster))
                got.append(cluster)
            yield batch.append_column(out, pa.array(got, batch.column(batch.schema.get_field_index(seq)).type))

    return run


def clusters(findings: DataFrame, keys: list[str], seq: str, cells: str, out: str = "cluster") -> DataFrame:
    """findings with `out`: the `seq` of the first finding of their cluster; seq numbers the findings of a key.

    In order of emission a finding joins the cluster that owns the first of its cells that has an owner, and then all
    of its cells point to that cluster; otherwise it opens one. Findings without cells (or null) stay alone. The outcome depends on the order, so
    it is a fold, but only findings that are linked by shared cells can meet in a cluster: a key with
    very many findings is first split into the connected components of its cells, and each of them is folded by itself.
    Null cells are cells like others.
    """
    short, long, _ = split_long(findings, keys)
    cell = findings.schema[cells].dataType.elementType
    rows = short.withColumn("_part", F.lit(None).cast(cell))
    if long is not None:
        rows = rows.unionByName(_parts(long, keys, cells))
    sorted_ = rows.repartition(*keys, "_part").sortWithinPartitions(*keys, "_part", seq)
    schema = T.StructType([*sorted_.schema.fields, T.StructField(out, findings.schema[seq].dataType)])
    return sorted_.mapInArrow(_walk(keys, seq, cells, out), schema).drop("_part")


def collapse(findings: DataFrame, keys: list[str], seq: str, cells: str, **columns: Column) -> DataFrame:
    """(keys, columns...): one row per cluster of findings, each column an aggregate of its findings."""
    return clusters(findings, keys, seq, cells, "_cluster").groupBy(*keys, "_cluster").agg(*[c.alias(n) for n, c in columns.items()]).drop("_cluster")


def merge_runs(findings: DataFrame, keys: list[str], first: str, last: str, min_size: int = 3, ties: list[str] | None = None) -> DataFrame:
    """(keys..., first, last, size): runs of at least min_size findings on adjoining rows; each is compared with the one before only."""
    rows = sequences(findings, keys, [first, last, *(ties or [])]).add(_b=lag(last))
    rows = rows.each(lambda d: d.withColumn("_n", F.when(F.col(first) <= F.col("_b") + 1, 0).otherwise(1))).add(_g=running_sum("_n"))
    runs = rows.rows().groupBy(*keys, "_g").agg(F.min(first).alias("first"), F.max(last).alias("last"), F.count("*").alias("size"))
    return runs.where(F.col("size") >= min_size).drop("_g")
