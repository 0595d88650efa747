"""Packing documents into sequences by cutting-stock column generation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, map_ids
from .wordids import WordEncoder

#: Length classes of a sequence: the linear program has so many rows at most, whatever the corpus.
CLASSES = 128


def price(values: np.ndarray) -> tuple[float, np.ndarray]:
    """Unbounded knapsack over a capacity of len(values) units, item i taking i+1: (best value, counts)."""
    m = len(values)
    best, took = np.zeros(m + 1), np.zeros(m + 1, np.int64)
    for cap in range(1, m + 1):
        worth = values[:cap] + best[cap - 1 :: -1][:cap]
        i = int(worth.argmax())
        best[cap], took[cap] = (worth[i], i + 1) if worth[i] > best[cap - 1] else (best[cap - 1], 0)
    counts = np.zeros(m, np.int64)
    cap = m
    while cap:
        if took[cap]:
            counts[took[cap] - 1] += 1
            cap -= took[cap]
        else:
            cap -= 1
    return float(best[m]), counts


def cutting_stock(demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Patterns with multiplicities that hold at least demand[i] items of i+1 units, sequences of len(demand) units.

    The linear program starts from one-length patterns; the knapsack
    prices new ones until none improves it. Its solution is rounded down and what
    is left (at most a few patterns a class) is filled first-fit, longest first.
    """
    m = len(demand)
    demand = np.asarray(demand, np.int64)
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    columns = np.diag([m // (i + 1) for i in range(m)]).astype(np.float64)
    d = demand.astype(np.float64)
    inverse = np.diag(1 / np.diag(columns))
    last, idle = np.inf, 0
    while True:  # each step lowers the program's value or keeps it; those that keep it are counted
        x = (inverse * d).sum(axis=1)
        duals = inverse.sum(axis=0)
        last, idle = (x.sum(), 0) if x.sum() < last - 1e-9 * max(1.0, last if np.isfinite(last) else 0) else (last, idle + 1)
        if idle > 4 * m:  # degenerate: no better bound is coming from these bases
            break
        worth, counts = price(np.where(demand > 0, duals, 0))
        if worth <= 1 + 1e-7:
            break
        step = (inverse * counts).sum(axis=1)
        ratio = np.where(step > 1e-9, np.maximum(x, 0) / np.where(step > 1e-9, step, 1), np.inf)
        if not np.isfinite(ratio.min()):
            break
        out = int(ratio.argmin())
        columns[:, out] = counts
        row = inverse[out] / step[out]
        step[out] = 0
        inverse -= step[:, None] * row
        inverse[out] = row
    x = np.maximum((inverse * d).sum(axis=1), 0)
    plan: list[tuple[np.ndarray, int]] = []
    left = demand.copy()
    for j in np.argsort(-x, kind="stable"):
        pattern = columns[:, j].astype(np.int64)
        if not pattern.any():
            continue
        times = int(min(np.floor(x[j] + 1e-9), *(left[pattern > 0] // pattern[pattern > 0])))
        if times > 0:
            plan.append((pattern, times))
            left -= pattern * times
    while left.any():
        pattern, room = np.zeros(m, np.int64), m
        for i in range(m - 1, -1, -1):
            n = min(int(left[i]), room // (i + 1))
            pattern[i] = n
            room -= n * (i + 1)
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        plan.append((pattern, times))
        left -= pattern * times
    return plan


def _assign(plan: list[tuple[np.ndarray, int]]):
    """(class, rank) -> sequence: each class's ranks are dealt to the patterns in the plan's order."""
    m = len(plan[0][0]) if plan else 0
    ends, per, first = [[[] for _ in range(m)] for _ in range(3)]
    base, total = 0, np.zeros(m, np.int64)
    for pattern, times in plan:
        for i in np.flatnonzero(pattern):
            total[i] += pattern[i] * times
            ends[i].append(int(total[i]))
            per[i].append(int(pattern[i]))
            first[i].append(base)
        base += times
    tables = [tuple(np.array(a[i], np.int64) for a in (ends, per, first)) for i in range(m)]

    def sequence(cls: pd.Series, rank: pd.Series) -> pd.Series:
        out = np.zeros(len(cls), np.int64)
        c, r = cls.to_numpy(), rank.to_numpy()
        for i in np.unique(c):
            own = c == i
            e, p, f = tables[i - 1]
            at = np.searchsorted(e, r[own], side="right")
            start = np.concatenate([[0], e])[at]
            out[own] = f[at] + (r[own] - start) // p[at]
        return pd.Series(out)

    return sequence


def cut(docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 2048, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens[, ids]): each document's ids and end_id, cut at multiples of `length`.

    Null text counts as empty and gives the one id end_id.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = WordEncoder.load(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for pdf in parts:
            rows = []
            for i, t in zip(pdf["id"], pdf["text"]):
                blob = encoder.ids(t) + end
                n = len(blob) // 4
                for at in range(0, n, length):
                    own = blob[4 * at : 4 * (at + length)]
                    rows.append((i, at, len(own) // 4, zlib.crc32(own), n, own if with_ids else None))
            out = pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
            out["id"] = out["id"].astype("Int64")
            yield out if with_ids else out.drop(columns="ids")
        encoder.forget()  # the worker lives on; its memory is for the next stage

    schema = "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids binary" * with_ids
    return map_ids(docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")), run, schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 2048, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents and their places in sequences of at most `length` ids.

    (id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).
    Documents are tokenised once and cut at multiples of `length`; the pieces'
    lengths, in CLASSES classes (each rounded up, so patterns always fit), make a
    histogram. Column generation solves the cutting-stock program over it on the
    driver, whose size does not depend on the corpus. Pieces are ranked inside
    their class by hash buckets with counted offsets, so no class is
    sorted in one task, and rank r of a class goes to the pattern whose range
    holds r. Offsets in a sequence are gapless from 0, longest piece first.

    Null ids and repeated rows are packed like others; an empty table gives no
    rows; other columns are ignored. `length` must be a multiple of CLASSES.
    """
    if length % CLASSES:
        raise ValueError(f"length must be a multiple of {CLASSES}")
    unit = length // CLASSES
    pieces = materialise(cut(docs, tokenizer_path, end_id, length, with_ids, id_col, text_col), "pieces")
    pieces = pieces.withColumn("cls", F.ceil(F.col("length") / unit).cast("int"))
    histogram = pieces.groupBy("cls").count().collect()  # CLASSES rows at most
    demand = np.zeros(CLASSES, np.int64)
    for r in histogram:
        demand[r["cls"] - 1] = r["count"]
    sequence = F.pandas_udf(_assign(cutting_stock(demand)), T.LongType())

    buckets = int(min(65536, max(1, -(-int(demand.sum()) // 256))))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "start"), F.lit(buckets)).cast("int"))
    before = pieces.groupBy("cls", "bucket").agg(F.count("*").alias("n"))
    before = before.select("cls", "bucket", (F.sum("n").over(Window.partitionBy("cls").orderBy("bucket")) - F.col("n")).alias("before"))
    ranked = pieces.withColumn("local", F.row_number().over(Window.partitionBy("cls", "bucket").orderBy("id", "start", "ids_crc32", "length", "doc_tokens")))
    ranked = ranked.join(before, ["cls", "bucket"]).withColumn("rank", F.col("before") + F.col("local") - 1)
    dealt = ranked.withColumn("sequence_id", sequence("cls", "rank"))
    along = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "cls", "rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("offset", F.coalesce(F.sum("length").over(along), F.lit(0)).cast("bigint"))
    return placed.select(F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids)
