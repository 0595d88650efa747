"""Periodic runs of words in documents: found in linear size, given as spans, and collapsed to one period."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, frugal
from .tandem import runs

#: Odd multiplier of the rolling hash, modulo 2**64.
MIX = np.uint64(0x9E3779B97F4A7C15)
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = "id string, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _repeated(seq: np.ndarray, part: np.ndarray, width: int) -> np.ndarray:
    """For each number whether it lies in a stretch of `width` numbers of its part that the part holds twice (or seems to: hashes decide)."""
    n = len(seq) - width + 1
    covered = np.zeros(len(seq), bool)
    if n < 1:
        return covered
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h = (h + seq[i : i + n].astype(np.uint64)) * MIX
        h ^= h >> np.uint64(29)
    h = (h + part[:n].astype(np.uint64)) * MIX
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return covered
    hit = (twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h) & (part[:n] == part[width - 1 :])
    edge = np.zeros(len(seq) + 1, np.int64)
    edge[:n][hit] += 1
    edge[width : width + n][hit] -= 1
    return np.cumsum(edge[:-1]) > 0


def candidate_stretches(seq: np.ndarray, part: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of stretches that hold every run of at least min_words, each inside one part.

    A run of length L and period q repeats L - q words, at least half of max(min_words, 2q), at a distance of q, so each of its words
    lies in a stretch of (min_words + 1) // 2 words that occurs twice in the part, and all of it in one chain of such
    words; so does every word by which it could be longer. Chains are searched again as parts of their own, while that takes words away.
    """
    width = max(1, (min_words + 1) // 2)
    at = np.arange(len(seq))
    while True:
        inside = _repeated(seq[at], part, width)
        at, part = at[inside], part[inside]
        if not len(at):
            return at, at
        breaks = np.flatnonzero((np.diff(at) > 1) | (np.diff(part) != 0)) + 1
        start, end = np.append(0, breaks), np.append(breaks, len(at))
        long = end - start >= max(min_words, 2)
        part = np.repeat(np.arange(len(start)), end - start)
        if inside.all() and long.all():
            return at[start], at[end - 1] + 1
        keep = np.repeat(long, end - start)
        at, part = at[keep], part[keep]


def word_runs(docs: list[np.ndarray], min_words: int) -> list[np.ndarray]:
    """For each document (its words as numbers from 0) rows (start, length, period) of its runs of at least min_words words.

    All candidate stretches of all documents go through one search, as numbers that no two documents share and with marks between them.
    """
    none = np.empty((0, 3), np.int64)
    sizes = np.array([len(d) for d in docs])
    if not sizes.sum():
        return [none] * len(docs)
    kinds = np.array([d.max() + 1 if len(d) else 0 for d in docs])
    seq = np.concatenate(docs) + np.repeat(np.cumsum(kinds) - kinds, sizes)
    owner, first = np.repeat(np.arange(len(docs)), sizes), np.cumsum(sizes) - sizes
    start, end = candidate_stretches(seq, owner, min_words)
    if not len(start):
        return [none] * len(docs)
    size = end - start
    laid = np.cumsum(size + 1) - size - 1  # where each stretch begins, with a mark after it
    total = int(size.sum()) + len(size)
    joined, marks = np.empty(total, np.int64), laid + size
    inner = np.ones(total, bool)
    inner[marks] = False
    source = np.repeat(start - laid, size + 1) + np.arange(total)
    joined[inner] = np.unique(seq[source[inner]], return_inverse=True)[1]
    joined[marks] = total + np.arange(len(marks))
    found = runs(joined)
    found = found[found[:, 1] >= min_words]
    found[:, 0] = source[found[:, 0]]
    of = owner[found[:, 0]]
    found[:, 0] -= first[of]
    cut = np.searchsorted(of, np.arange(len(docs) + 1))
    return [found[cut[i] : cut[i + 1]] for i in range(len(docs))]


def _collapse(words: list[bytes], found: np.ndarray) -> bytes:
    """The words, but of each run only its first period, joined by one space."""
    if not len(found):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def _finder(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [(t or b"").split() for t in batch.column(1).cast(pa.large_binary()).to_pylist()]  # bytes part at \x20 and \x09-\x0D alone
            docs = []
            for words in split:
                known: dict[bytes, int] = {}
                docs.append(np.array([known.setdefault(w, len(known)) for w in words], np.int64))
            found = word_runs(docs, min_words)
            del docs
            flat = np.concatenate([*found, np.empty((0, 3), np.int64)])
            ends = np.cumsum([0, *map(len, found)])
            rows = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(RUNS.value_type))
            spans = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)
            texts = pa.array([_collapse(w, r).decode() for w, r in zip(split, found)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(w) for w in split], pa.int64()), spans, texts], ["id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 12) -> DataFrame:
    r"""(id_col, n_words, runs, collapsed), one row per row of docs.

    Words are what [\x20\x09-\x0D]+ parts. A run is a stretch of words with smallest period q and a length of at least
    max(min_words, 2q) that no neighbour extends; runs are given as (start, length, period) by start, then period. Collapsed are
    the words that no run holds after its first q words, joined by a space.

    Null and empty texts have no words, no runs and an empty collapsed text. Null and repeated ids are kept as they are;
    empty tables give no rows; other columns are ignored. Nothing is shuffled. A text is read by one task as a whole; memory is
    some hundred bytes for each word of the Arrow batch's (or one longer text's) repeated stretches.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = src.mapInArrow(frugal(_finder(min_words)), SCHEMA.replace("id string", f"id {kind}", 1))
    return out.withColumnRenamed("id", id_col)
