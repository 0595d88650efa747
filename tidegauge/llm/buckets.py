"""Verified links between the members of hash buckets, for any bucket size.

Members come as (keys..., id, payload). A bucket is dealt out in blocks of about
`BLOCK` members; each pair of blocks is a task-sized group of its own, so a
bucket of any size spreads over the cluster and no group is unbounded. Pairs are
compared inside a group with numpy and never leave it: what leaves is, for each
member, a star edge to the smallest member it is connected with and the weight of
its links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, materialise

BLOCK = 512
STEP = 1 << 18


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over edges (a, b)."""
    root = np.arange(n)
    while len(a):
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def group_pairs(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of equal codes, where equal codes are adjacent; in steps of bounded size."""
    n = len(codes)
    alive = np.arange(n)
    for d in range(1, n):
        alive = alive[alive + d < n]
        alive = alive[codes[alive] == codes[alive + d]]
        if not len(alive):
            return
        for i in range(0, len(alive), STEP):
            yield alive[i : i + STEP], alive[i : i + STEP] + d


def _linker(keys: list[str], prepare: Callable, verify: Callable):
    def summary(pdf: pd.DataFrame) -> pd.DataFrame:
        codes = pdf.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
        block = pdf["block"].to_numpy()
        cross = pdf["lo"].to_numpy() != pdf["hi"].to_numpy()
        ids = pdf["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        uniq, at = np.unique(ids, return_inverse=True)
        data = prepare(pdf)
        weight = pdf["weight"].to_numpy()
        total = np.zeros(len(uniq), np.int64)
        us, vs = [], []
        for i, j in group_pairs(codes):
            want = ~cross[i] | (block[i] != block[j])
            i, j = i[want], j[want]
            ok = verify(data, i, j)
            i, j = i[ok], j[ok]
            if len(i):
                np.add.at(total, at[i], weight[j])
                np.add.at(total, at[j], weight[i])
                us.append(at[i])
                vs.append(at[j])
                if sum(map(len, us)) > 8 * STEP:  # keep only a spanning star of what has been found
                    root = local_roots(len(uniq), np.concatenate(us), np.concatenate(vs))
                    us, vs = [np.arange(len(uniq))], [root]
        del order
        root = local_roots(len(uniq), np.concatenate(us), np.concatenate(vs)) if us else np.arange(len(uniq))
        hit = (total > 0) | (root != np.arange(len(uniq)))
        return pd.DataFrame({"id": uniq[hit], "root": uniq[root][hit], "links": total[hit]})

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Groups are adjacent in a sorted partition; the last one of a batch waits for the next."""
        held: list[pd.DataFrame] = []
        for pdf in parts:
            if not len(pdf):
                continue
            if held:
                pdf = pd.concat([*held, pdf], ignore_index=True)
            last = (pdf[keys] == pdf[keys].iloc[-1]).all(axis=1).to_numpy()
            held = [pdf[last]]
            if (rest := pdf[~last]).shape[0]:
                yield summary(rest.reset_index(drop=True))
        if held:
            yield summary(held[0].reset_index(drop=True))

    return run


def bucket_links(keyed: DataFrame, keys: list[str], payload: DataFrame, prepare: Callable, verify: Callable, label: str, block: int = BLOCK) -> DataFrame:
    """(id, root, links) for members with a link, one row per id and group; bigint ids.

    keyed: (keys..., id). payload: (id, weight, ...), one row per id.
    prepare(pdf) makes what verify(data, i, j) needs to tell for index arrays
    i and j which pairs are linked. links sums the weights of the partners.
    """
    counts = keyed.groupBy(*keys).agg(F.count("*").alias("c")).where("c > 1")
    counts = materialise(counts, f"{label}-buckets")
    dealt = (
        keyed.join(counts, keys)
        .withColumn("parts", F.ceil(F.col("c") / block).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(*keys, "id", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    )
    group = [*keys, "lo", "hi"]
    full = dealt.join(payload, "id")
    return full.repartition(*group).sortWithinPartitions(*group).mapInPandas(frugal(_linker(group, prepare, verify)), "id bigint, root bigint, links bigint")
