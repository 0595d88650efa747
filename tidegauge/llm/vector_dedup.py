"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import bucket_links
from .common import frugal, materialise
from .components import components

WIDTH = 2.0
MISS = 1e-5
SEED = 20240229
PAIRS = 1 << 13


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised Gaussian projection agrees at this distance (Datar et al., 2004)."""
    c = width / distance
    return 1 - math.erfc(c / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * c) * (1 - math.exp(-c * c / 2))


def plan(n: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """(projections a table, tables): unrelated vectors meet about once a table; a pair at the threshold is missed with chance `miss`."""
    near, far = collision(math.sqrt(2 - 2 * threshold)), collision(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(n, 2)) / -math.log(far)))
    return k, math.ceil(math.log(miss) / math.log(1 - near**k))


def signatures(x: np.ndarray, k: int, tables: int) -> np.ndarray:
    """n x tables int64 keys of unit vectors x (n x dims), a hash of k quantised projections each."""
    rng = np.random.RandomState([SEED, x.shape[1]])
    a, b = rng.standard_normal((x.shape[1], k * tables)), rng.uniform(0, WIDTH, k * tables)
    odd = rng.randint(-(1 << 62), 1 << 62, size=k, dtype=np.int64) | 1
    cells = np.floor((x @ a + b) / WIDTH).astype(np.int64).reshape(len(x), tables, k)
    with np.errstate(over="ignore"):
        mixed = (cells * odd).sum(axis=2)
        return mixed ^ (mixed >> 29) * np.int64(-0x61C8864680B583EB)


def _prepare(pdf: pd.DataFrame):
    dims = pdf["dims"].to_numpy()
    width = int(dims.max())
    x = np.zeros((len(pdf), width))
    for d in np.unique(dims):
        own = dims == d
        x[own, :d] = np.stack(pdf["vec"][own].to_numpy())
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in squares
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x, np.stack(pdf["sig"].to_numpy()), pdf["t"].to_numpy()


def vector_near_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label", threshold: float = 0.98, miss: float = MISS) -> DataFrame:
    """(id_col, n_links, component_id, kept), one row per row of vectors.

    Rows of equal, non-null labels link where the cosine in double precision is
    at least `threshold`; label_col=None compares all. Vectors that are null,
    zero, or hold a null or non-finite component link with nothing, nor do
    vectors of different lengths. component_id is the smallest id reachable.

    Equal vectors form a class with one representative, so copies are not
    paired. Representatives are hashed into tables whose number follows from the
    row count and `miss`, the chance to lose a pair exactly at the threshold.
    Buckets only propose; the cosine decides. A pair counts in the first table
    where it meets, so links are counted without keeping pairs.

    Null ids and rows repeated with one id: each row counts as a vector of its
    own in n_links; component_id and kept go by id (null ids: kept). An
    empty table gives no rows; other columns are ignored.
    """
    label = F.col(label_col) if label_col else F.lit(0)
    # floats travel as floats, which doubles hold exactly
    kind = "array<float>" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "array<double>"
    src = vectors.select(F.col(id_col).cast("bigint").alias("id"), label.cast("string").alias("label"), F.col(vec_col).cast(kind).alias("vec"))
    good = (
        F.col("label").isNotNull()
        & F.col("vec").isNotNull()
        & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vec", lambda x: x != 0)
    )
    flagged = src.withColumn("good", F.coalesce(good, F.lit(False)))
    bad = flagged.where("not good").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    rows = flagged.where("good").select("id", "label", "vec")
    classes = rows.groupBy("label", "vec").agg(F.min("id").alias("least"), F.count("*").alias("weight"))
    classes = materialise(classes.withColumn("id", F.xxhash64("label", "vec")), "vectors")
    # the hash names a class; where two classes share one, they are named by row instead
    clash = classes.groupBy("id").count().where("count > 1")
    clashes = bool(clash.head(1))
    if clashes:
        classes = materialise(classes.drop("id").withColumn("id", F.monotonically_increasing_id()), "vectors")
    k, tables = plan(classes.count(), threshold, miss)

    def sign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            sig = np.zeros((len(pdf), tables), np.int64)
            dims = pdf["vec"].map(len).to_numpy()
            for d in np.unique(dims):
                own = dims == d
                x = np.stack(pdf["vec"][own].to_numpy()).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                sig[own] = signatures(x / np.sqrt((x * x).sum(axis=1, keepdims=True)), k, tables)
            yield pd.DataFrame({"id": pdf["id"], "label": pdf["label"], "vec": pdf["vec"], "weight": pdf["weight"], "dims": dims.astype(np.int32), "sig": list(sig)})

    signed = classes.select("id", "label", "vec", "weight").mapInPandas(frugal(sign), f"id bigint, label string, vec {kind}, weight bigint, dims int, sig array<bigint>")
    signed = materialise(signed, "vector-signatures")
    keyed = signed.select("label", "dims", "id", F.posexplode("sig").alias("t", "key"))

    def near(data, i, j):
        x, sig, t = data
        ok = np.concatenate([np.einsum("ij,ij->i", x[i[a : a + PAIRS]], x[j[a : a + PAIRS]]) >= threshold for a in range(0, len(i), PAIRS)]) if len(i) else np.zeros(0, bool)
        at = np.flatnonzero(ok)
        same = sig[i[at]] == sig[j[at]]
        ok[at] = same.argmax(axis=1) == t[i[at]]
        return ok

    found = materialise(bucket_links(keyed, ["label", "dims", "t", "key"], signed.select("id", "weight", "vec", "sig"), _prepare, near, "vectors"), "vector-links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    rooted = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").join(links, "id", "left")
    # rows find their class by its hash, and by the vector itself only where hashes clash
    on = ["label", "vec"] if clashes else ["class"]
    rooted = materialise(rooted.select(F.col("id").alias("class"), *(on if clashes else []), "least", "weight", F.coalesce("root", "id").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "vector-roots")
    smallest = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "vector-components")
    of = rooted.join(smallest, "root").select(*on, (F.col("links") + F.col("weight") - 1).alias("n_links"), "component_id")
    of = materialise(of, "vector-of")
    named = rows if clashes else rows.select("id", F.xxhash64("label", "vec").alias("class"))
    out = named.join(of, on).select("id", "n_links", "component_id").unionByName(bad)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
