"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that go to Python at once, where the session does not say: texts may be long.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20)}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is read from spark.checkpoint.dir. A temporary folder is made only
    where that is unset and the session runs in local mode (tests).
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tidegauge-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def bound_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batch limits to BATCH, unless it has some of its own.

    Every operator that sends texts to Python calls this (materialise does).
    """
    for name, limit in BATCH.items():
        if spark.conf.get(name) == spark._jvm.org.apache.spark.sql.internal.SQLConf().getConfString(name):
            spark.conf.set(name, limit)


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """For mapInPandas and iterator UDFs: a worker outlives its task, so it gives its free memory back when the partition ends."""

    @wraps(run)
    def wrapped(parts: Iterator) -> Iterator:
        try:
            yield from run(parts)
        finally:
            give_back()

    return wrapped


#: Stands for a null id on its way through Python.
NO_ID = -(1 << 63)


def veiled(column: str = "id"):
    """An id that pandas keeps exact: of a column with nulls it would make floats."""
    return F.coalesce(F.col(column), F.lit(NO_ID)).alias(column)


def unveiled(column: str = "id"):
    return F.when(F.col(column) != NO_ID, F.col(column)).alias(column)


def map_ids(df: DataFrame, run: Callable[[Iterator], Iterator], schema: str, column: str = "id") -> DataFrame:
    """df.mapInPandas(frugal(run), schema), null ids kept and all others exact."""
    out = df.withColumn(column, veiled(column)).mapInPandas(frugal(run), schema)
    return out.withColumn(column, unveiled(column))


def give_back() -> None:
    """Hand memory that Python, Arrow and the C library hold but do not use to the system."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def discard(df: DataFrame) -> None:
    """Delete a table that materialise wrote and nothing reads any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if name.split(":", 1)[-1].lstrip("/").startswith(shared_dir(spark).split(":", 1)[-1].lstrip("/")):
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str = "t", codec: str = "snappy") -> DataFrame:
    """Write df once to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not the work
    before it, and no copy lives on one machine only.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_shared(spark: SparkSession, name: str, data: bytes) -> str:
    """A small file in the shared folder, written by Hadoop's file system as Spark's own are: its path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data))
    out.close()
    return path.toString()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)
