"""Writers: aligned tables, findings, HTML, and finished output folders."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.operators.scan import lag, running_sum, sequences
from tidegauge.sources.named_files import NamedFiles
from tidegauge.sources.shared import stage


def cell_ranges(cells: DataFrame, key: list[str], row: str, col: str) -> DataFrame:
    """(key, ranges): cells as `r11–13c5 r12c2`, consecutive rows of a column as one range."""
    g = F.col(row) - F.row_number().over(Window.partitionBy(*key, col).orderBy(row))
    runs = cells.select(*key, row, col).distinct().withColumn("_g", g).groupBy(*key, col, "_g").agg(F.min(row).alias("a"), F.max(row).alias("b"))
    text = F.concat(F.lit("r"), F.col("a").cast("string"), F.when(F.col("b") > F.col("a"), F.concat(F.lit("–"), F.col("b").cast("string"))).otherwise(""), F.lit("c"), F.col(col).cast("string"))
    runs = runs.withColumn("t", text)
    return runs.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("a", F.col(col).alias("c"), "b", "t"))), lambda s: s["t"]), " ").alias("ranges"))


def head_spans(cells: DataFrame, key: list[str], col: str, text: str) -> DataFrame:
    """(key, first, colspan, text): head cells with the empty ones that continue them."""
    rows = sequences(cells, key, [col]).add(_b=lag(col))
    rows = rows.each(lambda d: d.withColumn("_s", F.when((F.col(text) != "") | F.col("_b").isNull(), 1).otherwise(0))).add(_g=running_sum("_s"))
    spans = rows.rows()
    return spans.groupBy(*key, "_g").agg(F.min(col).alias("first"), F.count("*").alias("colspan"), F.max(text).alias("text")).drop("_g")


def write_texts(texts: DataFrame, folder: str, mode: str = "errorifexists", name: str = "file", text: str = "text", spread: bool = False) -> tuple[int, int]:
    """(written, skipped): each text as a file of its own name, written by the executors; see named_files for what a failure leaves.

    mode: `errorifexists` refuses a folder that holds anything, `ignore` leaves files that are there, `overwrite` replaces them.
    Names must be known and differ. A null text is an empty file; an empty table writes nothing.
    spread: the files go to folders of bounded size in a new folder, for as many as no single folder and no driver should hold; see runs.read_spread_lines.
    """
    spark = texts.sparkSession
    if mode not in ("errorifexists", "ignore", "overwrite"):
        raise ValueError(f"unknown mode {mode}")
    if spread and mode != "errorifexists":
        raise ValueError(f"mode {mode}: files are spread in a new folder only")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = fs.exists(path(folder)) and len(fs.listStatus(path(folder)))
    if mode == "errorifexists" and there:
        raise FileExistsError(f"{folder}: not empty")
    own = stage(texts.select(F.col(name).alias("name"), F.col(text).alias("text")), "texts")
    if own.groupBy("name").count().where("count > 1 or name is null").head(1):
        raise ValueError("two texts of one name, or one without a name")
    wanted = own
    if mode == "ignore" and there:
        names = [(f.getPath().getName(),) for f in fs.listStatus(path(folder))]  # of one folder, as Spark's own file index holds them
        wanted = own.join(spark.createDataFrame(names, "name string"), "name", "left_anti")
    n, todo = own.count(), wanted.count()
    if spread:
        fs.mkdirs(path(folder))
    if todo:
        spark.dataSource.register(NamedFiles)
        wanted.write.format("named_files").mode("append").options(path=folder, spread=spread).save()
    return todo, n - todo


def next_dir(spark: SparkSession, root: str, kind: str) -> tuple[str, int]:
    """(the folder after the last `kind-NN` under root, how many of those are not finished)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path(root))] if fs.exists(path(root)) else []
    own = [n for n in names if re.fullmatch(rf"{re.escape(kind)}-\d+", n)]
    last = max((int(n.rsplit("-", 1)[1]) for n in own), default=-1)
    return f"{root}/{kind}-{last + 1:02d}", sum(not finished(spark, f"{root}/{n}") for n in own)


def require_finished(spark: SparkSession, folder: str) -> None:
    if not finished(spark, folder):
        raise FileNotFoundError(f"{folder}: not finished")


def finish(spark: SparkSession, folder: str, **facts) -> None:
    """The manifest of a finished output folder, written last: a folder without one is not finished."""
    row = {"made": datetime.now().isoformat(timespec="seconds"), **{k: str(v) for k, v in facts.items()}}
    spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row)).coalesce(1).write.json(f"{folder}/manifest")


def finished(spark: SparkSession, folder: str) -> bool:
    """Whether the folder's manifest is there, by Hadoop's file system, so on any store that Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest/_SUCCESS")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
