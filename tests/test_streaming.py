from __future__ import annotations

from tidegauge.operators import stats
from tidegauge.streaming.scoring import group_statistics, score_stream


def test_stream_equals_batch(spark, tmp_path):
    rows = [("a", float(60 + i % 3)) for i in range(20)] + [("a", 500.0), ("b", 1.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    df.write.parquet(str(tmp_path / "in"))
    statistics = group_statistics(df, ["k"], "x")
    stream = score_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), statistics, ["k"], "x")
    q = stream.select("k", "x").writeStream.format("memory").queryName("scored").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    want = stats.group_outliers(df, ["k"], "x").select("k", "x").collect()
    assert sorted(spark.table("scored").collect()) == sorted(want) and len(want) == 1
