"""Streaming monitors equal their batch forms."""

from pyspark.sql import functions as F

from loomspan.operators import metrics
from loomspan.streaming import monitor

DDL = "seq long, slot long, reason string, fp string"


def _stream(spark, path, rows):
    for i in range(0, len(rows), 20):
        spark.createDataFrame(rows[i : i + 20], DDL).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 2).parquet(path)


ROWS = [(i, i % 3, "unjudgeable" if i % 7 < 3 else None, f"f{i % 25}") for i in range(60)]


def _run(spark, df, name, mode):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_breaker_equals_batch(spark, tmp_path):
    got = _run(spark, monitor.circuit_breaker(_stream(spark, str(tmp_path / "a"), ROWS), 3), "breaker", "update")
    longest = {r["key"]: r["l"] for r in got.groupBy("key").agg(F.max("longest").alias("l")).collect()}
    batch = spark.createDataFrame(ROWS, DDL)
    want = metrics.failure_runs(batch, "slot", "seq", F.col("reason").isNotNull()).groupBy("slot").agg(F.max("failures").alias("l")).collect()
    assert longest == {r["slot"]: r["l"] for r in want}


def test_repeats_are_flagged_not_dropped(spark, tmp_path):
    got = _run(spark, monitor.flag_repeats(_stream(spark, str(tmp_path / "b"), ROWS)), "repeats", "append").collect()
    assert len(got) == 60 and sum(r["is_duplicate"] for r in got) == 35


def test_tallies_reach_the_callback(spark, tmp_path):
    seen = []
    q = monitor.watch(_stream(spark, str(tmp_path / "c"), ROWS), str(tmp_path / "ck"), lambda t, n: seen.append(t))
    q.processAllAvailable()
    q.stop()
    assert sum(seen[-1].values()) == 60
