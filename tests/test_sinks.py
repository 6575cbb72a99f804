"""The ordered sink with its digest, and duplicates over a stream."""

import hashlib
import json
import random
from datetime import timedelta

import pytest
from helpers import DATA
from pyspark.sql import functions as F

from loomspan.operators import duplicates
from loomspan.sources import ordered, store
from loomspan.streaming import dedup


def test_ordered_lines_and_their_digest(spark, tmp_path):
    rows = [(i, json.dumps({"i": i, "t": "é " * (i % 5)}, ensure_ascii=False)) for i in range(0, 3000, 3)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "n int, l string").repartition(7)
    path = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = ordered.write_lines(df, "n", "l", path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(p.read_text() for p in parts).split("\n")[:-1] == [x for _, x in rows] and len(parts) == 4
    assert [hashlib.sha256(p.read_bytes()).hexdigest() for p in parts] == [p["sha256"] for p in found["parts"]]
    assert found["sha256"] == store.parts_sha256(spark, path) and found["lines"] == 1000 and found["bytes"] == sum(p.stat().st_size for p in parts)
    assert not list((tmp_path / "out").glob("_attempts*")) and (tmp_path / "out" / "_SUCCESS").exists()
    with pytest.raises(Exception, match="FileExistsError"):
        ordered.write_lines(df, "n", "l", path)
    again = ordered.write_lines(df.where("n < 30"), "n", "l", path, "overwrite")
    assert again["lines"] == 10 and again["sha256"] == store.parts_sha256(spark, path)
    none = ordered.write_lines(df.limit(0), "n", "l", f"file://{tmp_path}/none")
    assert none["lines"] == 0 and none["sha256"] == hashlib.sha256().hexdigest()


def test_a_failed_write_leaves_no_part(spark, tmp_path):
    bad = spark.range(50).select("id", F.when(F.col("id") == 49, F.raise_error(F.lit("no"))).otherwise(F.lit("x")).alias("l"))
    with pytest.raises(Exception):
        ordered.write_lines(bad, "id", "l", str(tmp_path / "out"))
    assert not list(tmp_path.glob("out/part-*")) and not list(tmp_path.glob("out/_SUCCESS"))


def test_parts_out_of_order_are_refused(tmp_path):
    w = ordered.OrderedLinesWriter(str(tmp_path / "x"), False)
    part = lambda n, first, last: ordered.Part(n, "f", 1, 1, "0", first, last)
    with pytest.raises(ordered.OutOfOrder):
        w.commit([part(0, 0, 5), part(1, 4, 9)])


def _run(df, name):
    # with state that expires there is always a batch to come, so the stream is not waited for to be idle
    q = df.writeStream.outputMode("append").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(60)
    q.stop()


def test_stream_of_documents_equals_batch(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("fp"))
    want = {r["doc_id"]: r["is_duplicate"] for r in duplicates.flag_duplicates(docs, "fp", "doc_id").collect()}
    bounds = [0, 60, 130, 10**9]
    for lo, hi in zip(bounds, bounds[1:]):
        docs.where(F.col("doc_id").between(lo, hi - 1)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    files = sorted((tmp_path / "in").glob("part-*"), key=lambda p: p.stat().st_mtime_ns)
    assert len(files) == 3
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    _run(dedup.flag_repeats(stream, "fp", "doc_id"), "flags")
    got = {r["seq"]: r["is_duplicate"] for r in spark.table("flags").collect()}
    assert got == want and any(want.values())


def test_state_begins_from_an_older_corpus_and_expires(spark, tmp_path):
    ddl = "seq long, fp string"
    older = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], ddl)
    rows = [(10, "a"), (11, "c"), (12, "c"), (13, None), (14, None)]
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ddl).parquet(str(tmp_path / "in"))
    _run(dedup.flag_repeats(stream, "fp", "seq", timedelta(days=1), older), "older")
    assert {r["seq"]: r["is_duplicate"] for r in spark.table("older").collect()} == {10: True, 11: False, 12: True, 13: False, 14: True}
    many = spark.createDataFrame([(i, "x") for i in range(3000, 0, -1)], ddl)
    many.write.parquet(str(tmp_path / "many"))
    stream = spark.readStream.schema(ddl).parquet(str(tmp_path / "many"))
    _run(dedup.flag_repeats(stream, "fp", "seq"), "many")
    assert [r["seq"] for r in spark.table("many").where("not is_duplicate").collect()] == [1] and spark.table("many").count() == 3000
