"""Files that arrive: the stream finds what the batch reader finds; progress is told."""

import json
import shutil
import time

from helpers import rows_of
from pyspark.sql import functions as F

from loomspan import schema
from loomspan.operators import validator
from loomspan.streaming.progress import ProgressListener, line
from loomspan.streaming.scan import CorpusStream


def record(i, **more):
    turns = [{"index": k, "role": ("customer", "agent")[k % 2], "content": f"turn {k} of {i % 7}"} for k in range(2)]
    meta = {"category": "billing", "priority": "low", "channel": "email", "resolution_status": "unresolved", "created_at": "2026-01-01T00:00:00Z", "resolved_at": None}
    r = {"schema_version": schema.SCHEMA_VERSION, "record_id": f"r{i}", "run_id": "run", "record_index": i, "source_id": "s", "subdomain": "d", "scenario": "x", "metadata": meta, "turns": turns, "quality": {"coherence_score": 0.9, "rubric_id": "q"}, "generation": {"model_id": "m", "judge_model_id": "j"}}
    return r | more


def files(folder, first):
    """Two files with good and bad lines."""
    for k in range(2):
        rows = [json.dumps(record(first + 10 * k + i)) for i in range(8)]
        odd = record(first + 10 * k + 8)
        odd["metadata"]["zeal"], odd["turns"][1]["mood"] = 1, 2
        rows[3:3] = ["", "not json", json.dumps(odd), "  "]
        rows.append(json.dumps(record(first + 10 * k + 9, schema_version="9.0.0", colour="red")))
        rows.append(json.dumps(record(first, turns=[])))
        (folder / f"f{first + k}.jsonl").write_text("\n".join(rows) + "\n")


def test_stream_and_batch_agree(spark, tmp_path):
    source, arriving = tmp_path / "in", tmp_path / "made"
    source.mkdir()
    arriving.mkdir()
    stream = CorpusStream(spark, str(source), str(tmp_path / "out"))
    for first in (0, 100, 200):
        files(arriving, first)
        for f in sorted(arriving.glob("*.jsonl")):
            shutil.move(f, source / f.name)
        q = stream.start(availableNow=True)
        q.awaitTermination()
    batch = validator.read_lines(spark, str(source))
    name = F.element_at(F.split("file", "/"), -1)
    bad = batch.where("error is not null").select(name.alias("file"), "line_no", "line", "error")
    got = stream.bad_lines().select(name.alias("file"), "line_no", "line", "error")
    assert rows_of(got) == rows_of(bad) and bad.count() == 18
    assert {r["error"] for r in bad.collect()} == {"not_json", "unknown fields: metadata.zeal, turns.mood", "unknown fields: colour"}
    assert [r["line_no"] for r in bad.where("file = 'f0.jsonl'").orderBy("line_no").collect()] == [5, 6, 13]
    good = batch.where("error is null").select("record.*")
    assert rows_of(stream.records().select("record_id", "record_index")) == rows_of(good.select("record_id", "record_index"))
    assert rows_of(stream.findings()) == rows_of(validator.all_findings(good)) and good.count() == 54
    # a batch that comes again replaces itself
    lines = spark.read.text(str(source / "f0.jsonl")).select(F.lit("f0.jsonl").alias("file"), F.lit(0).alias("block"), F.col("value").alias("line"))
    for _ in range(2):
        stream.each(lines, 77)
    assert stream.bad_lines().count() == 21
    assert CorpusStream(spark, str(source), str(tmp_path / "none")).findings().count() == 1


def test_listener_counts_what_the_table_holds(spark, tmp_path):
    for i in range(4):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    told = []
    listener = ProgressListener(80, lambda s: told.append(s) or 1 / (len(told) - 2))
    spark.streams.addListener(listener)
    try:
        q = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).writeStream.format("memory").queryName("counted").start()
        q.processAllAvailable()
        q.stop()
        until = time.time() + 20
        while not listener.ended(str(q.id)) and time.time() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.rows(str(q.id)) == spark.table("counted").count() == 40
    assert told[-1]["written"] == 40 and told[-1]["seconds_left"] > 0 and len(listener.errors) == 1
    assert line(told[-1]).startswith("40/80, ") and "left" in line(told[-1])
    assert line({"written": 0, "wanted": 5, "seconds": 0, "per_minute": None, "seconds_left": None}) == "0/5, 0s"
