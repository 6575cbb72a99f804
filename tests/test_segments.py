"""A run in segments: killed and taken up, stopped, refused, its report and exit status."""

import json

import pytest
from pyspark.sql import functions as F

from loomspan import cli
from loomspan.operators import manifest, privacy
from loomspan.plans import outcome, segments
from loomspan.plans.checkpoint import CheckpointError
from loomspan.plans.segments import SegmentedRun, Staged
from loomspan.sources import store as stores

N = 24
CONFIG = {
    "composition": {"category": {"billing": 0.5, "technical": 0.5}, "priority": {"normal": 1.0}, "channel": {"email": 1.0}, "resolution_status": {"resolved": 1.0}},
    "record_count": N, "min_turns": 2, "max_turns": 4, "window_end": "2026-01-01", "window_days": 10, "min_resolution_seconds": 60, "max_resolution_seconds": 600, "tolerance_pp": 30.0,
    "coherence_threshold": 0.8, "max_privacy_discard_rate": 0.5, "max_coherence_discard_rate": 0.5, "max_consecutive_failures": 10, "checkpoint_interval": 5, "max_attempts": 3,
}
DOCUMENT = {"subdomains": ["login", "returns"], "body": "write", "source_id": "doc@1", "sha256": "0" * 64}
RUBRIC = {"rubric_id": "r", "weights": {"x": 1.0}, "body": "judge"}


def make(spark, out, **more):
    config = CONFIG | more.pop("config", {})
    return SegmentedRun(spark, config, 5, DOCUMENT, RUBRIC, more.pop("run_id", "run-1"), str(out), **more)


def responses(spark, run, bad=()):
    """Two attempts at a few slots, one at the others; ``bad`` slots get no JSON."""
    rows = []
    for p, n in sorted((r["position"], r["turn_count"]) for r in run.plan.collect()):
        turns = [{"role": ("customer", "agent")[i % 2], "content": f"turn {i} of {p}"} for i in range(n)]
        good, judged = json.dumps({"scenario": f"case {p}", "turns": turns}), json.dumps({"criteria": {"x": 0.9}, "justification": "ok"})
        first = "not json" if p % 5 == 1 or p in bad else good
        if p == 7:
            first = good.replace("turn 0 of 7", "write to nora.quill@postway.io")
        for attempt, text in enumerate([first, good] if first != good and p not in bad else [first], 1):
            rows += [(p, attempt, "generator", text, "stop", "m", None), (p, attempt, "judge", judged, "stop", "j", None)]
    return spark.createDataFrame(rows, segments.RESPONSES)


def lines(spark, path):
    return [r["value"] for r in spark.read.text(path).orderBy(F.get_json_object("value", "$.record_index").cast("int")).collect()]


class Killed(Exception):
    pass


def kill_at(point, nth):
    left = [nth]

    def on(p):
        if p == point:
            left[0] -= 1
            if left[0] < 0:
                raise Killed(p)

    return on


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """What a run that nothing interrupts ends in."""
    out = tmp_path_factory.mktemp("whole")
    run = make(spark, out)
    found = segments.run_table(run, responses(spark, run), 9)
    return found, lines(spark, str(out / "run-1")), json.loads((out / "run-1.manifest.json").read_text())


CHANGING = ("started_at", "completed_at", "segments", "resumed_count")


def test_a_run_that_completes(spark, whole, tmp_path):
    found, corpus, m = whole
    assert found["outcome"] == "completed" and outcome.exit_status(found) == 0 and len(corpus) == N and manifest.manifest_problems(m) == []
    assert [json.loads(x)["record_index"] for x in corpus] == list(range(N))
    assert m["records_generated"] == N + 6 and m["discards"] == [{"reason": "privacy_finding", "count": 1}, {"reason": "structural_invalid", "count": 5}]
    assert found["privacy"]["quarantine_count"] == 1 and found["privacy"]["blocking"] == 1 and found["artifact_path"].endswith("run-1") and m["resumed_count"] == 0


@pytest.mark.parametrize("point,nth", [("after segment", 1), ("before checkpoint", 2), ("after corpus", 0), ("after publish", 0)])
def test_a_killed_run_ends_in_the_same(spark, whole, tmp_path, point, nth):
    run = make(spark, tmp_path, on=kill_at(point, nth))
    with pytest.raises(Killed):
        segments.run_table(run, responses(spark, run), 9)
    again = make(spark, tmp_path)
    found = segments.run_table(again, responses(spark, again), 9, resume=True)
    _, corpus, m = whole
    got = json.loads((tmp_path / "run-1.manifest.json").read_text())
    assert lines(spark, str(tmp_path / "run-1")) == corpus and {k: v for k, v in got.items() if k not in CHANGING} == {k: v for k, v in m.items() if k not in CHANGING}
    assert got["resumed_count"] == 1 and len(got["segments"]) == 2 and found["outcome"] == "completed" and not (tmp_path / "run-1.run").exists()


def test_a_stream_of_files_killed_twice(spark, whole, tmp_path):
    source = tmp_path / "in"
    run = make(spark, tmp_path)
    every = responses(spark, run)
    for b in range(3):
        every.where((F.col("position") % 3 == b)).coalesce(1).write.mode("append").json(str(source))
    stream = spark.readStream.schema(segments.RESPONSES).option("maxFilesPerTrigger", 1).json(str(source))
    for resume, on in ((False, kill_at("after segment", 1)), (True, kill_at("after checkpoint", 0))):
        with pytest.raises(Exception, match="Killed"):
            segments.run_stream(make(spark, tmp_path, on=on), stream, resume)
    found = segments.run_stream(make(spark, tmp_path), stream, resume=True)
    assert found["outcome"] == "completed" and lines(spark, str(tmp_path / "run-1")) == whole[1]
    m = json.loads((tmp_path / "run-1.manifest.json").read_text())
    assert m["resumed_count"] == 2 and m["discards"] == whole[2]["discards"] and m["records_generated"] == whole[2]["records_generated"]


def test_what_cannot_be_taken_up(spark, tmp_path):
    with pytest.raises(CheckpointError, match="no run"):
        make(spark, tmp_path).begin(resume=True)
    make(spark, tmp_path).begin()
    with pytest.raises(CheckpointError, match="already"):
        make(spark, tmp_path).begin()
    with pytest.raises(CheckpointError, match="config"):
        make(spark, tmp_path, config={"coherence_threshold": 0.7}).begin(resume=True)
    make(spark, tmp_path, config={"code_revision": {"commit": "abc", "dirty": False}}).begin(resume=True)
    staged = Staged(spark, str(tmp_path / "run-1.run"))
    assert [s["code_revision"]["commit"] for s in staged.starts()] == [None, "abc"]
    assert segments.only_staged(spark, str(tmp_path)) == "run-1"
    # a checkpoint that was torn is none, and its segment is cut
    (tmp_path / "run-1.run" / "checkpoints").mkdir()
    (tmp_path / "run-1.run" / "checkpoints" / "000000000.json").write_text("{")
    (tmp_path / "run-1.run" / "segments" / "batch=0").mkdir(parents=True)
    assert staged.cut_unfinished() == ["batch=0"] and staged.progress() == segments.NOTHING


def test_an_outage_stops_the_run_and_it_goes_on(spark, whole, tmp_path):
    run = make(spark, tmp_path, config={"max_consecutive_failures": 3})
    found = segments.run_table(run, responses(spark, run, bad=(11, 12, 13, 14)), 5)
    assert (found["outcome"], found["stop_reason"], outcome.exit_status(found)) == ("stopped", "consecutive_failures", 3)
    assert not (tmp_path / "run-1").exists() and (tmp_path / "run-1.run" / "report.json").exists() and found["artifact_path"] is None
    assert len(run.staged.batches()) == 3


def test_a_run_that_fails_its_gate(spark, tmp_path):
    run = make(spark, tmp_path, config={"max_privacy_discard_rate": 0.001})
    found = segments.run_table(run, responses(spark, run), 9)
    assert (found["outcome"], outcome.exit_status(found)) == ("failed", 1) and any("privacy_finding" in f for f in found["failures"])
    assert not (tmp_path / "run-1").exists() and (tmp_path / "run-1.quarantine").exists()


def test_command_line(spark, tmp_path, capsys):
    toml = ['record_count = 24', "seed = 5", "min_turns = 2", "max_turns = 4", "tolerance_pp = 30.0", "max_privacy_discard_rate = 0.5", "checkpoint_interval = 9"]
    for d, members in CONFIG["composition"].items():
        toml += [f"[composition.{d}]", *(f"{m} = {p}" for m, p in members.items())]
    (tmp_path / "c.toml").write_text("\n".join(toml))
    (tmp_path / "d.md").write_text("---\nsubdomains:\n  - login\n  - returns\n---\nWrite a conversation.\n")
    (tmp_path / "r.md").write_text("---\nid: r\nweights:\n  x: 1.0\n---\nJudge it.\n")
    from loomspan.sources import corpus

    config = corpus.load_config(str(tmp_path / "c.toml"))
    run = SegmentedRun(spark, config, 5, corpus.domain_document(str(tmp_path / "d.md")), RUBRIC, "x", str(tmp_path))
    responses(spark, run).write.json(str(tmp_path / "answers"))
    args = lambda *more: ["generate", "--config", f"{tmp_path}/c.toml", "--responses", f"{tmp_path}/answers", "--document", f"{tmp_path}/d.md", "--rubric", f"{tmp_path}/r.md", "--out", f"{tmp_path}/out", "--seed", "5", *more]
    assert cli.main(args("--run-id", "a")) == 0 and "run a: completed (pass)" in capsys.readouterr().out
    assert cli.main(args("--run-id", "a")) == 2 and "published already" in capsys.readouterr().err
    assert cli.main(args("--resume")) == 2 and "no run can be taken up" in capsys.readouterr().err
    (tmp_path / "c.toml").write_text("record_count = 0")
    assert cli.main(args("--run-id", "b")) == 2


def test_one_of_two_writers_publishes(spark, tmp_path):
    """Through a mount that only Hadoop's API knows."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.shelf.link./x", f"file://{tmp_path}")
    store, at = stores.Store(spark), "viewfs://shelf/x"
    for k in "ab":
        spark.range(3).selectExpr("string(id)").coalesce(1).write.text(f"{at}/{k}")
    sha = stores.parts_sha256(spark, f"{at}/a")
    stores.publish(store, f"{at}/a", f"{at}/out/final", "a", gate_passed=True)
    with pytest.raises(stores.AlreadyThere):
        stores.publish(store, f"{at}/b", f"{at}/out/final", "b", gate_passed=True)
    with pytest.raises(PermissionError):
        stores.publish(store, f"{at}/b", f"{at}/other", "b", gate_passed=False)
    stores.publish(store, f"{at}/a", f"{at}/out/final", "a", gate_passed=True)
    assert stores.parts_sha256(spark, f"{at}/out/final") == sha and store.exists(f"{at}/b") and not store.exists(f"{at}/a")
    store.put_new(f"{at}/one", b"1")
    with pytest.raises(stores.AlreadyThere):
        store.put_new(f"{at}/one", b"2")
    store.put(f"{at}/one", b"3")
    assert store.read(f"{at}/one") == b"3" and store.names(at)[-1] == "out" and stores.parts_sha256(spark, f"{at}/none") is None


def test_a_detector_that_fails_at_one_text(spark):
    def picky(text):
        if "boom" in text:
            raise KeyError(text)
        return [("EMAIL", w) for w in text.split() if w.startswith("id:")]

    d = privacy.Detectors()
    d.register("picky", finder=picky)
    fields = spark.createDataFrame([("a", "t", "id:7 and (646) 738-2091"), ("b", "t", "boom nora.quill@postway.io"), ("c", "t", None)], "record_id string, field string, text string")
    looked = d.look(fields)
    assert [(r["record_id"], r["field"], r["reason"]) for r in privacy.failed_fields(looked).collect()] == [("b", "t", "detector_error")]
    assert {r["record_id"]: sorted(m["value"] for m in r["found"]) for r in looked.collect()} == {"a": ["(646) 738-2091", "id:7"], "b": ["nora.quill@postway.io"], "c": []}
    assert "boom" not in looked.where("problem is not null").first()["problem"] and d.missed(spark) == []
    with pytest.raises(ValueError):
        d.register("picky", finder=picky)
    broken = privacy.Detectors()
    broken.register("broken", finder=lambda text: 1 / 0)
    assert broken.missed(spark) == sorted(privacy.CANARIES)


def test_approvals_under_another_fingerprint(spark):
    keyed = lambda category, value: F.sha2(F.concat(F.lit("secret"), category, value), 256)
    found = spark.createDataFrame([("PHONE", "646 738 2091", "d")], "category string, value string, detector string")
    approvals = found.select(keyed(F.col("category"), F.col("value")).alias("fingerprint"))
    assert privacy.findings(found, approvals, keyed).first()["status"] == "approved" and privacy.findings(found, approvals).first()["status"] == "blocking"
