"""Checkpoints, reports, reproduction, approvals, strict files."""

import json

import pytest

from loomspan import schema
from loomspan.functions import text as tx
from loomspan.operators import manifest, privacy, validator
from loomspan.plans import checkpoint, report, reproduce
from loomspan.sources import corpus


def state(**more):
    return {k: {} for k in checkpoint.KEYS} | {"run_id": "a", "next_position": 3, "resumes": 0, "segments": [], "input_fingerprints": {"doc": "x", "rubric": "y"}} | more


def test_checkpoint_round_trip(tmp_path):
    run = tmp_path / "a"
    run.mkdir()
    checkpoint.save(state(), str(run))
    assert checkpoint.load(str(run)) == state() and checkpoint.resumable(str(tmp_path)) == "a"
    assert checkpoint.changed(state(), {"doc": "x", "config": "z"}) == ["config", "rubric"]
    assert checkpoint.taken_up(state(), {"first_record_index": 3})["resumes"] == 1
    (tmp_path / "b").mkdir()
    checkpoint.save(state(run_id="b"), str(tmp_path / "b"))
    with pytest.raises(checkpoint.CheckpointError, match="several"):
        checkpoint.resumable(str(tmp_path))
    assert checkpoint.resumable(str(tmp_path), "b") == "b"
    (run / checkpoint.NAME).write_text("{")
    with pytest.raises(checkpoint.CheckpointError):
        checkpoint.load(str(run))
    assert checkpoint.due(250, 150, 100) and not checkpoint.due(249, 150, 100)


def test_a_run_cut_short_goes_on_to_the_same_rows(spark):
    slots = spark.range(40).withColumnRenamed("id", "position")
    half = slots.where("position < 23 or position = 30")
    kept = checkpoint.prefix(half, 20, "position")
    rest = checkpoint.remaining(slots, 20)
    assert sorted(r[0] for r in kept.unionByName(rest).collect()) == list(range(40))


def test_toml_reads_back():
    m = {"config": {"record_count": 3, "models": {"judge": {"model_id": 'a "b"\n\\', "top": None}}, "list": ["x", 1.5, True]}, "seed": 9}
    assert corpus.tomllib.loads(reproduce.config_of(m)) == {"record_count": 3, "seed": 9, "models": {"judge": {"model_id": 'a "b"\n\\'}}, "list": ["x", 1.5, True]}
    with pytest.raises(ValueError):
        reproduce.render_toml({"a": [{"b": 1}]})


def test_inputs_of_a_manifest(spark):
    got = reproduce.input_status(spark, {"input_hashes": {"a": "1", "b": "2", "c": "3"}}, {"a": "1", "b": "x"}).collect()
    assert {r["name"]: r["status"] for r in got} == {"a": "match", "b": "differs", "c": "missing"}


def test_artifact_and_contract_manifest(spark, tmp_path):
    (tmp_path / "out.jsonl").write_text("{}\n")
    sha = corpus.sha256_file(str(tmp_path / "out.jsonl"))
    m = {"output_filename": "out.jsonl", "output_sha256": sha}
    assert manifest.artifact_problems(spark, m, str(tmp_path)) == []
    assert len(manifest.artifact_problems(spark, m | {"output_sha256": "0" * 64}, str(tmp_path))) == 1
    assert manifest.artifact_problems(spark, m | {"output_filename": "gone"}, str(tmp_path)) == []
    full = {k: {} for k in manifest.REQUIRED} | {"records_generated": 12, "records_written": 9, "duplicate_count": 0, "resumed_count": 0, "segments": [1], "code_revision": {"commit": None, "dirty": True}}
    assert manifest.manifest_problems(full | {"discards": [{"reason": "unjudgeable", "count": 2}, {"reason": "model_refusal", "count": 1}]}) == []
    assert manifest.manifest_problems(full | {"discards": [{"reason": "unjudgeable"}]}) == ["discards are not a list of reason and count"]
    assert manifest.manifest_problems(full | {"discards": [{"reason": "nothing", "count": 3}]}) == ["unknown discard reason nothing"]


def test_approvals(spark, tmp_path):
    row = privacy.approve("PHONE", " 646 738 2091 ", "test line of the office", "pat", "2026-01-02", spark)
    assert "738" not in json.dumps(row)
    path = str(tmp_path / "approvals.json")
    corpus.save_approvals(spark.createDataFrame([row]), path)
    found = spark.createDataFrame([("PHONE", "646 738 2091", "d"), ("PHONE", "646 738 2092", "d")], "category string, value string, detector string")
    assert sorted(r["status"] for r in privacy.findings(found, corpus.read_approvals(spark, path)).collect()) == ["approved", "blocking"]
    for bad in (("PHONE", "1", "call (646) 738-2091", "pat"), ("PHONE", "1", " ", "pat"), ("OTHER", "1", "x", "pat")):
        with pytest.raises(ValueError):
            privacy.approve(*bad, "2026-01-02", spark)


def test_quarantine_lookup_and_retention(spark, tmp_path):
    q = spark.createDataFrame([(("r", "scene", [("hello",), ("bye",)]),)], "record struct<record_id:string,scenario:string,turns:array<struct<content:string>>>")
    assert corpus.quarantined_text(q, "r", "turns[1].content") == "bye" and corpus.quarantined_text(q, "r", "scenario") == "scene"
    assert corpus.quarantined_text(q, "x", "scenario") is None and corpus.quarantined_text(q, "r", "other") is None
    (tmp_path / "stage").mkdir()
    stage, point = str(tmp_path / "stage"), str(tmp_path / "none")
    assert corpus.retain(stage, point, succeeded=False) == [stage] and corpus.retain(stage, point, succeeded=True) == []


def test_strict_config(tmp_path):
    path = tmp_path / "c.toml"
    path.write_text('record_count = 100\ncolour = "red"\nmax_privacy_discard_rate = 2.0\n[models.judge.extra]\nApi_Key = "x"\nmax_tokens = 5\n')
    with pytest.raises(corpus.ConfigError) as e:
        corpus.load_config(str(path))
    said = "; ".join(e.value.problems)
    assert "unknown setting colour" in said and "Api_Key" in said and "max_privacy_discard_rate" in said and "judge has no model_id" in said and "max_tokens" not in said


def test_lines_are_numbered_and_groups_listed(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"record_id": "a"}\n\nnot json\n{"record_id": "b", "zeal": 1}\n')
    got = {r["line_no"]: r["error"] for r in validator.read_lines(spark, str(path)).collect()}
    assert got == {1: None, 3: "not_json", 4: "unknown fields: zeal"}
    turns = "array<struct<role:string,content:string>>"
    rows = [(0, "a", [("u", "caf\u00e9  x")]), (1, "b", [("u", " cafe\u0301 x")]), (2, "c", [("u", "other")])]
    groups = validator.duplicate_groups(spark.createDataFrame(rows, f"record_index int, record_id string, turns {turns}")).collect()
    assert [(r["kept"], r["members"], r["n"]) for r in groups] == [("a", ["a", "b"], 2)]


def test_mail_pattern_is_linear_and_finds_the_same(spark):
    text = "a" * 300_000 + " b@c.example x@@y.test z.w@q.example,b@c.d@e.f " + "%" * 300_000
    got = [r["value"] for r in privacy.matches(spark.createDataFrame([(text,)], "text string")).collect()]
    assert got == ["b@c.example", "z.w@q.example", "b@c.d"]


def test_report(spark):
    m = {k: 0 for k in ("run_id", "schema_version", "records_generated", "records_written", "retry_counts", "duplicate_count", "coherence_score_distribution", "composition_requested", "composition_assigned", "composition_achieved", "resumed_count")}
    m |= {"outcome": "failed", "discards": [{"reason": "unjudgeable", "count": 2}]}
    found = spark.createDataFrame([("blocking",), ("advisory",), ("blocking",)], "status string")
    fields = spark.createDataFrame([("a", "scenario"), ("a", "turns[0].content")], "record_id string, field string")
    want = spark.createDataFrame([("channel", "email", 0.5), ("channel", "chat", 0.5)], "dimension string, member string, proportion double")
    have = spark.createDataFrame([("channel", "email", 1.0)], "dimension string, member string, share double")
    r = report.report(m, found, fields, want, have, ["pattern"], ["too few"])
    assert r["exit_status"] == 1 and r["verdict"] == "fail" and r["privacy"]["blocking"] == 2 and r["worst_drift"]["member"] == "chat" and r["privacy"]["fields_examined"] == 2
    assert "discarded 2: unjudgeable" in report.as_text(r) and schema.RUN_OUTCOMES["stopped"] == 3


def test_small_things():
    assert [tx.duration(x) for x in (5, 72, 3900)] == ["5s", "1m12s", "1h05m"] and tx.new_run_id() != tx.new_run_id()
    assert manifest.outcome(1, 0, 0, refused=True) == "refused"
