"""Rules of single operators on literals."""

import json
import unicodedata
import uuid

import pytest
from pyspark.sql import functions as F

from loomspan import cli, schema
from loomspan.functions import text as tx
from loomspan.operators import calibration, composition, gates, manifest, metrics, planning, privacy, validator
from loomspan.plans import registry
from loomspan.sources import corpus


def one(df):
    return df.first()[0]


def test_apportion_by_hand(spark):
    comp = composition.requested(spark, {"x": {"a": 0.34, "b": 0.33, "c": 0.33}})
    assert {r["member"]: r["n"] for r in composition.apportion(comp, 10).collect()} == {"a": 4, "b": 3, "c": 3}


@pytest.mark.parametrize("n", [50, 97, 500, 99_999])
def test_apportion_sums(spark, n):
    comp = composition.requested(spark, schema.DEFAULT_COMPOSITION)
    got = composition.apportion(comp, n).groupBy("dimension").agg(F.sum("n").alias("n")).collect()
    assert {r["n"] for r in got} == {n}


def test_slots_are_whole_and_consistent(spark):
    comp = composition.requested(spark, schema.DEFAULT_COMPOSITION)
    s = planning.slots(comp, 200, 3, schema.DEFAULTS, ["b", "a"]).toPandas()
    assert sorted(s.position) == list(range(200)) and s.turn_count.between(4, 12).all()
    assert ((s.resolution_status == "resolved") == s.resolved_at.notna()).all()
    assert (s.dropna().resolved_at > s.dropna().created_at).all()


def test_pool_is_made_in_bounded_tasks(spark, monkeypatch):
    """No task makes the items of more than its share of positions, and none is lost."""
    monkeypatch.setattr(planning, "SPAN", 100)
    monkeypatch.setattr(planning, "POSITIONS_PER_TASK", 500)
    monkeypatch.setattr(planning, "RANGE_ROWS", 50)
    comp = composition.requested(spark, {"x": {"a": 0.7, "b": 0.3}, "y": {"c": 1.0}})
    items = planning.pool_items(composition.apportion(comp, 5001), 5001)
    tasks = [r["n"] for r in items.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(tasks) == 11 and max(tasks) <= 2 * 500 + 4 * 100 and sum(tasks) == 2 * 5001
    got = planning.pool_assignment(comp, 5001, 7).toPandas()
    assert got.groupby("dimension").position.apply(lambda p: sorted(p) == list(range(5001))).all()
    assert got.groupby("member").size().to_dict() == {"a": 3501, "b": 1500, "c": 5001}


def test_probe_looks_for_each_canary_once(spark):
    texts = spark.createDataFrame([("a 4539 7281 0046 3317",), (None,), ("531-08-44",), ("x@y.io +1 646",)], "text string")
    d = privacy.Detectors()
    hits = d.probe(texts)
    assert hits.first().asDict() == {"texts": 4, **dict.fromkeys(privacy.CANARIES, 4)}
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == len(privacy.CANARIES)
    assert privacy.Detectors(none=lambda t: F.array().cast(privacy.MATCH)).probe(texts).first().asDict() == {"texts": 4, **dict.fromkeys(privacy.CANARIES, 0)}
    seen = privacy.Detectors(none=lambda t: F.array().cast(privacy.MATCH))
    seen.register("ssn", finder=lambda t: [("US_SSN", t[-11:])])
    assert seen.probe(texts).first()["US_SSN"] == 4 and seen.probe(texts).first()["EMAIL"] == 0


def test_floor_probe_over_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {(r["expected"], r["texts"], r["hits"]) for r in registry.QUERIES["floor_probe"](spark, str(tmp_path)).collect()} == {(c, 0, 0) for c in privacy.CANARIES}


def test_nfc_hands_python_few_texts_at_a_time(spark):
    rows = ["", "plain", "é", "e\u0301", "\u1100\u1161\u11a8", "\u09c7\u09be", "a\u0307\u0323", "日本語", "\U0001d15e", None]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    df = spark.createDataFrame([*zip(rows)], "text string").select("text", tx.nfc("text").alias("n"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == tx.BATCH_ROWS
    for r in df.collect():
        assert r["n"] == (None if r["text"] is None else unicodedata.normalize("NFC", r["text"]))


def test_record_id_is_uuid5(spark):
    got = one(spark.range(1).select(tx.record_id(F.lit("run"), F.lit(7))))
    assert got == str(uuid.uuid5(tx.RECORD_NAMESPACE, "run/7"))


@pytest.mark.parametrize(
    "category,value,expected",
    [
        ("EMAIL", " tom.reed@mail.com ", "••••••@mail.com"), ("EMAIL", "ab@c.de", "••@c.de"), ("EMAIL", "noat", "<4 chars: 4a>"),
        ("CREDIT_CARD", "4539-7281-0046-3317", "453972••••••••••"), ("PHONE", "646-738-2091", "646738••••"), ("US_SSN", "531-08-4472", "<11 chars: 9d 2o>"), ("PHONE", "12", "<2 chars: 2d>"), ("EMAIL", "", ""),
    ],
)
def test_mask(spark, category, value, expected):
    assert one(spark.range(1).select(tx.mask(F.lit(category), F.lit(value)))) == expected


@pytest.mark.parametrize(
    "category,value,expected",
    [
        ("EMAIL", "pat@shop.test", True), ("EMAIL", "pat@mail.EXAMPLE.org", True), ("EMAIL", "pat@contest", False), ("EMAIL", "pat@example.org.uk", False), ("EMAIL", "pat@anexample.net", False),
        ("PHONE", "808-555-0163", True), ("PHONE", "1 (808) 555-0100", True), ("PHONE", "808-555-0300", False), ("PHONE", "808-554-0163", False),
        ("CREDIT_CARD", "3782-822463-10005", True), ("CREDIT_CARD", "3782-822463-10006", False), ("US_SSN", "987-65-4321", False), ("IP_ADDRESS", "192.0.2.1", False),
    ],
)
def test_reserved_ranges(spark, category, value, expected):
    assert one(spark.range(1).select(privacy.reserved(F.lit(category), F.lit(value)))) is expected


def test_canaries_and_negatives(spark):
    assert privacy.Detectors().missed(spark) == []
    quiet = spark.createDataFrame([(t,) for t in privacy.NOT_PERSONAL], "text string")
    assert privacy.matches(quiet).count() == 0


def test_a_failing_detector_fails_the_scan(spark):
    d = privacy.Detectors()
    d.register("broken", lambda text: F.array(F.struct(F.raise_error(F.lit("no model")).cast("string").alias("category"), text.alias("value"), F.lit("broken").alias("detector"))))
    with pytest.raises(Exception, match="no model"):
        privacy.matches(spark.createDataFrame([("x",)], "text string"), d).collect()


def conversation(*turns, scenario="s"):
    return json.dumps({"scenario": scenario, "turns": [{"role": r, "content": c} for r, c in turns]})


GOOD = (("customer", "hi"), ("agent", "yes"))


@pytest.mark.parametrize(
    "text,n,stop,expected",
    [
        (conversation(*GOOD), 2, "stop", None), (conversation(*GOOD), 2, "max_tokens", "truncated"), ("{", 2, "stop", "not_json"), (conversation(*GOOD, scenario=" "), 2, "stop", "blank_scenario"),
        ('{"scenario":"s","turns":[],"x":1}', 2, "stop", "shape"), ('{"scenario":"s","turns":[{"role":"customer","content":"a","x":1},{"role":"agent","content":"b"}]}', 2, "stop", "shape"),
        (conversation(*GOOD), 4, "stop", "turn_count"), (conversation(*GOOD[::-1]), 2, "stop", "first_speaker"), (conversation(GOOD[0], GOOD[0]), 2, "stop", "alternation"),
        (conversation(("customer", " "), GOOD[1]), 2, "stop", "blank_turn"), (conversation(("system", "x"), GOOD[1]), 2, "stop", "shape"),
    ],
)
def test_structural_reason(spark, text, n, stop, expected):
    df = spark.createDataFrame([(text, n, stop)], "text string, n int, stop string").withColumn("candidate", gates.parse_candidate("text"))
    assert one(df.select(gates.structural_reason("text", "n", "stop"))) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ('{"criteria":{"a":1.0,"b":0.5},"justification":"x"}', (0.75, None)), ('{"criteria":{"a":1.0},"justification":"x"}', (None, "unjudgeable")), ('{"criteria":{"a":1.5,"b":0.5}}', (None, "unjudgeable")),
        ('{"criteria":{"a":1.0,"b":0.5,"c":9}}', (0.75, None)), ("no", (None, "unjudgeable")), ('{"criteria":{"a":1,"b":1},"z":1}', (None, "unjudgeable")),
    ],
)
def test_verdict(spark, text, expected):
    assert tuple(one(spark.createDataFrame([(text,)], "t string").select(gates.verdict("t", {"a": 0.5, "b": 0.5})))) == expected


def test_histogram_edges(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.05, 0.15, 1.0, 0.999)], "score double")
    assert {r["bucket"]: r["n"] for r in metrics.histogram(df).collect()} == {"0.00-0.05": 1, "0.05-0.10": 1, "0.10-0.15": 1, "0.95-1.00": 2}


def test_spearman_guards(spark):
    df = lambda rows: spark.createDataFrame(rows, "judge double, human double")
    assert calibration.spearman(df([(0.1, 0.2), (0.2, 0.3)])).first()["rho"] is None
    assert calibration.spearman(df([(0.1, 0.2), (0.1, 0.3), (0.1, 0.5)])).first()["rho"] is None
    assert calibration.spearman(df([(0.1, 0.2), (0.2, 0.3), (0.3, 0.5)])).first()["rho"] == pytest.approx(1.0)


def test_manifest_problems():
    m = {k: {} for k in manifest.REQUIRED} | {"records_generated": 12, "records_written": 10, "discards": {"unjudgeable": 2}, "duplicate_count": 0, "resumed_count": 0, "segments": [1], "code_revision": {"commit": "x", "dirty": False}}
    assert manifest.manifest_problems(m) == []
    assert manifest.manifest_problems({}) == [f"missing {k}" for k in manifest.REQUIRED]
    assert manifest.manifest_problems(m | {"records_written": 9}) == ["generated less discarded is not written"]
    assert manifest.manifest_problems(m | {"discards": {"other": 2}}) == ["unknown discard reason other"]


def test_front_matter_and_rubric(tmp_path):
    text = "---\nid: r1\nversion: 2.0.0\nweights:\n  a: 0.4\n  b: 0.6\nlist:\n  - x\n  - 3\n---\nbody\n"
    fields, body = corpus.front_matter(text)
    assert fields == {"id": "r1", "version": "2.0.0", "weights": {"a": 0.4, "b": 0.6}, "list": ["x", 3]} and body == "body\n"
    assert corpus.front_matter("---\na: 1\nno end") == ({}, "---\na: 1\nno end")
    (tmp_path / "r.md").write_text(text)
    assert corpus.rubric(str(tmp_path / "r.md"))["weights"] == {"a": 0.4, "b": 0.6}


def test_config_problems(tmp_path):
    (tmp_path / "c.toml").write_text('record_count = 0\nmin_turns = 1\n[composition.channel]\nemail = 0.5\nfax = 0.4\n')
    with pytest.raises(corpus.ConfigError) as e:
        corpus.load_config(str(tmp_path / "c.toml"))
    assert len(e.value.problems) == 4


def test_publish_never_overwrites(tmp_path):
    (tmp_path / "s").mkdir()
    with pytest.raises(PermissionError):
        corpus.publish(str(tmp_path / "s"), str(tmp_path / "d"), gate_passed=False)
    corpus.publish(str(tmp_path / "s"), str(tmp_path / "d"), gate_passed=True)
    (tmp_path / "s").mkdir()
    with pytest.raises(FileExistsError):
        corpus.publish(str(tmp_path / "s"), str(tmp_path / "d"), gate_passed=True)


def test_whole_run(spark, tmp_path):
    from loomspan.plans import run

    config = {**schema.DEFAULTS, "composition": schema.DEFAULT_COMPOSITION, "record_count": 40, "max_privacy_discard_rate": 0.5, "tolerance_pp": 5.0}
    document = {"subdomains": ["a", "b"], "source_id": "d@1"}
    comp = composition.requested(spark, config["composition"])
    rows = []
    for s in planning.slots(comp, 40, 5, config, document["subdomains"]).collect():
        turns = [("customer" if i % 2 == 0 else "agent", f"turn {i} of {s['position']}") for i in range(s["turn_count"])]
        bad = s["position"] % 10 == 0
        for attempt in (1, 2) if bad else (1,):
            text = conversation(*turns) if not bad or attempt == 2 else conversation(("customer", "mail tom.reed@northwindow.io"), *turns[1:])
            rows.append((s["position"], attempt, "generator", text, "stop", "m", None))
            rows.append((s["position"], attempt, "judge", '{"criteria":{"x":0.9},"justification":"ok"}', "stop", "j", None))
    responses = spark.createDataFrame(rows, "position long, attempt int, role string, text string, stop_reason string, model_id string, error_kind string")
    m = run.execute(spark, config, 5, responses, document, {"rubric_id": "r", "weights": {"x": 1.0}}, "run-1", str(tmp_path))
    assert m["outcome"] == "completed" and m["records_written"] == 40 and m["discards"] == [{"reason": "privacy_finding", "count": 4}]
    assert manifest.manifest_problems(m) == []
    back = corpus.read_corpus(spark, str(tmp_path / "run-1"))
    assert back.count() == 40 and validator.contract_findings(back).count() == 0
    lines = [json.loads(x) for f in sorted((tmp_path / "run-1").glob("part-*")) for x in f.read_text().splitlines()]
    assert [x["record_index"] for x in lines] == list(range(40)) and all(list(x) == sorted(x) for x in lines)


def test_cli_schema(capsys):
    assert cli.main(["schema"]) == 0
    assert json.loads(capsys.readouterr().out)["title"] == "TicketRecord"


def test_versions():
    assert schema.parse_semver("1.20.3") == (1, 20, 3) and schema.is_supported_version("1.0.0") and not schema.is_supported_version("1.0.1")
    with pytest.raises(ValueError):
        schema.parse_semver("1.0")
