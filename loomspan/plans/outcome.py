"""The end of a run: corpus, manifest, report and quarantine, and how it went.

The corpus is published only if the run passed.  The manifest and the report tell of any
run; what was staged stays unless the run passed, so that it can be taken up or looked at.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan import schema
from loomspan.functions.text import content_fingerprint
from loomspan.operators import composition, manifest, metrics, privacy
from loomspan.plans import report as reports
from loomspan.plans.segments import FOUND, SegmentedRun
from loomspan.sources import corpus, ordered
from loomspan.sources import store as stores
from loomspan.sources.store import Store, join

#: Breaches that a report spells out; the manifest has them all.
SAID = 20


def _nested(df: DataFrame, value: str, dimensions) -> dict:
    """``{dimension: {member: value}}``; there are as many rows as members."""
    out: dict = {d: {} for d in dimensions}
    for r in df.collect():
        out[r["dimension"]][r["member"]] = r[value]
    return out


def refuse(spark: SparkSession, detectors: privacy.Detectors | None = None) -> list[str]:
    """Why no run may begin: blocking categories that the detectors miss."""
    return [f"{c} is not detected" for c in (detectors or privacy.Detectors()).missed(spark)]


def _failures(over: list, rates: list, why: str | None, n: int) -> list[str]:
    out = [f"stopped: {why}"] if why else []
    out += [] if n else ["no record was accepted"]
    out += [f"composition: {b['dimension']}.{b['member']} is {b['drift_pp']:.2f} points from what was requested" for b in over[:SAID]]
    return out + [f"rate: {r['reason']} is {r['rate']:.2%} of {r['generated']} attempts, over {r['limit']:.2%}" for r in rates]


def _models(config: dict) -> dict:
    named = config.get("models", {})
    return {r: {"model_id": named.get(r, {}).get("model_id", ""), "max_tokens": named.get(r, {}).get("max_tokens", 4096), "sampling_seed": None, "fallback_models": [], "extra": {}} for r in ("generator", "judge")}


def _segments(run: SegmentedRun, done: str) -> list[dict]:
    """An entry for each start of the run, with the record indices written from it on."""
    first = run.staged.read(run.schema()).where("accepted").groupBy("position").agg(F.min_by("batch", "attempt").alias("batch"))
    starts, out = run.staged.starts(), []
    for i, s in enumerate(starts):
        to = starts[i + 1]["first_batch"] if i + 1 < len(starts) else 1 << 30
        mine = first.where(F.col("batch").between(s["first_batch"], to - 1)).agg(F.min("position").alias("lo"), F.max("position").alias("hi")).first()
        out.append({"code_revision": s["code_revision"], "started_at": s["started_at"], "completed_at": starts[i + 1]["started_at"] if i + 1 < len(starts) else done, "first_record_index": mine["lo"], "last_record_index": mine["hi"]})
    return out


def conclude(run: SegmentedRun) -> dict:
    """Writes all that a run leaves behind; returns its report, with ``manifest`` in it."""
    spark, config, store = run.spark, run.config, run.store
    progress, why = run.staged.progress(), run.stop()
    staging, final = run.staged.at("corpus"), join(run.out_dir, run.run_id)
    store.delete(staging)
    run.on("before corpus")
    sha256 = _write(run.accepted(), staging)
    run.on("after corpus")
    written = corpus.read_corpus(spark, staging)
    want, have = composition.requested(spark, config["composition"]), composition.shares(written.select("metadata.*"))
    n = written.count()
    over = [r.asDict() for r in composition.breaches(composition.drift(want, have), config["tolerance_pp"]).orderBy(F.desc(F.abs("drift_pp")), "dimension", "member").collect()] if n else []
    attempts = run.staged.read(run.schema())
    limits = {"privacy_finding": config["max_privacy_discard_rate"], "coherence_below_threshold": config["max_coherence_discard_rate"]}
    rates = [r.asDict() for r in metrics.rates(attempts, limits).where("over").collect()]
    result = manifest.outcome(n, len(over), len(rates), stopped=why is not None)
    done = datetime.now(timezone.utc).isoformat()
    starts = run.staged.starts()
    m = {
        "manifest_version": "1.0.0", "run_id": run.run_id, "schema_version": run.schema_version, "seed": run.seed, "config": dict(config), "code_revision": starts[-1]["code_revision"],
        "input_hashes": config.get("input_hashes") or {k: v for k, v in run.staged.inputs()["fingerprints"].items() if k != "schema_version"}, "models": _models(config), "environment_overrides": {},
        "started_at": starts[0]["started_at"], "completed_at": done, "records_generated": progress.generated, "records_written": n,
        "discards": [{"reason": k, "count": v} for k, v in sorted(progress.discards.items())], "retry_counts": progress.retries, "resumed_count": len(starts) - 1, "segments": _segments(run, done),
        "duplicate_count": n - written.select(content_fingerprint("turns")).distinct().count(), "composition_requested": config["composition"],
        "composition_assigned": _nested(composition.shares(run.plan), "share", config["composition"]), "composition_achieved": _nested(have, "share", config["composition"]),
        "coherence_score_distribution": {r["bucket"]: r["n"] for r in metrics.histogram(written.select(F.col("quality.coherence_score").alias("score"))).collect()},
        "output_filename": run.run_id, "output_sha256": sha256, "outcome": result, "breaches": over, "rate_breaches": rates,
    }
    quarantined = _quarantine(run)
    examined = attempts.where("candidate is not null and (detail is null or reason = 'detector_error')")
    fields = privacy.record_fields(examined.select(F.concat_ws("/", "position", "attempt").alias("record_id"), F.col("candidate.scenario").alias("scenario"), F.col("candidate.turns").alias("turns")))
    found = examined.select(F.explode("findings").alias("f")).select("f.status")
    r = reports.report(m, found, fields, want, have, privacy.Detectors().names, _failures(over, rates, why, n)) | {"stop_reason": why}
    r["privacy"] |= {"quarantine_count": quarantined, "quarantine_path": join(run.out_dir, f"{run.run_id}.quarantine") if quarantined else None}
    passed = result == "completed"
    r["artifact_path"] = final if passed else None
    store.put_json(join(run.out_dir, f"{run.run_id}.manifest.json"), m)
    run.on("before publish")
    if passed:
        stores.publish(store, staging, final, run.run_id, gate_passed=True)
        run.on("after publish")
    store.put_json(join(run.out_dir, f"{run.run_id}.report.json") if passed else run.staged.at("report.json"), r)
    if passed:
        store.delete(run.staged.folder)
    return r | {"manifest": m}


def _write(records: DataFrame, path: str) -> str:
    """Writes the corpus in order; its checksum comes of the writing where the path
    allows it, else of a second read."""
    if ordered.supported(path):
        return ordered.write_lines(corpus.serialize(records), "record_index", "line", path, "overwrite")["sha256"]
    corpus.write_ordered(records, path)
    return stores.parts_sha256(records.sparkSession, path)


def _quarantine(run: SegmentedRun) -> int:
    """Candidates that were blocked, with their masked findings, as JSON Lines."""
    ddl = run.schema()
    kept = ["position", "attempt", "candidate", "findings"]
    held = run.staged.read(type(ddl)([f for f in ddl.fields if f.name in kept]), FOUND)
    n = held.count()
    path = join(run.out_dir, f"{run.run_id}.quarantine")
    if n:
        # the field names that ``corpus.quarantined_text`` reads
        record = F.struct(F.concat_ws("/", "position", "attempt").alias("record_id"), F.col("candidate.scenario").alias("scenario"), F.col("candidate.turns").alias("turns"))
        held.select(record.alias("record"), "findings").write.mode("overwrite").json(path)
    return n


def exit_status(report: dict) -> int:
    return schema.RUN_OUTCOMES[report["outcome"]]


def finished(store: Store, out_dir: str, run_id: str) -> bool:
    """Whether a run of that name was published."""
    return store.exists(join(out_dir, f"{run_id}.report.json"))
