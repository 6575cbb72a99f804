"""A generation run over responses at rest: plan, gate, count, judge, publish.

Responses come from a table ``position, attempt, role, text, stop_reason, model_id,
error_kind``; the language model itself is not the engine's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions.text import content_fingerprint
from loomspan.operators import composition, gates, manifest, metrics, planning, privacy
from loomspan.sources import corpus


def attempts(
    slots: DataFrame, responses: DataFrame, weights: dict[str, float], config: dict, run_id: str, source_id: str, rubric_id: str, approvals: DataFrame | None = None,
    detectors: privacy.Detectors | None = None, keep_findings: bool = False,
) -> DataFrame:
    """Every attempt with its record if accepted, or the one reason it was not.

    Gates in order: model refusal, structure, detector error, privacy, judge, coherence.
    ``keep_findings`` adds the candidate and its findings, masked."""
    gen = responses.where("role = 'generator'").drop("role")
    judge = responses.where("role = 'judge'").select("position", "attempt", F.col("text").alias("judge_text"), F.col("model_id").alias("judge_model_id"))
    a = slots.join(gen, "position").join(judge, ["position", "attempt"], "left").withColumn("candidate", gates.parse_candidate("text"))
    shape = gates.structural_reason("text", "turn_count", "stop_reason")
    a = a.withColumn("detail", shape).withColumn("v", gates.verdict("judge_text", weights)).withColumn("score", F.col("v.score"))
    key = F.concat_ws("/", "position", "attempt")
    fields = a.where("detail is null").select(key.alias("record_id"), F.col("candidate.scenario").alias("scenario"), F.col("candidate.turns").alias("turns"))
    # one row per candidate with all that was found in it, and whether a detector failed
    looked = (detectors or privacy.Detectors()).look(privacy.record_fields(fields))
    seen = looked.select("record_id", "field", "problem", F.explode_outer("found").alias("m")).select("record_id", "field", "problem", "m.category", "m.value", "m.detector")
    status = privacy.findings(seen, approvals)
    finding = F.when(F.col("category").isNotNull(), F.struct("field", "category", "detector", "status", "masked"))
    per = status.groupBy(F.col("record_id").alias("_k")).agg(F.max("problem").alias("_problem"), F.max((F.col("category").isNotNull() & (F.col("status") == "blocking")).cast("int")).alias("_b"), F.collect_list(finding).alias("findings"))
    a = a.join(per.select("_k", "_problem", (F.col("_b") == 1).alias("_b"), F.array_sort("findings").alias("findings")), key == F.col("_k"), "left")
    reason = F.coalesce(
        F.when(F.col("error_kind") == "refusal", F.lit("model_refusal")),
        F.when(F.col("detail") == "turn_count", F.lit("turn_count_out_of_range")),
        F.when(F.col("detail").isNotNull(), F.lit("structural_invalid")),
        F.when(F.col("_problem").isNotNull(), F.lit("detector_error")),
        F.when(F.col("_b"), F.lit("privacy_finding")),
        F.when(F.col("v.problem").isNotNull() | F.col("judge_text").isNull(), F.lit("unjudgeable")),
        F.when(~gates.meets("score", config["coherence_threshold"]), F.lit("coherence_below_threshold")),
    )
    record = F.struct(*gates.record_columns(run_id, source_id, rubric_id))
    a = a.withColumn("reason", reason).withColumn("record", F.when(F.col("reason").isNull(), record))
    bad = F.col("reason").isNull() & (F.size(gates.violations({c: F.col("record")[c] for c in gates.RECORD})) > 0)
    a = a.withColumn("reason", F.when(bad, F.lit("schema_invalid")).otherwise(F.col("reason"))).withColumn("accepted", F.col("reason").isNull())
    more = ["candidate", "findings"] if keep_findings else []
    return a.select("position", "attempt", "reason", F.coalesce("detail", "_problem").alias("detail"), "model_id", "score", F.when(F.col("accepted"), F.col("record")).alias("record"), "accepted", *more)


def execute(spark: SparkSession, config: dict, seed: int, responses: DataFrame, document: dict, rubric: dict, run_id: str, out_dir: str) -> dict:
    """The whole run; returns its manifest, which is written beside the corpus."""
    import hashlib
    import os
    from datetime import datetime, timezone

    started = datetime.now(timezone.utc).isoformat()
    want = composition.requested(spark, config["composition"])
    plan = planning.slots(want, config["record_count"], seed, config, document["subdomains"])
    made = attempts(plan, responses, rubric["weights"], config, run_id, document["source_id"], rubric["rubric_id"]).persist()
    first = made.where("accepted").groupBy("position").agg(F.min_by("record", "attempt").alias("record")).select("record.*")
    staging, final = os.path.join(out_dir, f"{run_id}.staging"), os.path.join(out_dir, run_id)
    corpus.write_ordered(first, staging)
    written = corpus.read_corpus(spark, staging)
    have = composition.shares(written.select("metadata.*"))
    over = composition.breaches(composition.drift(want, have), config["tolerance_pp"]).collect()
    limits = {"privacy_finding": config["max_privacy_discard_rate"], "coherence_below_threshold": config["max_coherence_discard_rate"]}
    rates = metrics.rates(made, limits).where("over").collect()
    n = written.count()
    result = manifest.outcome(n, len(over), len(rates))
    tally = {r["reason"]: r["n"] for r in metrics.discards(made).collect()}
    nested = lambda df, v: {d: {r["member"]: r[v] for r in df.where(F.col("dimension") == d).collect()} for d in config["composition"]}
    done, revision = datetime.now(timezone.utc).isoformat(), config.get("code_revision") or {"commit": None, "dirty": False}
    document_out = {
        "manifest_version": "1.0.0", "run_id": run_id, "schema_version": "1.0.0", "seed": seed, "config": {k: v for k, v in config.items()}, "code_revision": revision,
        "input_hashes": config.get("input_hashes") or {"document": document.get("sha256") or hashlib.sha256(document.get("body", "").encode()).hexdigest()},
        "models": {role: {"model_id": config.get("models", {}).get(role, {}).get("model_id", ""), "max_tokens": config.get("models", {}).get(role, {}).get("max_tokens", 4096), "sampling_seed": None, "fallback_models": [], "extra": {}} for role in ("generator", "judge")}, "environment_overrides": {},
        "started_at": started, "completed_at": done, "records_generated": made.count(), "records_written": n, "discards": [{"reason": k, "count": v} for k, v in sorted(tally.items())], "retry_counts": {r["error_kind"]: r["n"] for r in manifest.retries(responses).collect()},
        "resumed_count": 0, "segments": [{"code_revision": revision, "started_at": started, "completed_at": done, "first_record_index": 0, "last_record_index": max(n - 1, 0)}], "duplicate_count": n - written.select(content_fingerprint("turns")).distinct().count(), "composition_requested": config["composition"],
        "composition_assigned": nested(composition.shares(plan), "share"), "composition_achieved": nested(have, "share"),
        "coherence_score_distribution": {r["bucket"]: r["n"] for r in metrics.histogram(written.select(F.col("quality.coherence_score").alias("score"))).collect()},
        "output_filename": run_id, "output_sha256": corpus.artifact_sha256(spark, staging), "outcome": result, "breaches": [r.asDict() for r in over], "rate_breaches": [r.asDict() for r in rates],
    }
    if result == "completed":
        corpus.publish(staging, final, gate_passed=True)
    corpus.write_json(document_out, os.path.join(out_dir, f"{run_id}.manifest.json"))
    made.unpersist()
    return document_out
