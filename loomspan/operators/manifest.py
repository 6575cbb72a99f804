"""Run manifests: reconciliation, validation, fingerprints of inputs, verdict."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.sources import corpus

# The closed list of reasons, and the keys that a manifest must have.
DISCARD_REASONS = (
    "structural_invalid",
    "turn_count_out_of_range",
    "schema_invalid",
    "coherence_below_threshold",
    "unjudgeable",
    "privacy_finding",
    "detector_error",
    "model_refusal",
    "attempts_exhausted",
)
REQUIRED = (
    "manifest_version",
    "run_id",
    "schema_version",
    "seed",
    "config",
    "code_revision",
    "input_hashes",
    "models",
    "environment_overrides",
    "started_at",
    "completed_at",
    "records_generated",
    "records_written",
    "discards",
    "retry_counts",
    "resumed_count",
    "segments",
    "duplicate_count",
    "composition_requested",
    "composition_assigned",
    "composition_achieved",
    "coherence_score_distribution",
    "output_filename",
    "output_sha256",
)


def discard_counts(m: dict) -> dict[str, int]:
    """Discards by reason from the contract's list of ``reason, count``, or from a map."""
    d = m["discards"]
    if isinstance(d, dict):
        return dict(d)
    out: dict[str, int] = {}
    for entry in d:
        out[entry["reason"]] = out.get(entry["reason"], 0) + entry["count"]
    return out


def manifest_problems(m: dict) -> list[str]:
    """All problems of a manifest; missing keys are reported alone."""
    missing = [k for k in REQUIRED if k not in m]
    if missing:
        return [f"missing {k}" for k in missing]
    if not isinstance(m["discards"], (list, dict)) or isinstance(m["discards"], list) and any(not isinstance(e, dict) or {"reason", "count"} - e.keys() for e in m["discards"]):
        return ["discards are not a list of reason and count"]
    entries = list(m["discards"].items()) if isinstance(m["discards"], dict) else [(e["reason"], e["count"]) for e in m["discards"]]
    out = [f"unknown discard reason {r}" for r in sorted({str(r) for r, _ in entries}) if r not in DISCARD_REASONS]
    counts = {k: m[k] for k in ("records_generated", "records_written", "duplicate_count", "resumed_count")} | {f"discards.{k}": v for k, v in entries}
    out += [f"{k} is not a whole number of at least 0" for k, v in counts.items() if isinstance(v, bool) or not isinstance(v, int) or v < 0]
    if not out and m["records_generated"] - sum(v for _, v in entries) != m["records_written"]:
        out.append("generated less discarded is not written")
    if not m["segments"]:
        out.append("no segments")
    out += [f"revision lacks {k}" for k in ("commit", "dirty") if k not in (m["code_revision"] or {})]
    return out


def artifact_problems(spark: SparkSession, m: dict, folder: str) -> list[str]:
    """What keeps the artifact beside a manifest from being the one that it names.  An
    artifact that is not there is none."""
    found = corpus.artifact_sha256(spark, os.path.join(folder, m["output_filename"]))
    return [] if found is None or found == m["output_sha256"] else [f"{m['output_filename']} has another checksum than the manifest"]


def untraceable(records: DataFrame, manifests: DataFrame) -> DataFrame:
    """Records whose run has no manifest: ``record_id, run_id``."""
    return records.join(manifests.select(F.col("run_id").alias("_run")).distinct(), F.col("run_id").eqNullSafe(F.col("_run")), "left_anti").select("record_id", "run_id")


def retries(responses: DataFrame, *group: str) -> DataFrame:
    """Transport retries by kind: attempts that ended in an error other than a refusal."""
    return responses.where("error_kind is not null and error_kind <> 'refusal'").groupBy(*group, "error_kind").agg(F.count(F.lit(1)).alias("n"))


def reconcile(attempts: DataFrame, *group: str) -> DataFrame:
    """Generated, discarded and written attempts, and whether they add up."""
    out = attempts.groupBy(*group).agg(
        F.count(F.lit(1)).alias("generated"), F.count_if(F.col("reason").isNotNull()).alias("discarded"), F.count_if(F.col("accepted")).alias("written")
    )
    return out.withColumn("closes", F.col("generated") - F.col("discarded") == F.col("written"))


def changed_inputs(before: DataFrame, now: DataFrame) -> DataFrame:
    """``name, status`` of recorded against present fingerprints: match, differs or missing."""
    j = before.select("name", F.col("sha256").alias("a")).join(now.select("name", F.col("sha256").alias("b")), "name", "left")
    return j.select("name", F.when(F.col("b").isNull(), F.lit("missing")).when(F.col("a") == F.col("b"), F.lit("match")).otherwise(F.lit("differs")).alias("status"))


def applicable(checkpoint: DataFrame, now: DataFrame) -> DataFrame:
    """Names whose fingerprints differ between a checkpoint and now, either way missing too."""
    j = checkpoint.select("name", F.col("sha256").alias("a")).join(now.select("name", F.col("sha256").alias("b")), "name", "full_outer")
    return j.where(~F.col("a").eqNullSafe(F.col("b"))).select("name")


def rerun_differences(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Of positions that both runs wrote, the columns that differ."""
    j = a.select(key, *(F.col(c).alias(f"a_{c}") for c in columns)).join(b.select(key, *(F.col(c).alias(f"b_{c}") for c in columns)), key)
    bad = F.filter(F.array(*(F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in columns)), lambda x: x.isNotNull())
    return j.select(key, F.explode(bad).alias("column"))


def outcome(achieved_rows: int, composition_breaches: int, rate_breaches: int, stopped: bool = False, refused: bool = False) -> str:
    """Completed only with rows, and no breach; a refused or stopped run is not judged."""
    if refused:
        return "refused"
    if stopped:
        return "stopped"
    return "completed" if achieved_rows and not composition_breaches and not rate_breaches else "failed"
