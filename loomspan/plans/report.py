"""The report of a run, as JSON and as text, and the exit status it gives."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan import schema
from loomspan.operators import composition, manifest, privacy
from loomspan.sources import corpus


def findings_by_status(found: DataFrame) -> dict[str, int]:
    return {r["status"]: r["n"] for r in found.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}


def report(m: dict, found: DataFrame, fields: DataFrame, want: DataFrame, have: DataFrame, detectors: list[str], failures: list[str]) -> dict:
    """The report of a run from its manifest, findings, scanned fields and shares."""
    by_status = findings_by_status(found)
    worst = composition.worst_member(composition.drift(want, have)).first()
    examined = fields.agg(F.count_distinct("record_id").alias("r"), F.count(F.lit(1)).alias("f")).first()
    same = ("run_id", "schema_version", "records_generated", "records_written", "retry_counts", "duplicate_count", "coherence_score_distribution", "composition_requested", "composition_assigned", "composition_achieved", "resumed_count", "outcome")
    return {k: m[k] for k in same} | {
        "verdict": "pass" if m["outcome"] == "completed" else "fail",
        "exit_status": schema.RUN_OUTCOMES[m["outcome"]],
        "discards": dict(sorted(manifest.discard_counts(m).items())),
        "worst_drift": worst.asDict() if worst else None,
        "failures": failures,
        "privacy": {
            "records_examined": examined["r"], "fields_examined": examined["f"], "detectors_run": detectors, "covered_types": privacy.covered_types(), "declared_gaps": list(privacy.DECLARED_GAPS),
            "findings_by_status": by_status, "blocking": by_status.get("blocking", 0),
        },
    }


def as_text(r: dict) -> str:
    lines = [f"run {r['run_id']}: {r['outcome']} ({r['verdict']})", f"generated {r['records_generated']}, written {r['records_written']}, duplicates {r['duplicate_count']}"]
    lines += [f"discarded {n}: {reason}" for reason, n in r["discards"].items()]
    lines += [f"findings {n}: {status}" for status, n in sorted(r["privacy"]["findings_by_status"].items())]
    lines += [f"not looked for: {gap}" for gap in r["privacy"]["declared_gaps"]]
    return "\n".join([*lines, *(f"failed: {f}" for f in r["failures"])])


def write(r: dict, folder: str, *, published: bool) -> str:
    """Beside the corpus under the run's name if it was published, else plainly named."""
    path = os.path.join(folder, f"{r['run_id']}.report.json" if published else "report.json")
    corpus.write_json(r, path)
    return path
