"""Command line: generate, validate-manifest, config-from-manifest, privacy-scan,
privacy-approve, sample-for-review, calibrate, schema, check."""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="loomspan")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("schema")
    for name, *args in (("validate-manifest", "path"), ("privacy-scan", "path"), ("sample-for-review", "path", "n", "seed"), ("calibrate", "path", "threshold"), ("check", "path"), ("config-from-manifest", "path"), ("privacy-approve", "store", "category", "value", "reason", "approved_by", "approved_on")):
        s = sub.add_parser(name)
        for a in args:
            s.add_argument(a, **({"type": int} if a in ("n", "seed") else {"type": float} if a == "threshold" else {}))
    g = sub.add_parser("generate", help="a run over responses, as JSON Lines; the exit status tells how it went")
    for name in ("config", "responses", "document", "rubric", "out"):
        g.add_argument(f"--{name}", required=True)
    g.add_argument("--seed", type=int, required=True)
    g.add_argument("--approvals")
    g.add_argument("--run-id", help="a new one is drawn where none is given")
    g.add_argument("--resume", action="store_true", help="take the run up that is staged, --run-id or the only one")
    g.add_argument("--json", action="store_true", help="print the report as JSON")
    a = p.parse_args(argv)
    from loomspan import schema

    if a.command == "schema":
        print(json.dumps(schema.json_schema(), indent=2, sort_keys=True))
        return 0
    if a.command == "config-from-manifest":
        from loomspan.plans.reproduce import config_of
        from loomspan.sources.corpus import read_manifest

        print(config_of(read_manifest(a.path)), end="")
        return 0

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from loomspan.operators import calibration, planning, privacy, validator
    from loomspan.sources import corpus

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "generate":
        return generate(spark, a)
    if a.command == "validate-manifest":
        import os

        from loomspan.operators.manifest import artifact_problems, manifest_problems

        m = corpus.read_manifest(a.path)
        found = manifest_problems(m)
        found += [] if found else artifact_problems(spark, m, os.path.dirname(os.path.abspath(a.path)))
        print("\n".join(found))
        return int(bool(found))
    if a.command == "privacy-approve":
        row = privacy.approve(a.category, a.value, a.reason, a.approved_by, a.approved_on, spark)
        old = corpus.read_approvals(spark, a.store).where(F.col("fingerprint") != row["fingerprint"]).collect()
        corpus.save_approvals(spark.createDataFrame([*(r.asDict() for r in old), row], "fingerprint string, category string, reason string, approved_by string, approved_on string"), a.store)
        print(row["fingerprint"])
        return 0
    if a.command == "privacy-scan":
        missed = privacy.Detectors().missed(spark)
        if missed:
            print(f"not detected: {', '.join(missed)}", file=sys.stderr)
            return 1
        fields = privacy.record_fields(corpus.read_corpus(spark, a.path))
        counts = privacy.findings(privacy.matches(fields, None, "record_id", "field")).groupBy("category", "status").count().collect()
        print(json.dumps({"counts": [r.asDict() for r in counts], "gaps": privacy.DECLARED_GAPS}))
        return int(any(r["status"] == "blocking" for r in counts))
    if a.command == "sample-for-review":
        for r in planning.seeded_sample(corpus.read_corpus(spark, a.path), a.n, a.seed, "record_id").toJSON().collect():
            print(json.dumps({**json.loads(r), "human_score": None, "human_criteria": {}}))
        return 0
    if a.command == "calibrate":
        print(json.dumps(calibration.calibrate(corpus.read_sample(spark, a.path), a.threshold), indent=2))
        return 0
    lines = validator.read_lines(spark, a.path)
    bad = lines.where("error is not null").count()
    report = [r.asDict() for r in validator.report(validator.all_findings(lines.where("error is null").select("record.*"))).collect()]
    print(json.dumps({"unreadable": bad, "findings": report}))
    return int(bool(bad or report))


def generate(spark, a: argparse.Namespace) -> int:
    """A run from files to its report: 0 completed, 1 failed, 2 refused, 3 stopped."""
    from loomspan import schema
    from loomspan.functions.text import new_run_id
    from loomspan.plans import outcome, report, segments
    from loomspan.plans.checkpoint import CheckpointError
    from loomspan.sources import corpus, store

    try:
        config, document, rubric = corpus.load_config(a.config), corpus.domain_document(a.document), corpus.rubric(a.rubric)
        problems = outcome.refuse(spark)
        run_id = a.run_id or (segments.only_staged(spark, a.out) if a.resume else new_run_id())
        run = segments.SegmentedRun(spark, config, a.seed, document, rubric, run_id, a.out, approvals=corpus.read_approvals(spark, a.approvals) if a.approvals else None)
        if outcome.finished(run.store, a.out, run_id):
            problems.append(f"run {run_id} is published already")
        if problems:
            raise corpus.ConfigError(problems)
        responses = spark.read.schema(segments.RESPONSES).option("mode", "FAILFAST").json(a.responses)
        found = segments.run_table(run, responses, config["checkpoint_interval"], a.resume)
    except (corpus.ConfigError, CheckpointError, store.AlreadyThere) as e:
        print(f"refused: {e}", file=sys.stderr)
        return schema.RUN_OUTCOMES["refused"]
    print(json.dumps({k: v for k, v in found.items() if k != "manifest"}, indent=2, sort_keys=True) if a.json else report.as_text(found))
    return outcome.exit_status(found)


if __name__ == "__main__":
    sys.exit(main())
