"""A run over responses as they arrive, which can be killed anywhere and taken up again.

Responses come as files of a stream, or as one table.  Each batch of them becomes a
segment: the attempts it holds, gated, in a folder named by the batch's number.  Then the
batch's checkpoint is put where none is, and only that makes the segment count: it holds
all tallies and the summary of the run so far, so nothing is counted from segments again.
A batch that comes again after a crash finds its checkpoint and does nothing, or finds a
segment without one, which is cut and written anew.  What a run ends in thus does not
depend on where, or how often, it was killed.

Beside the segments lie ``inputs.json``, the fingerprints that must still hold when the
run is taken up, and one file for each start of it, with the revision of the code.

A response and its judgement must come in one batch; attempts at a slot may come in any.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from loomspan.operators import composition, manifest, metrics, monitoring, planning
from loomspan.operators.monitoring import Summary
from loomspan.plans.checkpoint import CheckpointError
from loomspan.plans.run import attempts
from loomspan.sources.store import Store, join

RESPONSES = "position long, attempt int, role string, text string, stop_reason string, model_id string, error_kind string"
INPUTS, STARTS, SEGMENTS, CHECKPOINTS, FOUND = "inputs.json", "starts", "segments", "checkpoints", "findings"


class Stopped(Exception):
    """The run has to stop, and why."""


def fingerprints(config: dict, seed: int, document: dict, rubric: dict, schema_version: str) -> dict[str, str]:
    """Of what must not change between a run's starts.  The code's revision is not among
    it: another one is another entry in the manifest."""
    sha = lambda x: hashlib.sha256(json.dumps(x, sort_keys=True, default=str).encode()).hexdigest()
    inputs = {"config": {k: v for k, v in config.items() if k != "code_revision"}, "seed": seed, "prompt_document": document, "rubric": rubric}
    return {k: sha(v) for k, v in inputs.items()} | {"schema_version": schema_version}


@dataclass
class Progress:
    """What a checkpoint holds: the batch, tallies, and the summary of the attempts."""

    batch: int
    generated: int
    discards: dict[str, int]
    retries: dict[str, int]
    summary: Summary

    def as_dict(self) -> dict:
        return {"batch": self.batch, "generated": self.generated, "discards": self.discards, "retries": self.retries, "summary": self.summary.as_dict()}

    @classmethod
    def of(cls, d: dict) -> Progress:
        return cls(d["batch"], d["generated"], d["discards"], d["retries"], Summary(**d["summary"]))


NOTHING = Progress(-1, 0, {}, {}, Summary())


@dataclass
class Staged:
    """The staged state of a run in a folder of its own."""

    spark: SparkSession
    folder: str

    def __post_init__(self):
        self.store = Store(self.spark)

    def at(self, *parts: str) -> str:
        return join(self.folder, *parts)

    def begin(self, run_id: str, inputs: dict[str, str], revision: dict, resume: bool) -> int:
        """Notes another start of the run and returns how many came before.  Taking up
        what isn't there, or with other inputs, is refused, and so is starting anew what is."""
        held = self.inputs()
        if held is None:
            if resume:
                raise CheckpointError(f"no run can be taken up in {self.folder}")
            self.store.put_json(self.at(INPUTS), {"run_id": run_id, "fingerprints": inputs}, new=True)
        else:
            if not resume:
                raise CheckpointError(f"a run is staged in {self.folder} already")
            if held["run_id"] != run_id:
                raise CheckpointError(f"{self.folder} holds run {held['run_id']}")
            differ = sorted(k for k in held["fingerprints"].keys() | inputs.keys() if held["fingerprints"].get(k) != inputs.get(k))
            if differ:
                raise CheckpointError(f"changed since the run began: {', '.join(differ)}")
        self.cut_unfinished()
        before = len(self.store.names(self.at(STARTS)))
        start = {"started_at": datetime.now(timezone.utc).isoformat(), "code_revision": revision, "first_batch": self.progress().batch + 1}
        self.store.put_json(self.at(STARTS, f"{before:06d}.json"), start, new=True)
        return before

    def inputs(self) -> dict | None:
        return self._json(self.at(INPUTS))

    def starts(self) -> list[dict]:
        return [self.store.read_json(self.at(STARTS, n)) for n in self.store.names(self.at(STARTS)) if n.endswith(".json")]

    def _json(self, path: str) -> dict | None:
        """A file's content; a torn file is removed and counts as none."""
        if not self.store.exists(path):
            return None
        try:
            return self.store.read_json(path)
        except ValueError:
            self.store.delete(path)
            return None

    def batches(self) -> list[int]:
        """Numbers of batches with a checkpoint."""
        return [int(n[:-5]) for n in self.store.names(self.at(CHECKPOINTS)) if n.endswith(".json") and self._json(self.at(CHECKPOINTS, n)) is not None]

    def progress(self) -> Progress:
        done = self.batches()
        return Progress.of(self._json(self.at(CHECKPOINTS, f"{max(done):09d}.json"))) if done else NOTHING

    def cut_unfinished(self) -> list[str]:
        """Removes segments that no checkpoint names."""
        done = {f"batch={b}" for b in self.batches()}
        out = [n for kind in (SEGMENTS, FOUND) for n in self.store.names(self.at(kind)) if n not in done and self.store.delete(self.at(kind, n))]
        return out

    def segment(self, batch: int, kind: str = SEGMENTS) -> str:
        return self.at(kind, f"batch={batch}")

    def commit(self, p: Progress) -> None:
        self.store.put_json(self.at(CHECKPOINTS, f"{p.batch:09d}.json"), p.as_dict(), new=True)

    def read(self, schema, kind: str = SEGMENTS) -> DataFrame:
        """Rows of all segments that count; the batch's number is a column."""
        paths = [self.segment(b, kind) for b in self.batches() if self.store.exists(self.segment(b, kind))]
        if not paths:
            return self.spark.createDataFrame([], schema).withColumn("batch", F.lit(None).cast("int"))
        return self.spark.read.schema(schema).option("basePath", self.at(kind)).parquet(*paths)


@dataclass
class SegmentedRun:
    """A run: its inputs, and where it is staged and published.

    ``on`` is called with the name of each point that is passed, and may raise there:
    tests kill a run that way."""

    spark: SparkSession
    config: dict
    seed: int
    document: dict
    rubric: dict
    run_id: str
    out_dir: str
    schema_version: str = "1.0.0"
    approvals: DataFrame | None = None
    on: Callable[[str], None] = lambda point: None

    def __post_init__(self):
        self.staged = Staged(self.spark, join(self.out_dir, f"{self.run_id}.run"))
        self.store = self.staged.store
        self._plan = None

    @property
    def plan(self) -> DataFrame:
        """All slots, made once and kept with the run: each batch is joined with them."""
        if self._plan is None:
            want, path = composition.requested(self.spark, self.config["composition"]), self.staged.at("plan")
            made = planning.slots(want, self.config["record_count"], self.seed, self.config, self.document["subdomains"])
            if not self.store.exists(join(path, "_SUCCESS")):
                made.write.mode("overwrite").parquet(path)
            self._plan = self.spark.read.schema(made.schema).parquet(path)
        return self._plan

    def begin(self, resume: bool = False) -> None:
        inputs = fingerprints(self.config, self.seed, self.document, self.rubric, self.schema_version)
        revision = self.config.get("code_revision") or {"commit": None, "dirty": False}
        self.resumes = self.staged.begin(self.run_id, inputs, revision, resume)

    # --- one batch ---

    def take(self, responses: DataFrame, batch: int) -> None:
        """Gates a batch into its segment and commits it; again for one that counts: nothing."""
        if batch in self.staged.batches():
            return
        before = self.staged.progress()
        path = self.staged.segment(batch)
        self.on("before segment")
        gated = attempts(self.plan, responses, self.rubric["weights"], self.config, self.run_id, self.document["source_id"], self.rubric["rubric_id"], self.approvals, keep_findings=True)
        gated.write.mode("overwrite").parquet(path)
        self.on("after segment")
        rows = self.spark.read.schema(gated.schema).parquet(path)
        self._quarantine(rows, batch)
        tally = {r["reason"]: r["n"] for r in metrics.discards(rows).collect()}
        retries = {r["error_kind"]: r["n"] for r in manifest.retries(responses).collect()}
        n = rows.count()
        add = lambda a, b: {k: a.get(k, 0) + b.get(k, 0) for k in sorted(a.keys() | b.keys())}
        now = Progress(batch, before.generated + n, add(before.discards, tally), add(before.retries, retries), before.summary.merge(self._summary(rows, before.generated)))
        self.on("before checkpoint")
        self.staged.commit(now)
        self.on("after checkpoint")

    def _summary(self, rows: DataFrame, before: int) -> Summary:
        """Of the batch's attempts in the order of position and attempt."""
        order = F.col("position") * 1000 + F.col("attempt")
        outage = F.col("reason").isNotNull() & (F.col("reason") != "privacy_finding") & (F.col("reason") != "coherence_below_threshold")
        shaped = rows.select(order.alias("seq"), outage.alias("failed"), (F.col("reason") == "privacy_finding").alias("hit"))
        return monitoring.Run(shaped, "seq", F.col("failed"), F.col("hit"), self.config["max_privacy_discard_rate"]).summary()

    def _quarantine(self, rows: DataFrame, batch: int) -> None:
        """Blocked candidates with their masked findings, apart from the corpus."""
        held = rows.where("reason = 'privacy_finding'").select("position", "attempt", "candidate", "findings")
        held.write.mode("overwrite").parquet(self.staged.segment(batch, FOUND))

    def stop(self, p: Progress | None = None) -> str | None:
        """Why the run must stop now, if it must."""
        p = self.staged.progress() if p is None else p
        least = metrics.minimum_sample(self.config["record_count"])
        why = monitoring.stop_reason(p.summary, self.config["max_consecutive_failures"], least)
        if why is None and p.generated >= least:
            rate = p.discards.get("coherence_below_threshold", 0) / p.generated
            why = "discard_rate" if rate > self.config["max_coherence_discard_rate"] else None
        return why

    def each(self, responses: DataFrame, batch: int) -> None:
        """A batch of a stream; raises ``Stopped`` once the run must stop."""
        self.take(responses, batch)
        why = self.stop()
        if why:
            raise Stopped(why)

    def follow(self, responses: DataFrame, **options: str) -> StreamingQuery:
        """Starts the run over a stream of responses, from where it was."""
        w = responses.writeStream.option("checkpointLocation", self.staged.at("stream"))
        for k, v in options.items():
            w = w.option(k, v)
        return w.foreachBatch(self.each).start()

    # --- the end ---

    def accepted(self) -> DataFrame:
        """Of each slot the first accepted attempt, over all segments that count."""
        rows = self.staged.read(self.schema())
        return rows.where("accepted").groupBy("position").agg(F.min_by("record", "attempt").alias("record")).select("record.*")

    def schema(self):
        none = self.spark.createDataFrame([], RESPONSES)
        return attempts(self.plan, none, self.rubric["weights"], self.config, self.run_id, self.document["source_id"], self.rubric["rubric_id"], None, keep_findings=True).schema

    def finish(self) -> dict:
        """Writes and publishes the corpus if the run passed, and always the manifest, the
        report and, where something was blocked, the quarantine.  Can be called again."""
        from loomspan.plans import outcome

        return outcome.conclude(self)


def run_table(run: SegmentedRun, responses: DataFrame, interval: int, resume: bool = False) -> dict:
    """A run over a table of responses, in batches of ``interval`` positions."""
    run.begin(resume)
    last = responses.agg(F.max("position")).first()[0]
    for b in range(0 if last is None else last // interval + 1):
        try:
            run.each(responses.where(F.col("position").between(b * interval, (b + 1) * interval - 1)), b)
        except Stopped:
            break
    return run.finish()


def run_stream(run: SegmentedRun, responses: DataFrame, resume: bool = False) -> dict:
    """A run over what a stream of responses has by now."""
    run.begin(resume)
    query = run.follow(responses)
    try:
        query.processAllAvailable()
    except Exception:
        if run.stop() is None:
            raise
    finally:
        query.stop()
    return run.finish()




def only_staged(spark: SparkSession, out_dir: str) -> str:
    """The name of the one run that is staged; an error for none or several."""
    found = [n.removesuffix(".run") for n in Store(spark).names(out_dir) if n.endswith(".run")]
    if len(found) != 1:
        raise CheckpointError("no run can be taken up" if not found else f"several runs could be taken up: {', '.join(found)}")
    return found[0]
