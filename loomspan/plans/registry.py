"""All queries of the engine by name, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomspan import schema
from loomspan.functions import text as tx
from loomspan.operators import calibration, composition, duplicates, gates, manifest, metrics, planning, privacy, validator
from loomspan.plans import adapters as ad
from loomspan.plans import checkpoint, run_queries
from loomspan.plans.oracles import ORACLES
from loomspan.sources import corpus

#: What the order adapter's corpus was asked to be.
REQUESTED = {
    "category": {"AUTOMOBILE": 0.25, "BUILDING": 0.20, "FURNITURE": 0.20, "HOUSEHOLD": 0.20, "MACHINERY": 0.15},
    "priority": {"1-URGENT": 0.20, "2-HIGH": 0.20, "3-MEDIUM": 0.20, "4-NOT SPECIFIED": 0.20, "5-LOW": 0.20},
    "channel": {"0": 0.25, "1": 0.25, "2": 0.30, "3": 0.20},
    "resolution_status": {"resolved": 0.45, "unresolved": 0.45, "escalated": 0.10},
}
TOLERANCE_PP = 2.0
SEED = 7
QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _want(spark: SparkSession) -> DataFrame:
    return composition.requested(spark, REQUESTED)


def _drift(spark: SparkSession, d: str) -> DataFrame:
    return composition.drift(_want(spark), composition.shares(ad.ticket_meta(spark, d)))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Requested and achieved shares of all members, with breaches marked."""
    over = composition.breaches(_drift(spark, d), TOLERANCE_PP).select("dimension", "member", F.lit(True).alias("breach"))
    return _drift(spark, d).join(over, ["dimension", "member"], "left").withColumn("breach", F.coalesce("breach", F.lit(False)))


@query
def composition_achieved(spark, d):
    return composition.shares(ad.ticket_meta(spark, d))


@query
def composition_grouping_sets(spark, d):
    return composition.shares_by_grouping_sets(ad.ticket_meta(spark, d))


@query
def composition_drift(spark, d):
    return _drift(spark, d).select("dimension", "member", "requested", F.round("achieved", 9).alias("achieved"), F.round("drift_pp", 6).alias("drift_pp"))


@query
def composition_breaches(spark, d):
    return composition.breaches(_drift(spark, d), TOLERANCE_PP).select("dimension", "member", F.round("drift_pp", 6).alias("drift_pp"))


@query
def composition_worst_member(spark, d):
    return composition.worst_member(_drift(spark, d)).select("dimension", "member", F.round("drift_pp", 6).alias("drift_pp"))


@query
def composition_problems(spark, d):
    known = composition.shares(ad.ticket_meta(spark, d)).select("dimension", "member")
    asked = composition.requested(spark, {**REQUESTED, "channel": {"0": 0.5, "9": 0.4}})
    return composition.problems(asked, known)


@query
def drift_attribution(spark, d):
    n = ad.ticket_meta(spark, d).count()
    counts = composition.apportion(_want(spark), n)
    assigned = counts.select("dimension", "member", (F.col("n") / F.sum("n").over(Window.partitionBy("dimension"))).alias("share"))
    return composition.attribute(_want(spark), assigned, composition.shares(ad.ticket_meta(spark, d)))


@query
def apportion_largest_remainder(spark, d):
    return composition.apportion(_want(spark), ad.ticket_meta(spark, d).count())


@query
def slot_pool_assignment(spark, d):
    """A slot for each order."""
    return planning.pool_assignment(_want(spark), ad.table(spark, d, "orders").count(), SEED)


@query
def slot_plan(spark, d):
    """Turn counts and times of a slot for each order, with market segments as
    subdomains; the pools are another query."""
    names = [r[0] for r in ad.table(spark, d, "customer").select("c_mktsegment").distinct().collect()]
    drawn = planning.draws(ad.table(spark, d, "orders").count(), SEED, schema.DEFAULTS, names, spark)
    return drawn.select("position", "subdomain", "turn_count", F.col("created_s").cast("long").alias("created_s"), F.col("resolution_s").cast("long").alias("resolution_s"))


@query
def seeded_sample(spark, d):
    return planning.seeded_sample(ad.table(spark, d, "documents").select("doc_id", "source"), 25, SEED, "doc_id")


@query
def record_ids_uuid5(spark, d):
    return ad.table(spark, d, "orders").select("o_orderkey", tx.record_id(F.lit("run-1"), F.col("o_orderkey")).alias("record_id"))


def _responses(spark, d):
    """Conversations as generated responses, with the number of turns asked for."""
    r = ad.records(spark, d)
    body = F.to_json(F.struct(F.concat(F.lit("case "), F.col("conv_id")).alias("scenario"), F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("turns")))
    cut = F.when(F.col("conv_id") % 11 == 0, F.expr("substr(body, 1, length(body) - 5)")).when(F.col("conv_id") % 13 == 0, F.expr("concat('{\"note\":1,', substr(body, 2))")).otherwise(F.col("body"))
    r = r.withColumn("body", body).withColumn("text", cut)
    asked = F.when(F.col("conv_id") % 5 == 0, 4).otherwise(F.size("turns"))
    return r.select("conv_id", "text", asked.alias("turn_count"), F.when(F.col("conv_id") % 17 == 0, "max_tokens").otherwise("stop").alias("stop_reason"))


@query
def structural_gate_reasons(spark, d):
    r = _responses(spark, d).withColumn("candidate", gates.parse_candidate("text"))
    return r.select("conv_id", gates.structural_reason("text", "turn_count", "stop_reason").alias("reason"))


def _contract_records(spark, d):
    """Conversations as records of the contract, with faults of all kinds."""
    return ad.records(spark, d).select(
        F.when(F.col("conv_id") % 9 == 0, "2.0.0").otherwise(schema.SCHEMA_VERSION).alias("schema_version"), F.concat(F.lit("r"), F.col("conv_id") % 90).alias("record_id"), F.lit("run").alias("run_id"),
        F.col("conv_id").cast("int").alias("record_index"), F.lit("s").alias("source_id"), F.lit("d").alias("subdomain"), F.lit("x").alias("scenario"),
        F.struct(F.lit("billing").alias("category"), F.lit("low").alias("priority"), F.lit("email").alias("channel"), F.lit("resolved").alias("resolution_status"), F.lit("2026-01-01").cast("timestamp").alias("created_at"),
                 F.when(F.col("conv_id") % 2 == 0, F.lit("2026-01-02")).cast("timestamp").alias("resolved_at")).alias("metadata"),
        F.transform("turns", lambda t: F.struct(t["index"].alias("index"), t["role"].alias("role"), t["content"].alias("content"))).alias("turns"),
        F.struct((F.col("conv_id") / 80.0).alias("coherence_score"), F.lit("q").alias("rubric_id")).alias("quality"), F.struct(F.lit("m").alias("model_id"), F.lit("j").alias("judge_model_id")).alias("generation"),
    )


@query
def invariant_violations(spark, d):
    """What the contract's gate says of all records."""
    return _contract_records(spark, d).select(F.col("record_index").alias("conv_id"), F.explode(gates.violations()).alias("violation"))


@query
def turn_index_contiguity(spark, d):
    by = Window.partitionBy("conv_id").orderBy("turn")
    t = ad.turns(spark, d).withColumn("ok", F.row_number().over(by) - 1 == F.col("turn"))
    return t.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("ok").alias("contiguous"))


@query
def role_alternation(spark, d):
    by = Window.partitionBy("conv_id").orderBy("turn")
    t = ad.turns(spark, d).withColumn("same", F.col("role") == F.lag("role").over(by))
    return t.groupBy("conv_id").agg(F.count_if("same").alias("repeats"), F.min_by("role", "turn").alias("first_role"))


@query
def content_fingerprints(spark, d):
    return ad.records(spark, d).select("conv_id", tx.content_fingerprint("turns").alias("fingerprint"))


@query
def nfc_fingerprints(spark, d):
    docs = ad.table(spark, d, "documents")
    return docs.select("doc_id", F.sha2(tx.nfc(tx.strip("text")), 256).alias("fingerprint"))


def _text_fp(spark, d):
    return ad.table(spark, d, "documents").select("doc_id", F.sha2(tx.strip("text"), 256).alias("fp"))


@query
def duplicate_flags(spark, d):
    return duplicates.flag_duplicates(_text_fp(spark, d), "fp", "doc_id").select("doc_id", "is_duplicate")


@query
def duplicate_groups(spark, d):
    return duplicates.duplicate_groups(_text_fp(spark, d), "fp", "doc_id")


@query
def duplicate_count(spark, d):
    return duplicates.count_duplicates(_text_fp(spark, d), "fp")


@query
def duplicate_record_ids(spark, d):
    return duplicates.duplicate_ids(ad.table(spark, d, "conversations"), "conv_id")


def _matches(spark, d):
    return privacy.matches(ad.table(spark, d, "documents"), None, "doc_id")


@query
def pii_matches(spark, d):
    return _matches(spark, d).select("doc_id", "category", "value")


@query
def pii_findings_masked(spark, d):
    return privacy.findings(_matches(spark, d)).select("doc_id", "category", "status", "masked")


@query
def pii_status_counts(spark, d):
    return privacy.findings(_matches(spark, d)).groupBy("category", "status").agg(F.count(F.lit(1)).alias("n"))


@query
def pii_blocking_documents(spark, d):
    return privacy.blocking(privacy.findings(_matches(spark, d))).select("doc_id").distinct()


@query
def approved_suppression(spark, d):
    """Findings after the phone numbers of every third document are approved."""
    found = _matches(spark, d)
    ok = found.where((F.col("category") == "PHONE") & (F.col("doc_id") % 3 == 0)).select(tx.value_fingerprint("category", "value").alias("fingerprint"))
    return privacy.findings(found, ok).groupBy("category", "status").agg(F.count(F.lit(1)).alias("n"))


@query
def scan_totals(spark, d):
    r = ad.records(spark, d)
    return r.agg(F.count(F.lit(1)).alias("records"), F.sum(F.size("turns") + 1).alias("fields"))


@query
def floor_probe(spark, d):
    """Each blocking category's canary set behind every document: in how many it is found."""
    hits = privacy.Detectors().probe(ad.table(spark, d, "documents"))
    rows = F.array(*(F.struct(F.lit(c).alias("expected"), "texts", F.col(c).alias("hits")) for c in privacy.CANARIES))
    return hits.select(F.explode(rows).alias("r")).select("r.*")


@query
def reject_reason_tally(spark, d):
    return metrics.discards(ad.attempts(spark, d))


LIMITS = {"privacy_finding": 0.005, "structural_invalid": 0.25}


@query
def discard_rates(spark, d):
    return metrics.rates(ad.attempts(spark, d), LIMITS).select("reason", "n", "generated", F.round("rate", 9).alias("rate"), "over")


@query
def rate_breaches(spark, d):
    return metrics.rates(ad.attempts(spark, d), LIMITS).where("over").select("reason", "n", "limit")


@query
def running_rate_first_breach(spark, d):
    e = ad.attempts(spark, d).withColumn("run", F.col("slot") % 16)
    return metrics.running_breach(e, "run", "event_id", "structural_invalid", 0.21, 20)


@query
def consecutive_failures(spark, d):
    runs = metrics.failure_runs(ad.attempts(spark, d), "slot", "event_id", F.col("reason").isNotNull())
    return runs.groupBy("slot").agg(F.max("failures").alias("longest"))


@query
def first_accepted_attempt(spark, d):
    return metrics.first_accepted(ad.attempts(spark, d), schema.DEFAULTS["max_attempts"])


@query
def reconciliation(spark, d):
    return manifest.reconcile(ad.attempts(spark, d).withColumn("run", F.col("slot") % 8), "run")


@query
def quarantine_rows(spark, d):
    return ad.attempts(spark, d).where("reason = 'privacy_finding'").select("slot", "attempt", "event_id")


@query
def score_histogram(spark, d):
    return metrics.histogram(ad.scores(spark, d), "judge")


@query
def score_summary_upper_median(spark, d):
    return metrics.summary(ad.scores(spark, d), "judge").select("n", "least", "largest", F.round("mean", 9).alias("mean"), "median")


@query
def score_spread(spark, d):
    both = ad.scores(spark, d).select(F.explode(F.array(F.struct(F.lit("judge").alias("side"), F.col("judge").alias("v")), F.struct(F.lit("human").alias("side"), F.col("human").alias("v")))).alias("x")).select("x.*")
    spread = both.groupBy("side").agg(F.count("v").alias("n"), F.count_distinct(F.round("v", 4)).alias("n_distinct"), F.min("v").alias("least"), F.max("v").alias("largest"))
    return spread.join(metrics.upper_median(both, "v", "side"), "side")


@query
def gate_agreement(spark, d):
    return calibration.gate_agreement(ad.scores(spark, d), 0.5).withColumn("rate", F.round("rate", 9))


@query
def spearman_avg_ranks(spark, d):
    return calibration.spearman(ad.scores(spark, d)).select("n", F.round("rho", 8).alias("rho"))


@query
def criterion_gap(spark, d):
    return calibration.criterion_gap(ad.scores(spark, d))


@query
def coherence_gate(spark, d):
    return ad.scores(spark, d).where(gates.meets("judge", schema.DEFAULTS["coherence_threshold"])).select("l_orderkey", "l_linenumber")


@query
def weighted_mean_score(spark, d):
    s = ad.scores(spark, d).withColumn("text", F.to_json(F.struct(F.col("judge_criteria").alias("criteria"), F.lit("x").alias("justification"))))
    v = gates.verdict("text", {"single_issue": 0.6, "metadata_fit": 0.4})
    return s.select("l_orderkey", "l_linenumber", v.alias("v")).select("l_orderkey", "l_linenumber", F.round("v.score", 9).alias("score"), "v.problem")


@query
def fallback_tally(spark, d):
    return metrics.fallbacks(ad.attempts(spark, d).where("accepted"), "view")


@query
def resume_prefix(spark, d):
    w = ad.table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("position")).where("l_orderkey % 3 <> 0 or position <> 1")
    return metrics.contiguous_prefix(w, "position", "l_orderkey")


@query
def rerun_equivalence(spark, d):
    a = ad.ticket_meta(spark, d)
    b = a.withColumn("priority", F.when(F.col("o_orderkey") % 50 == 0, F.lit("other")).otherwise(F.col("priority"))).where("o_orderkey % 7 <> 0")
    return manifest.rerun_differences(a, b, "o_orderkey", ["category", "priority", "channel"])


@query
def ordered_serialization(spark, d):
    """The lines of a corpus of all conversations."""
    return corpus.serialize(_contract_records(spark, d))


@query
def validator_report(spark, d):
    """Findings of all gates over conversations taken as records."""
    return validator.report(validator.all_findings(_contract_records(spark, d)))


@query
def traceability(spark, d):
    """Orders whose customer, as the run, is not among those of the first nations."""
    r = ad.table(spark, d, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_custkey").alias("run_id"))
    return manifest.untraceable(r, ad.table(spark, d, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("run_id")))


@query
def retry_tally(spark, d):
    kinds = F.when(F.col("event_type") == "error", "transport").when(F.col("event_type") == "click", "timeout").when(F.col("event_type") == "view", "refusal")
    return manifest.retries(ad.table(spark, d, "events").select((F.col("user_id") % 8).alias("run"), kinds.alias("error_kind")), "run")


@query
def resume_truncate(spark, d):
    return checkpoint.prefix(ad.ticket_meta(spark, d), 700, "o_orderkey")


@query
def resume_remaining(spark, d):
    slots = ad.ticket_meta(spark, d).withColumnRenamed("o_orderkey", "position")
    return checkpoint.remaining(slots, 700).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query
def request_spacing(spark, d):
    return metrics.request_spacing(ad.table(spark, d, "events"), "user_id", "ts", 3600)


@query
def judge_prompt_turns(spark, d):
    return ad.records(spark, d).select("conv_id", tx.numbered_turns("turns").alias("prompt"))


@query
def requested_turn_count(spark, d):
    slots = ad.table(spark, d, "part").select("p_partkey", F.lit("billing").alias("category"), F.lit("low").alias("priority"), F.lit("email").alias("channel"), F.lit("resolved").alias("resolution_status"), F.col("p_type").alias("subdomain"), F.col("p_size").alias("turn_count"))
    return slots.select("p_partkey", tx.requested_turns(tx.generator_prompt("Write a conversation.")).alias("turns"))


@query
def covered_types(spark, d):
    """Every category that is looked for, and how often it is found."""
    covered = spark.createDataFrame([(c,) for c in privacy.covered_types()], "category string")
    return covered.join(_matches(spark, d).groupBy("category").agg(F.count(F.lit(1)).alias("n")), "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))


@query
def turn_time_bounds(spark, d):
    """Line items as turns, said at shipping, of orders resolved 60 days after their date."""
    o, li = ad.table(spark, d, "orders"), ad.table(spark, d, "lineitem")
    t = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("record_id"), F.col("l_linenumber").alias("index"), F.col("l_shipdate").alias("said_at"), F.col("o_orderdate").alias("created_at"), (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("resolved_at")
    )
    return validator.time_findings(t)


@query
def upstream_ids(spark, d):
    return validator.upstream_findings(ad.table(spark, d, "labels").select(F.col("doc_id").alias("record_id")), ad.table(spark, d, "documents").where("lang <> 'fr'").select(F.col("doc_id").alias("record_id")))


@query
def duplicate_turn_groups(spark, d):
    """Documents as records of one turn: all members of each group of duplicates."""
    turns = F.array(F.struct(F.lit("customer").alias("role"), F.coalesce("text", F.lit("")).alias("content")))
    r = ad.table(spark, d, "documents").select(F.col("doc_id").alias("record_index"), F.concat(F.lit("r"), F.col("doc_id")).alias("record_id"), turns.alias("turns"))
    return validator.duplicate_members(r).select("kept", "record_id")


def _plain_only(text: str):
    """A finder that knows ASCII alone, and fails at other texts."""
    text.encode("ascii")
    return []


@query
def detector_errors(spark, d):
    """Documents at which a detector fails: they are reported, not taken for clean."""
    detectors = privacy.Detectors()
    detectors.register("plain_only", finder=_plain_only)
    fields = ad.table(spark, d, "documents").select(F.col("doc_id").alias("record_id"), F.lit("text").alias("field"), "text")
    return privacy.failed_fields(detectors.look(fields))


QUERIES |= run_queries.QUERIES
ORACLES |= run_queries.ORACLES
