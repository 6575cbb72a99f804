"""Row gates: each rejected response gets exactly one reason, the first that holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan import schema
from loomspan.functions.text import is_blank, record_id, strip

CONVERSATION = "struct<scenario:string,turns:array<struct<role:string,content:string>>>"


def _keys_are(json: Column, *keys: str) -> Column:
    found = F.json_object_keys(json)
    return found.isNotNull() & (F.size(F.array_except(found, F.array(*map(F.lit, keys)))) == 0) & (F.size(found) == len(keys))


def parse_candidate(text: Column | str) -> Column:
    return F.from_json(text, CONVERSATION)


def structural_reason(text: str, turn_count: str, stop_reason: str, candidate: str = "candidate") -> Column:
    """Why a generated response is refused, or null: truncated, not JSON, wrong
    shape, wrong number of turns, wrong first speaker, speakers not alternating,
    blank turn, blank scenario, in this order.  ``candidate`` is the parsed text."""
    turns = F.col(candidate)["turns"]
    raw_turns = F.from_json(F.get_json_object(text, "$.turns"), "array<string>")
    shape_ok = (
        _keys_are(F.col(text), "scenario", "turns")
        & F.col(candidate)["scenario"].isNotNull()
        & turns.isNotNull()
        & (F.size(turns) >= 2)
        & F.forall(raw_turns, lambda t: _keys_are(t, "role", "content"))
        & F.forall(turns, lambda t: F.coalesce(t["role"].isin(*schema.ROLES) & t["content"].isNotNull(), F.lit(False)))
    )
    return F.coalesce(
        F.when(F.col(stop_reason).isin("max_tokens", "length"), F.lit("truncated")),
        F.when(F.json_object_keys(F.col(text)).isNull(), F.lit("not_json")),
        F.when(~F.coalesce(shape_ok, F.lit(False)), F.lit("shape")),
        F.when(F.size(turns) != F.col(turn_count), F.lit("turn_count")),
        F.when(turns[0]["role"] != "customer", F.lit("first_speaker")),
        F.when(~alternating(turns), F.lit("alternation")),
        F.when(F.exists(turns, lambda t: is_blank(t["content"])), F.lit("blank_turn")),
        F.when(is_blank(F.col(candidate)["scenario"]), F.lit("blank_scenario")),
    )


def alternating(turns: Column, role: str = "role") -> Column:
    """Whether no two neighbouring turns have one role."""
    return F.size(F.filter(turns, lambda t, i: (i > 0) & (t[role] == F.get(turns, i - 1)[role]))) == 0


def verdict(text: Column | str, weights: dict[str, float]) -> Column:
    """``struct<score, problem>`` of a judge's response: the weighted mean over the
    declared criteria, added in the order of the weights, or why there is none."""
    text = F.col(text) if isinstance(text, str) else text
    criteria = F.from_json(F.get_json_object(text, "$.criteria"), "map<string,double>")
    values = [F.try_element_at(criteria, F.lit(k)) for k in weights]
    bad = F.lit(False)
    for v in values:
        bad = bad | v.isNull() | (v < 0) | (v > 1)
    total = F.lit(0.0)
    for v, w in zip(values, weights.values()):
        total = total + v * F.lit(float(w))
    extra = F.size(F.array_except(F.json_object_keys(text), F.array(F.lit("criteria"), F.lit("justification")))) > 0
    problem = F.when(F.json_object_keys(text).isNull() | F.coalesce(extra, F.lit(True)) | criteria.isNull() | F.coalesce(bad, F.lit(True)), F.lit("unjudgeable"))
    return F.struct(F.when(problem.isNull(), total).alias("score"), problem.alias("problem"))


def meets(score: Column | str, threshold: float) -> Column:
    """Coherence is enough at the threshold itself."""
    return (F.col(score) if isinstance(score, str) else score) >= F.lit(threshold)


#: The columns of a record.
RECORD = ("schema_version", "record_id", "run_id", "record_index", "source_id", "subdomain", "scenario", "metadata", "turns", "quality", "generation")


def violations(record: dict[str, Column] | None = None) -> Column:
    """All violations of the record contract by a row, as an array of names."""
    c = record or {k: F.col(k) for k in RECORD}
    m, t = c["metadata"], c["turns"]
    empty = lambda x: x.isNull() | (F.length(x) < 1)
    rules = [
        ("schema_version", c["schema_version"].isNull() | ~c["schema_version"].rlike(r"^[0-9]+\.[0-9]+\.[0-9]+$")),
        *((k, empty(c[k])) for k in ("record_id", "run_id", "source_id", "subdomain", "scenario")),
        ("record_index", c["record_index"].isNull() | (c["record_index"] < 0)),
        *((d, ~F.coalesce(m[d].isin(*members), F.lit(False))) for d, members in schema.MEMBERS.items()),
        ("created_at", m["created_at"].isNull()),
        ("resolved_at_missing", (m["resolution_status"] == "resolved") & m["resolved_at"].isNull()),
        ("resolved_at_unexpected", (m["resolution_status"] != "resolved") & m["resolved_at"].isNotNull()),
        ("resolved_before_created", m["resolved_at"] < m["created_at"]),
        ("too_few_turns", t.isNull() | (F.size(t) < 2)),
        ("turn_index", F.size(F.filter(t, lambda x, i: ~x["index"].eqNullSafe(i))) > 0),
        ("role", F.exists(t, lambda x: ~F.coalesce(x["role"].isin(*schema.ROLES), F.lit(False)))),
        ("first_speaker", F.get(t, F.lit(0))["role"] != "customer"),
        ("alternation", ~alternating(t)),
        ("blank_turn", F.exists(t, lambda x: F.coalesce(is_blank(x["content"]), F.lit(True)))),
        ("coherence_score", ~F.coalesce(c["quality"]["coherence_score"].between(0, 1), F.lit(False))),
        *((f, empty(v)) for f, v in (("rubric_id", c["quality"]["rubric_id"]), ("model_id", c["generation"]["model_id"]), ("judge_model_id", c["generation"]["judge_model_id"]))),
    ]
    return F.filter(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules)), lambda x: x.isNotNull())


def aware(text: Column | str) -> Column:
    """Whether a timestamp's text names its zone; a cast would hide it."""
    return (F.col(text) if isinstance(text, str) else text).rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$")


def record_columns(run_id: str, source_id: str, rubric_id: str) -> list[Column]:
    """A record's columns, of a slot joined with an accepted candidate and its score."""
    turns = F.transform("candidate.turns", lambda t, i: F.struct(i.alias("index"), t["role"].alias("role"), t["content"].alias("content")))
    return [
        F.lit(schema.SCHEMA_VERSION).alias("schema_version"),
        record_id(F.lit(run_id), F.col("position")).alias("record_id"),
        F.lit(run_id).alias("run_id"),
        F.col("position").cast("int").alias("record_index"),
        F.lit(source_id).alias("source_id"),
        F.col("subdomain"),
        strip("candidate.scenario").alias("scenario"),
        F.struct("category", "priority", "channel", "resolution_status", "created_at", "resolved_at").alias("metadata"),
        turns.alias("turns"),
        F.struct(F.col("score").alias("coherence_score"), F.lit(rubric_id).alias("rubric_id")).alias("quality"),
        F.struct("model_id", "judge_model_id").alias("generation"),
    ]


def assemble(df: DataFrame, run_id: str, source_id: str, rubric_id: str) -> DataFrame:
    """Records from slots joined with accepted candidates and scores."""
    return df.select(*record_columns(run_id, source_id, rubric_id))
