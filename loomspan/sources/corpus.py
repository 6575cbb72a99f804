"""Files that a run reads and writes: corpora, samples, configs, documents, manifests."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import tomllib
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan import schema
from loomspan.sources import store


class ConfigError(ValueError):
    """All problems of a file at once."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON Lines corpus under the contract's schema; a malformed line fails."""
    return spark.read.schema(schema.RECORD_DDL).option("mode", "FAILFAST").json(path)


def serialize(records: DataFrame) -> DataFrame:
    """``record_index, line``: compact JSON with keys sorted at every level."""
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    meta = F.struct("metadata.category", "metadata.channel", stamp("metadata.created_at").alias("created_at"), "metadata.priority", "metadata.resolution_status", stamp("metadata.resolved_at").alias("resolved_at"))
    line = F.to_json(
        F.struct(
            F.struct("generation.judge_model_id", "generation.model_id").alias("generation"), meta.alias("metadata"), F.struct("quality.coherence_score", "quality.rubric_id").alias("quality"),
            "record_id", "record_index", "run_id", "scenario", "schema_version", "source_id", "subdomain",
            F.transform("turns", lambda t: F.struct(t["content"].alias("content"), t["index"].alias("index"), t["role"].alias("role"))).alias("turns"),
        ),
        {"ignoreNullFields": "false"},
    )
    return records.select("record_index", line.alias("line"))


def write_ordered(records: DataFrame, path: str) -> None:
    """The corpus as JSON Lines in files that follow each other by record index.

    The range partitions are sorted in themselves, so no single task holds it all."""
    serialize(records).repartitionByRange("record_index").sortWithinPartitions("record_index").select("line").write.mode("errorifexists").text(path)


def publish(staging: str, destination: str, *, gate_passed: bool) -> None:
    """One rename, refused without a passed gate or over anything that is there."""
    if not gate_passed:
        raise PermissionError("the gate was not passed")
    if os.path.exists(destination):
        raise FileExistsError(destination)
    os.rename(staging, destination)


def read_sample(spark: SparkSession, path: str) -> DataFrame:
    """A scored review sample (tens of rows).  A missing or null human score is an
    error that names the line."""
    rows = []
    for n, line in enumerate(Path(path).read_text().splitlines(), 1):
        if not line.strip():
            continue
        r = json.loads(line)
        if r.get("human_score") is None:
            raise ConfigError([f"line {n}: no human_score"])
        to_map = lambda m: {k: float(v) for k, v in (m or {}).items()}
        rows.append((str(r.get("record_id") or f"line-{n}"), float(r["coherence_score"]), float(r["human_score"]), to_map(r.get("judge_criteria")), to_map(r.get("human_criteria")), r.get("rubric_id") or ""))
    return spark.createDataFrame(rows, "record_id string, judge double, human double, judge_criteria map<string,double>, human_criteria map<string,double>, rubric_id string")


def front_matter(text: str) -> tuple[dict, str]:
    """Fields and body of a document that may begin with a fenced block of fields:
    scalars, flat lists, and one level of nested fields.  An open fence is all body."""
    lines = text.split("\n")
    if lines[0].strip() != "---" or "---" not in (x.strip() for x in lines[1:]):
        return {}, text
    end = 1 + [x.strip() for x in lines[1:]].index("---")
    out: dict = {}
    key = None
    for raw in lines[1:end]:
        if not raw.strip() or raw.lstrip().startswith("#"):
            continue
        item = raw.strip()
        if raw[0] in " \t-" and key is not None and item.startswith("- "):
            if not isinstance(out[key], list):
                out[key] = []
            out[key].append(_scalar(item[2:]))
        elif ":" in item:
            name, _, value = item.partition(":")
            if raw[0] in " \t" and key is not None:
                if not isinstance(out[key], dict):
                    out[key] = {}
                out[key][name.strip()] = _scalar(value)
            else:
                key = name.strip()
                out[key] = _scalar(value)
    return out, "\n".join(lines[end + 1 :])


def _scalar(text: str) -> int | float | str:
    text = text.strip().strip("\"'")
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def domain_document(path: str) -> dict:
    """Subdomains (sorted), body and source id of a domain document."""
    raw = Path(path).read_bytes()
    fields, body = front_matter(raw.decode())
    names = fields.get("subdomains") or []
    problems = []
    if not isinstance(names, list) or not names:
        problems.append("no subdomains")
    elif len(set(names)) < len(names):
        problems.append("a subdomain is listed twice")
    if not body.strip():
        problems.append("no body")
    if problems:
        raise ConfigError(problems)
    return {"subdomains": sorted(map(str, names)), "body": body, "source_id": f"{Path(path).name}@{hashlib.sha256(raw).hexdigest()[:12]}", "sha256": hashlib.sha256(raw).hexdigest()}


def rubric(path: str) -> dict:
    fields, body = front_matter(Path(path).read_text())
    weights = fields.get("weights") or fields.get("criteria") or {}
    problems = [] if (fields.get("rubric_id") or fields.get("id")) else ["no id"]
    if not isinstance(weights, dict) or not weights:
        problems.append("no weights")
    elif any(not isinstance(w, (int, float)) or w <= 0 for w in weights.values()):
        problems.append("a weight is not above 0")
    elif abs(sum(weights.values()) - 1) > 1e-6:
        problems.append("weights do not sum to 1")
    if not body.strip():
        problems.append("no body")
    if problems:
        raise ConfigError(problems)
    return {"rubric_id": str(fields.get("rubric_id") or fields.get("id")), "weights": {k: float(v) for k, v in weights.items()}, "body": body}


#: Settings that a configuration may have.
SETTINGS = {*schema.DEFAULTS, "composition", "record_count", "seed", "models", "output_path", "prompt_document", "rubric", "budget", "concurrency", "requests_per_minute"}

#: Parts of names of settings that tell how to reach a service or who asks.
CONNECTION_WORDS = ("key", "token", "secret", "password", "credential", "endpoint", "base_url", "region", "profile")


def misplaced(settings: dict, inside: bool = False) -> list[str]:
    """Names of connection settings among what is passed on to models."""
    out = []
    for k, v in settings.items():
        if inside and any(w in k.lower() for w in CONNECTION_WORDS) and k not in ("max_tokens",):
            out.append(k)
        if isinstance(v, dict):
            out += misplaced(v, inside or k == "extra")
    return sorted(out)


def load_config(path: str) -> dict:
    """A TOML run configuration over the defaults, or all its problems at once."""
    try:
        given = tomllib.loads(Path(path).read_text())
    except (OSError, tomllib.TOMLDecodeError) as e:
        raise ConfigError([str(e)]) from e
    config = {**schema.DEFAULTS, "composition": schema.DEFAULT_COMPOSITION, **given}
    problems = [f"unknown setting {k}" for k in sorted(given.keys() - SETTINGS)]
    problems += [f"{k}: connection settings belong in the environment" for k in misplaced(given)]
    for k in ("max_coherence_discard_rate", "max_privacy_discard_rate", "coherence_threshold"):
        if not 0 <= config[k] <= 1:
            problems.append(f"{k} is not between 0 and 1")
    if any(config[k] < 1 for k in ("window_days", "max_attempts", "max_consecutive_failures", "checkpoint_interval")):
        problems.append("window, attempts, failures and interval must be at least 1")
    if not 0 <= config["min_resolution_seconds"] <= config["max_resolution_seconds"]:
        problems.append("the least resolution time is above the most")
    for role in ("generator", "judge"):
        if role in config.get("models", {}) and not config["models"][role].get("model_id"):
            problems.append(f"{role} has no model_id")
    n = config.get("record_count")
    if isinstance(n, bool) or not isinstance(n, int) or n < 1:
        problems.append("record_count is not a whole number above 0")
    if not 2 <= config["min_turns"] <= config["max_turns"]:
        problems.append("turns must be at least 2, and the least not above the most")
    for d, members in config["composition"].items():
        if d not in schema.MEMBERS:
            problems.append(f"unknown dimension {d}")
            continue
        problems += [f"{d}: unknown member {m}" for m in members if m not in schema.MEMBERS[d]]
        if abs(sum(members.values()) - 1) > 1e-6:
            problems.append(f"{d}: shares do not sum to 1")
        if not problems:
            problems += [f"{d}: {m} would be less than one record" for m, p in members.items() if 0 < p * n < 1]
    if not problems and config["tolerance_pp"] < 100 / n:
        problems.append("the tolerance is finer than one record")
    if problems:
        raise ConfigError(problems)
    return config


def sha256_file(path: str) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()


def artifact_sha256(spark: SparkSession, path: str) -> str | None:
    """The checksum of a file, or of a folder of parts that follow each other by name:
    SHA-256 of the parts' checksums, each made by the task that reads the part.  None
    where nothing is there."""
    return sha256_file(path) if os.path.isfile(path) else store.parts_sha256(spark, path)


def read_manifest(path: str) -> dict:
    """A manifest: a JSON object that names its run."""
    try:
        found = json.loads(Path(path).read_text())
    except (OSError, ValueError) as e:
        raise ConfigError([str(e)]) from e
    if not isinstance(found, dict) or not found.get("run_id"):
        raise ConfigError([f"{path} is not a manifest"])
    return found


def quarantined_text(quarantine: DataFrame, record_id: str, field: str) -> str | None:
    """The whole text of a quarantined record's field, ``scenario`` or ``turns[i].content``."""
    i = re.fullmatch(r"turns\[(\d+)\]\.content", field)
    text = F.get(F.col("record.turns"), F.lit(int(i[1])))["content"] if i else F.col("record.scenario") if field == "scenario" else F.lit(None).cast("string")
    row = quarantine.where(F.col("record.record_id") == record_id).select(text.alias("t")).first()
    return row and row["t"]


def retain(staging: str, checkpoint: str, *, succeeded: bool) -> list[str]:
    """Removes staging and checkpoint of a run that succeeded; what is left otherwise."""
    here = [p for p in (staging, checkpoint) if os.path.exists(p)]
    if not succeeded:
        return here
    for p in here:
        shutil.rmtree(p) if os.path.isdir(p) else os.remove(p)
    return []


def write_json(document: dict, path: str) -> None:
    """Written beside the place and renamed into it."""
    temporary = f"{path}.tmp"
    with open(temporary, "w") as f:
        json.dump(document, f, indent=2, sort_keys=True, ensure_ascii=False)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, path)


def write_quarantine(records: DataFrame, findings: DataFrame, path: str) -> None:
    """Blocked records with their findings, appended as JSON Lines."""
    found = findings.groupBy("record_id").agg(F.collect_list(F.struct("field", "category", "detector", "status", "masked")).alias("findings"))
    records.join(found, "record_id").select(F.struct(*[F.col(c) for c in records.columns]).alias("record"), "findings").write.mode("append").json(path)


def read_approvals(spark: SparkSession, path: str) -> DataFrame:
    """Approvals from wherever Spark reads; none where no store was written yet."""
    ddl = "fingerprint string, category string, reason string, approved_by string, approved_on string"
    return spark.read.schema(ddl).json(path, multiLine=True) if store.Store(spark).exists(path) else spark.createDataFrame([], ddl)


def save_approvals(approvals: DataFrame, path: str) -> None:
    """A small table, by design: what people approved by hand."""
    rows = sorted((r.asDict() for r in approvals.collect()), key=lambda r: r["fingerprint"])
    store.Store(approvals.sparkSession).put_json(path, rows)
