"""The record contract: fixed values, Spark schema, versions and JSON Schema export."""

from __future__ import annotations

import re


# Fixed values of the record contract.
SCHEMA_VERSION = "1.0.0"
ROLES = ("customer", "agent")
CATEGORIES = ("billing", "technical", "account", "shipping", "product", "other")
PRIORITIES = ("low", "normal", "high", "urgent")
CHANNELS = ("email", "chat", "phone", "web_form")
RESOLUTIONS = ("resolved", "unresolved", "escalated", "abandoned")
DIMENSIONS = ("category", "priority", "channel", "resolution_status")
PII_CATEGORIES = ("EMAIL", "PHONE", "CREDIT_CARD", "US_SSN", "IP_ADDRESS")
BLOCKING = ("EMAIL", "PHONE", "CREDIT_CARD", "US_SSN")
ADVISORY = ("IP_ADDRESS",)
RUN_OUTCOMES = {"completed": 0, "failed": 1, "refused": 2, "stopped": 3}

MEMBERS = dict(zip(DIMENSIONS, (CATEGORIES, PRIORITIES, CHANNELS, RESOLUTIONS)))

# Default composition, limits and run settings.
DEFAULT_COMPOSITION = {
    "category": dict(zip(CATEGORIES, (0.25, 0.25, 0.20, 0.15, 0.10, 0.05))),
    "priority": dict(zip(PRIORITIES, (0.20, 0.50, 0.20, 0.10))),
    "channel": dict(zip(CHANNELS, (0.40, 0.35, 0.15, 0.10))),
    "resolution_status": dict(zip(RESOLUTIONS, (0.70, 0.10, 0.15, 0.05))),
}
DEFAULTS = {
    "min_turns": 4,
    "max_turns": 12,
    "coherence_threshold": 0.8,
    "max_coherence_discard_rate": 0.10,
    "max_privacy_discard_rate": 0.005,
    "tolerance_pp": 2.0,
    "max_attempts": 3,
    "max_consecutive_failures": 50,
    "checkpoint_interval": 100,
    "window_end": "2026-01-01",
    "window_days": 180,
    "min_resolution_seconds": 3600,
    "max_resolution_seconds": 14 * 86400,
}

TURN = "struct<index:int,role:string,content:string>"
METADATA = "struct<category:string,priority:string,channel:string,resolution_status:string,created_at:timestamp,resolved_at:timestamp>"
RECORD_DDL = (
    "schema_version string, record_id string, run_id string, record_index int, source_id string, subdomain string, scenario string, "
    f"metadata {METADATA}, turns array<{TURN}>, quality struct<coherence_score:double,rubric_id:string>, generation struct<model_id:string,judge_model_id:string>"
)

_SEMVER = re.compile(r"(\d+)\.(\d+)\.(\d+)")


def parse_semver(text: str) -> tuple[int, int, int]:
    """The three numbers of a strict version; ValueError for anything else."""
    m = _SEMVER.fullmatch(text)
    if not m:
        raise ValueError(f"not a version: {text!r}")
    return tuple(int(x) for x in m.groups())  # type: ignore[return-value]


def is_supported_version(text: str) -> bool:
    """Support is equality with this version, not compatibility."""
    return text == SCHEMA_VERSION


def json_schema() -> dict:
    """The record contract as JSON Schema."""
    text = {"type": "string", "minLength": 1}
    stamp = {"type": "string", "format": "date-time"}

    def obj(**fields: dict) -> dict:
        return {"type": "object", "additionalProperties": False, "properties": fields, "required": sorted(fields)}

    meta = obj(**{d: {"enum": sorted(m)} for d, m in MEMBERS.items()}, created_at=stamp, resolved_at={"anyOf": [stamp, {"type": "null"}]})
    meta["allOf"] = [
        {
            "if": {"properties": {"resolution_status": {"const": "resolved"}}},
            "then": {"properties": {"resolved_at": stamp}},
            "else": {"properties": {"resolved_at": {"type": "null"}}},
        }
    ]
    turn = obj(index={"type": "integer", "minimum": 0}, role={"enum": sorted(ROLES)}, content={"type": "string", "pattern": "\\S"})
    record = obj(
        schema_version={"type": "string", "pattern": r"^\d+\.\d+\.\d+$"},
        record_id=text, run_id=text, record_index={"type": "integer", "minimum": 0}, source_id=text, subdomain=text, scenario=text,
        metadata=meta, turns={"type": "array", "minItems": 2, "items": turn},
        quality=obj(coherence_score={"type": "number", "minimum": 0, "maximum": 1}, rubric_id=text),
        generation=obj(model_id=text, judge_model_id=text),
    )
    # fixed value: the title of the contract
    return {"$schema": "https://json-schema.org/draft/2020-12/schema", "title": "TicketRecord", **record}
