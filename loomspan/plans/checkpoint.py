"""Checkpoints of a run, and taking it up again.

A checkpoint names the first position that is not written yet.  The staged corpus may
hold more than that, from work cut short: it is cut back to the prefix before going on."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.sources import corpus

# The keys of a checkpoint.
KEYS = ("run_id", "next_position", "bytes_written", "input_fingerprints", "discards", "retry_counts", "duplicate_count", "records_generated", "records_written", "resumes", "segments")
NAME = "checkpoint.json"


class CheckpointError(RuntimeError):
    """A checkpoint that can't be read, or that fits no run to take up."""


def save(state: dict, folder: str) -> None:
    missing = [k for k in KEYS if k not in state]
    if missing:
        raise CheckpointError(f"a checkpoint lacks {', '.join(missing)}")
    corpus.write_json({k: state[k] for k in KEYS}, os.path.join(folder, NAME))


def load(folder: str) -> dict:
    try:
        state = json.loads(Path(folder, NAME).read_text())
        if not isinstance(state, dict) or any(k not in state for k in KEYS):
            raise ValueError("keys are missing")
    except (OSError, ValueError) as e:
        raise CheckpointError(f"no checkpoint can be read in {folder}: {e}") from e
    return state


def due(responses: int, at_last: int, interval: int) -> bool:
    """Whether so many responses came since the last checkpoint that another is due."""
    return responses - at_last >= interval


def resumable(folder: str, run_id: str | None = None) -> str:
    """The staged run to take up: the one named, or the only one there is."""
    found = sorted(d for d in os.listdir(folder) if os.path.isfile(os.path.join(folder, d, NAME))) if os.path.isdir(folder) else []
    if run_id is not None:
        found = [d for d in found if d == run_id]
    if len(found) != 1:
        raise CheckpointError("no run can be taken up" if not found else f"several runs could be taken up: {', '.join(found)}")
    return found[0]


def changed(state: dict, now: dict[str, str]) -> list[str]:
    """Names of inputs that differ from those of the checkpoint; a run goes on only with none."""
    old = state["input_fingerprints"]
    return sorted(k for k in old.keys() | now.keys() if old.get(k) != now.get(k))


def prefix(records: DataFrame, next_position: int, position: str = "record_index") -> DataFrame:
    """What was written for certain: rows before the checkpoint's position."""
    return records.where(F.col(position) < next_position)


def remaining(slots: DataFrame, next_position: int) -> DataFrame:
    """Slots that a run that is taken up still has to fill."""
    return slots.where(F.col("position") >= next_position)


def taken_up(state: dict, segment: dict) -> dict:
    """The state of the run that goes on: tallies are kept, its segment is added."""
    return state | {"resumes": state["resumes"] + 1, "segments": [*state["segments"], segment]}
