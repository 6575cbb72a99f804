"""Progress of streams: a listener that keeps rate and time left from Spark's own events."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime

from pyspark.sql.streaming.listener import QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener

from loomspan.functions.text import duration
from loomspan.operators.metrics import progress


def _seconds(stamp: str) -> float:
    return datetime.fromisoformat(stamp.replace("Z", "+00:00")).timestamp()


class ProgressListener(StreamingQueryListener):
    """Rows taken in by each query, against how many are ``wanted``.

    Register with ``spark.streams.addListener``.  ``on_progress`` is called with each new
    state; an error it raises is kept in ``errors`` and stops nothing."""

    def __init__(self, wanted: int, on_progress: Callable[[dict], None] | None = None):
        self.wanted, self.on_progress = wanted, on_progress
        self.errors: list[Exception] = []
        self._lock = threading.Lock()
        self._began: dict[str, float] = {}
        self._rows: dict[str, dict[int, int]] = {}
        self._ended: dict[str, str | None] = {}

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        with self._lock:
            self._began.setdefault(str(event.id), _seconds(event.timestamp))

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        with self._lock:
            # by batch, as a batch that is run again after a restart tells of itself again
            self._rows.setdefault(str(p.id), {})[p.batchId] = p.numInputRows
            began = self._began.setdefault(str(p.id), _seconds(p.timestamp))
            took = sum(p.durationMs.get(k, 0) for k in ("triggerExecution",)) / 1000
            state = self._state(str(p.id), _seconds(p.timestamp) + took - began)
        if self.on_progress is not None:
            try:
                self.on_progress(state)
            except Exception as e:
                self.errors.append(e)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        with self._lock:
            self._ended[str(event.id)] = event.exception

    def _state(self, query: str, seconds: float) -> dict:
        return progress(sum(self._rows.get(query, {}).values()), self.wanted, seconds) | {"query": query, "seconds": seconds}

    def rows(self, query: str) -> int:
        """Rows that a query has taken in so far."""
        with self._lock:
            return sum(self._rows.get(query, {}).values())

    def ended(self, query: str) -> bool:
        with self._lock:
            return query in self._ended


def line(state: dict) -> str:
    """One line: done of wanted, time, rate, and time left once it can be told."""
    parts = [f"{state['written']}/{state['wanted']}", duration(state["seconds"])]
    if state["per_minute"] is not None:
        parts.append(f"{state['per_minute']:.1f}/min")
    if state["seconds_left"] is not None:
        parts.append(f"{duration(max(state['seconds_left'], 0))} left")
    return ", ".join(parts)
