"""Monitors over a stream of attempts: running tallies, circuit breaker, duplicates.

Order is that of an explicit sequence column, as a distributed stream has no
completion order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def tallies(attempts: DataFrame) -> DataFrame:
    """Attempts per reason so far; accepted ones have a null reason."""
    return attempts.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def circuit_breaker(attempts: DataFrame, limit: int, key: str = "slot") -> DataFrame:
    """Per key and batch: consecutive failures at its end, the longest run so far, and
    whether the limit was reached.  State is three numbers per key."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, longest, reached = state.get if state.exists else (0, 0, False)
        rows = pd.concat(list(batches)).sort_values("seq")
        for failed in rows["failed"]:
            now = now + 1 if failed else 0
            longest = max(longest, now)
            reached = reached or now >= limit
        state.update((int(now), int(longest), bool(reached)))
        yield pd.DataFrame({"key": [k[0]], "failures": [now], "longest": [longest], "reached": [reached]})

    shaped = attempts.select(F.col(key).cast("long").alias("key"), "seq", F.col("reason").isNotNull().alias("failed"))
    return shaped.groupBy("key").applyInPandasWithState(step, "key long, failures long, longest long, reached boolean", "now long, longest long, reached boolean", "update", GroupStateTimeout.NoTimeout)


def flag_repeats(rows: DataFrame, fingerprint: str = "fp") -> DataFrame:
    """Rows with whether their fingerprint came before, in sequence within a batch;
    no row is dropped.  State is one flag per fingerprint."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("seq")
        seen = state.exists
        state.update((True,))
        rows["is_duplicate"] = [seen or i > 0 for i in range(len(rows))]
        yield rows[["seq", "fp", "is_duplicate"]]

    shaped = rows.select("seq", F.col(fingerprint).alias("fp"))
    return shaped.groupBy("fp").applyInPandasWithState(step, "seq long, fp string, is_duplicate boolean", "seen boolean", "append", GroupStateTimeout.NoTimeout)


def watch(attempts: DataFrame, checkpoint: str, on_tally: Callable[[dict, int], None]) -> StreamingQuery:
    """Starts a query that hands the running tallies to ``on_tally`` after each batch;
    the checkpoint folder resumes it."""

    def each(batch: DataFrame, number: int) -> None:
        on_tally({r["reason"]: r["n"] for r in batch.collect()}, number)

    return tallies(attempts).writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(each).start()
