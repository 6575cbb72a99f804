"""Duplicates over a stream, with state that expires and can begin from an older corpus.

State is one number for each fingerprint: the place of its first row.  It is kept in the
state store and dropped once ``keep`` has passed since it was made; without ``keep`` it
stays.  Rows of a fingerprint within a batch are looked at as they come, holding one.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUT = "seq long, fp string, is_duplicate boolean"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstSeen(StatefulProcessor):
    def __init__(self, keep: timedelta | None):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = None if self.keep is None else int(self.keep.total_seconds() * 1000)
        self.first = handle.getValueState("first", "seq long", ttl)

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues) -> None:
        self.first.update((int(initialState["seq"].min()),))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen, held = self.first.exists(), None
        for batch in rows:
            seqs = batch["seq"].to_numpy()
            least = int(seqs.min())
            flags = pd.Series(True, index=batch.index)
            if not seen and (held is None or least < held):
                # the least so far is held back; the one held before has an earlier row
                at = int(seqs.argmin())
                if held is not None:
                    yield pd.DataFrame({"seq": [held], "fp": [key[0]], "is_duplicate": [True]})
                held = least
                batch, flags = batch.drop(batch.index[at]), flags.drop(batch.index[at])
            yield pd.DataFrame({"seq": batch["seq"], "fp": key[0], "is_duplicate": flags})
        if held is not None:
            self.first.update((held,))
            yield pd.DataFrame({"seq": [held], "fp": [key[0]], "is_duplicate": [False]})

    def close(self) -> None:
        pass


def use_rocks(spark: SparkSession) -> None:
    """The state store that this needs, for queries started from now on; a query that is
    taken up keeps the one that its checkpoint names."""
    if spark.conf.get(PROVIDER) != ROCKS:
        spark.conf.set(PROVIDER, ROCKS)


def flag_repeats(rows: DataFrame, fingerprint: str, order: str, keep: timedelta | None = None, older: DataFrame | None = None) -> DataFrame:
    """``seq, fp, is_duplicate`` of a stream: whether a fingerprint came before, in an
    earlier batch, earlier in ``order`` within the batch, or in ``older``, a table of
    ``seq, fp``.  No row is dropped; a null fingerprint is one of its own."""
    use_rocks(rows.sparkSession)
    shaped = rows.select(F.col(order).cast("long").alias("seq"), F.col(fingerprint).cast("string").alias("fp"))
    begin = older.select(F.col("seq").cast("long").alias("seq"), "fp").groupBy("fp") if older is not None else None
    mode = "none" if keep is None else "processingTime"
    return shaped.groupBy("fp").transformWithStateInPandas(FirstSeen(keep), OUT, "append", mode, begin)
