"""Monitors of a whole run: consecutive failures, and the rate of a reason, in order.

Both could be windows over one key, which is one task.  Instead each range of the order
gives a summary of a few numbers, and summaries of ranges that follow each other merge
into that of both.  Merging is associative, so a stream keeps one summary as its state
and merges each batch's into it.  A breach is then looked for only in the range that
the summaries say it is in.

Rows are taken in the order of one column without equal values.  Rates are compared
exactly: with a limit of p/q, hits of n rows are over it if q * hits - p * n is above 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Summary:
    """Of rows that follow each other, with the places of the first and the last: the
    failures at the beginning, at the end and in the first longest run, where those end or
    begin, the sum of q * hit - p, and that sum's largest prefix."""

    n: int = 0
    lo: int | None = None
    hi: int | None = None
    prefix: int = 0
    prefix_hi: int | None = None
    suffix: int = 0
    suffix_lo: int | None = None
    longest: int = 0
    longest_lo: int | None = None
    longest_hi: int | None = None
    total: int = 0
    best: int | None = None

    def merge(self, b: Summary) -> Summary:
        a = self
        if not a.n or not b.n:
            return b if not a.n else a
        across = (a.suffix + b.prefix, a.suffix_lo if a.suffix else b.lo, b.prefix_hi if b.prefix else a.hi)
        longest = max((a.longest, a.longest_lo, a.longest_hi), across, (b.longest, b.longest_lo, b.longest_hi), key=lambda x: x[0])
        whole_a, whole_b = a.prefix == a.n, b.suffix == b.n
        return Summary(
            a.n + b.n,
            a.lo,
            b.hi,
            a.n + b.prefix if whole_a else a.prefix,
            b.prefix_hi if whole_a and b.prefix else a.prefix_hi,
            b.n + a.suffix if whole_b else b.suffix,
            a.suffix_lo if whole_b and a.suffix else b.suffix_lo,
            *(longest if longest[0] else (0, None, None)),
            a.total + b.total,
            max(a.best, a.total + b.best),
        )

    def as_dict(self) -> dict:
        return asdict(self)


def fraction(limit: float) -> Fraction:
    """The limit as it is written, not as it is rounded."""
    return Fraction(str(limit))


def of_rows(seq: np.ndarray, failed: np.ndarray, hit: np.ndarray, limit: Fraction) -> Summary:
    """The summary of rows in order."""
    n = len(seq)
    if not n:
        return Summary()
    edge = np.concatenate([[-1], np.flatnonzero(~failed), [n]])
    runs = np.diff(edge) - 1
    place = lambda i, there: int(seq[i]) if there else None
    k = int(np.argmax(runs))
    prefix, suffix, longest = int(runs[0]), int(runs[-1]), int(runs[k])
    sums = np.cumsum(hit.astype(np.int64) * limit.denominator - limit.numerator)
    return Summary(
        n, int(seq[0]), int(seq[-1]), prefix, place(prefix - 1, prefix), suffix, place(n - suffix if suffix else 0, suffix),
        longest, place(edge[k] + 1 if longest else 0, longest), place(edge[k + 1] - 1, longest), int(sums[-1]), int(sums.max()),
    )


_BLOCK = ", ".join(f"{f} long" for f in Summary.__dataclass_fields__)


def _columns(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    seqs, fails, hits = [np.zeros(0, np.int64)], [np.zeros(0, bool)], [np.zeros(0, bool)]
    for b in batches:
        seqs.append(b.column(0).to_numpy())
        fails.append(b.column(1).to_numpy(zero_copy_only=False))
        hits.append(b.column(2).to_numpy(zero_copy_only=False))
    return np.concatenate(seqs), np.concatenate(fails), np.concatenate(hits)


def _summarise(limit: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = reduce(Summary.merge, (of_rows(*_columns(iter([b])), limit) for b in batches), Summary())
        if whole.n:
            yield pa.RecordBatch.from_pylist([whole.as_dict()], pa.schema([(f, pa.int64()) for f in whole.as_dict()]))

    return run


@dataclass(frozen=True)
class Run:
    """A run's rows in order and what is watched: failures in a row, and the rate of hits."""

    rows: DataFrame
    order: str
    failed: Column
    hit: Column
    limit: float = 1.0

    def _shaped(self) -> DataFrame:
        no = F.lit(False)
        return self.rows.select(F.col(self.order).cast("long").alias("seq"), F.coalesce(self.failed, no).alias("failed"), F.coalesce(self.hit, no).alias("hit"))

    def blocks(self) -> list[Summary]:
        """The summary of each range, in order; there are as many as partitions."""
        ranges = self._shaped().repartitionByRange("seq").sortWithinPartitions("seq")
        found = ranges.mapInArrow(_summarise(fraction(self.limit)), _BLOCK).collect()
        return [Summary(**r.asDict()) for r in sorted(found, key=lambda r: r["lo"])]

    def summary(self) -> Summary:
        return reduce(Summary.merge, self.blocks(), Summary())

    def _range(self, s: Summary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows of one range in order: what one task had sorted before."""
        rows = self._shaped().where(F.col("seq").between(s.lo, s.hi)).coalesce(1).sortWithinPartitions("seq")
        return _columns(iter(rows.toArrow().to_batches()))

    def longest_failure(self) -> DataFrame:
        """``longest, first_seq, last_seq``: the longest run of failures, the first of
        several, and where it begins and ends; both null without failures."""
        s = self.summary()
        return self.rows.sparkSession.createDataFrame([(s.longest, s.longest_lo, s.longest_hi)], "longest long, first_seq long, last_seq long")

    def first_failures(self, limit: int) -> int | None:
        """The place at which failures in a row first are ``limit``."""
        before = Summary()
        for s in self.blocks():
            if max(s.longest, before.suffix + s.prefix) >= limit:
                seq, failed, _ = self._range(s)
                return int(seq[_in_a_row(failed, before.suffix) >= limit][0])
            before = before.merge(s)
        return None

    def first_breach(self, least: int) -> dict | None:
        """Place, rows and hits so far, and rate, where the rate of hits first is over
        the limit with at least ``least`` rows."""
        before, limit = Summary(), fraction(self.limit)
        for s in self.blocks():
            if before.n + s.n >= least and before.total + s.best > 0:
                seq, _, hit = self._range(s)
                sums = before.total + np.cumsum(hit.astype(np.int64) * limit.denominator - limit.numerator)
                rows = before.n + np.arange(1, len(seq) + 1)
                over = np.flatnonzero((sums > 0) & (rows >= least))
                if len(over):
                    i = int(over[0])
                    hits = (int(sums[i]) + limit.numerator * int(rows[i])) // limit.denominator
                    return {"seq": int(seq[i]), "seen": int(rows[i]), "hits": hits, "rate": hits / int(rows[i])}
            before = before.merge(s)
        return None


def _in_a_row(failed: np.ndarray, before: int) -> np.ndarray:
    """Failures up to each row since the last success; ``before`` were open at first."""
    at = np.arange(len(failed))
    last_good = np.maximum.accumulate(np.where(failed, -1, at))
    return np.where(failed, np.where(last_good < 0, at + 1 + before, at - last_good), 0)


def stop_reason(s: Summary, most_failures: int, least: int) -> str | None:
    """Why a run that has come to ``s`` must stop, if it must."""
    if s.longest >= most_failures:
        return "consecutive_failures"
    return "discard_rate" if s.n >= least and s.total > 0 else None
