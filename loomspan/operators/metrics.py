"""Counters of a run: discards, rates, histograms, retries, running monitors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.operators.ranking import upper_median

BUCKET = 0.05


def discards(attempts: DataFrame) -> DataFrame:
    """Attempts per reason; each discarded attempt counts once."""
    return attempts.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def rates(attempts: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Per limited reason its count, all attempts (the only denominator), the rate
    and whether it is over the limit, strictly; nothing is over without attempts."""
    one = attempts.agg(F.count(F.lit(1)).alias("generated"), *(F.count_if(F.col("reason") == r).alias(f"n{i}") for i, r in enumerate(limits)))
    rows = F.array(*(F.struct(F.lit(r).alias("reason"), F.col(f"n{i}").alias("n"), F.lit(float(x)).alias("limit")) for i, (r, x) in enumerate(limits.items())))
    out = one.select("generated", F.explode(rows).alias("r")).select("r.reason", "r.n", "generated", "r.limit")
    rate = F.when(F.col("generated") > 0, F.col("n") / F.col("generated")).otherwise(0.0)
    return out.withColumn("rate", rate).withColumn("over", F.col("rate") > F.col("limit"))


def minimum_sample(n: int) -> int:
    """Attempts before a rate may stop a run of ``n`` records."""
    return max(1000, int(0.05 * n))


def histogram(scores: DataFrame, score: str = "score", bucket: float = BUCKET) -> DataFrame:
    last = round(1 / bucket) - 1
    i = F.least(F.floor(F.col(score) / F.lit(bucket)).cast("int"), F.lit(last))
    counted = scores.where(F.col(score).isNotNull()).groupBy(i.alias("i")).agg(F.count(F.lit(1)).alias("n"))
    lo = F.col("i") * F.lit(bucket)
    return counted.select(F.format_string("%.2f-%.2f", lo, lo + F.lit(bucket)).alias("bucket"), "n")


def summary(scores: DataFrame, score: str = "score") -> DataFrame:
    """Count, different values to four places, least, largest, mean, upper median."""
    agg = scores.agg(F.count(score).alias("n"), F.count_distinct(F.round(score, 4)).alias("n_distinct"), F.min(score).alias("least"), F.max(score).alias("largest"), F.avg(score).alias("mean"))
    return agg.join(upper_median(scores, score), how="left")


def first_accepted(attempts: DataFrame, max_attempts: int) -> DataFrame:
    """Per slot the number of the first accepted attempt, null if there is none in time."""
    ok = (F.col("attempt") <= max_attempts) & F.col("reason").isNull()
    return attempts.groupBy("slot").agg(F.min(F.when(ok, F.col("attempt"))).alias("accepted"), F.count_if(F.col("attempt") <= max_attempts).alias("tried"))


def failure_runs(attempts: DataFrame, key: str, order: str, failed) -> DataFrame:
    """Consecutive failures up to each row, per key: failures since the last success."""
    by = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = attempts.withColumn("failed", failed).withColumn("_g", F.sum(F.when(failed, 0).otherwise(1)).over(by))
    inside = Window.partitionBy(key, "_g").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return d.withColumn("failures", F.sum(F.col("failed").cast("long")).over(inside)).drop("_g")


def running_breach(attempts: DataFrame, key: str, order: str, reason: str, limit: float, least: int) -> DataFrame:
    """Per key the first row, in order, at which the rate of a reason over all rows so
    far is over the limit, with at least ``least`` rows."""
    by = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = attempts.withColumn("seen", F.count(F.lit(1)).over(by)).withColumn("hits", F.count_if(F.col("reason").eqNullSafe(reason)).over(by))
    d = d.where((F.col("seen") >= least) & (F.col("hits") / F.col("seen") > F.lit(limit)))
    return d.groupBy(key).agg(F.min(order).alias("first_over"))


def fallbacks(records: DataFrame, configured: str) -> DataFrame:
    """Accepted records that another model than the configured one served, by model."""
    return records.where(F.col("model_id") != configured).groupBy("model_id").agg(F.count(F.lit(1)).alias("n"))


def contiguous_prefix(written: DataFrame, position: str, *group: str) -> DataFrame:
    """Where a run would resume: one past the written positions that follow each other
    from 0, which is the least position whose successor is missing, plus one."""
    w = written.select(*group, position).distinct()
    nxt = w.select(*(F.col(g).alias(f"_{g}") for g in group), (F.col(position) - 1).alias("_p"))
    cond = (F.col(position) == F.col("_p"))
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_{g}"))
    ends = w.join(nxt, cond, "left_anti").groupBy(*group).agg(F.min(position).alias("_end"), F.lit(1).alias("_one"))
    zero = w.where(F.col(position) == 0).select(*(F.col(g).alias(f"_{g}") for g in group), F.lit(True).alias("_zero"))
    out = ends.join(zero, [ends[g].eqNullSafe(zero[f"_{g}"]) for g in group] or F.lit(True), "left")
    return out.select(*group, F.when(F.col("_zero"), F.col("_end") + 1).otherwise(0).cast("long").alias("next_position"))


def request_spacing(requests: DataFrame, key: str, at: str, least_seconds: float) -> DataFrame:
    """Per key the number of requests, and of those that followed the one before sooner
    than they should."""
    gap = F.unix_micros(F.col(at).cast("timestamp")) - F.lag(F.unix_micros(F.col(at).cast("timestamp"))).over(Window.partitionBy(key).orderBy(at))
    return requests.select(key, gap.alias("gap")).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("gap") < least_seconds * 1_000_000).alias("too_soon"))


def progress(written: int, wanted: int, seconds: float) -> dict:
    """Rate per minute and the time left, which is told from three records on."""
    rate = 60 * written / seconds if seconds > 0 else None
    left = (wanted - written) * seconds / written if written >= 3 and seconds > 0 else None
    return {"written": written, "wanted": wanted, "per_minute": rate, "seconds_left": left}
