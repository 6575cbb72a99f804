"""Composition shares, drift against what was asked for, and apportionment."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan import schema

SUM_SLACK = 1e-6


def requested(spark: SparkSession, composition: dict[str, dict[str, float]]) -> DataFrame:
    """``dimension, member, proportion`` of a composition."""
    rows = [(d, m, float(p)) for d, members in composition.items() for m, p in members.items()]
    return spark.createDataFrame(rows, "dimension string, member string, proportion double")


def shares(df: DataFrame, dimensions: tuple[str, ...] = schema.DIMENSIONS) -> DataFrame:
    """Achieved share of each member of each dimension; no rows give no members."""
    pairs = ", ".join(f"'{d}', cast({d} as string)" for d in dimensions)
    long = df.selectExpr(f"stack({len(dimensions)}, {pairs}) as (dimension, member)")
    counted = long.groupBy("dimension", "member").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("dimension"))
    return counted.select("dimension", "member", "n", (F.col("n") / total).alias("share"))


def shares_by_grouping_sets(df: DataFrame, dimensions: tuple[str, ...] = schema.DIMENSIONS) -> DataFrame:
    """The same from one aggregation with grouping sets."""
    grouped = df.groupingSets([[F.col(d)] for d in dimensions], *map(F.col, dimensions)).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    full = (1 << len(dimensions)) - 1
    which = F.coalesce(*(F.when(F.col("g") == (full ^ (1 << (len(dimensions) - 1 - i))), F.lit(d)) for i, d in enumerate(dimensions)))
    member = F.coalesce(*(F.when(which == d, F.col(d).cast("string")) for d in dimensions))
    return grouped.select(which.alias("dimension"), member.alias("member"), "n")


def drift(want: DataFrame, have: DataFrame) -> DataFrame:
    """Requested and achieved share of every member that either side has."""
    joined = want.select("dimension", "member", F.col("proportion").alias("requested")).join(have.select("dimension", "member", F.col("share").alias("achieved")), ["dimension", "member"], "full_outer")
    r, a = F.coalesce("requested", F.lit(0.0)), F.coalesce("achieved", F.lit(0.0))
    return joined.select("dimension", "member", r.alias("requested"), a.alias("achieved"), (F.abs(a - r) * 100).alias("drift_pp"))


def breaches(drifted: DataFrame, tolerance_pp: float) -> DataFrame:
    """Members further from what was asked for than the tolerance, strictly."""
    return drifted.where(F.abs(F.col("achieved") - F.col("requested")) > F.lit(tolerance_pp / 100))


def worst_member(drifted: DataFrame) -> DataFrame:
    """The member that drifted most; of equals the first by name."""
    return drifted.orderBy(F.desc("drift_pp"), "dimension", "member").limit(1)


def attribute(want: DataFrame, assigned: DataFrame, achieved: DataFrame) -> DataFrame:
    """Drift due to apportioning (assigned against requested) and due to the run
    (achieved against assigned), in percentage points."""
    j = want.select("dimension", "member", F.col("proportion").alias("w"))
    j = j.join(assigned.select("dimension", "member", F.col("share").alias("s")), ["dimension", "member"], "full_outer")
    j = j.join(achieved.select("dimension", "member", F.col("share").alias("h")), ["dimension", "member"], "full_outer")
    w, s, h = (F.coalesce(c, F.lit(0.0)) for c in "wsh")
    return j.select("dimension", "member", F.round((s - w) * 100, 4).alias("apportionment_pp"), F.round((h - s) * 100, 4).alias("run_pp"))


def problems(comp: DataFrame, members: DataFrame) -> DataFrame:
    """``dimension, member, problem``: unknown members and sums other than one."""
    unknown = comp.join(members, ["dimension", "member"], "left_anti").select("dimension", "member", F.lit("unknown member").alias("problem"))
    sums = comp.groupBy("dimension").agg(F.sum("proportion").alias("total")).where(F.abs(F.col("total") - 1) > SUM_SLACK)
    return unknown.unionByName(sums.select("dimension", F.lit(None).cast("string").alias("member"), F.lit("shares do not sum to 1").alias("problem")))


def minimum_records(tolerance_pp: float) -> int:
    return max(1, math.ceil(100 / tolerance_pp))


def unachievable(comp: DataFrame, n: int, tolerance_pp: float) -> DataFrame:
    """Members for which ``n`` records are too few, with the reason."""
    p = F.col("proportion")
    reason = F.when((p * n > 0) & (p * n < 1), F.lit("less than one record")).when(F.lit(tolerance_pp < 100 / n), F.lit("tolerance finer than one record"))
    return comp.withColumn("problem", reason).where("problem is not null").select("dimension", "member", "problem")


def apportion(comp: DataFrame, n: int) -> DataFrame:
    """Whole counts by largest remainder: floors, then one more for the largest
    remainders, equals by member name.  The window is over members, not records."""
    exact = F.col("proportion") * n
    base = comp.withColumn("floor", F.floor(exact).cast("long")).withColumn("remainder", exact - F.floor(exact))
    by = Window.partitionBy("dimension")
    place = F.row_number().over(by.orderBy(F.desc("remainder"), "member"))
    return base.withColumn("short", n - F.sum("floor").over(by)).withColumn("place", place).select("dimension", "member", (F.col("floor") + (F.col("place") <= F.col("short")).cast("long")).alias("n"))
