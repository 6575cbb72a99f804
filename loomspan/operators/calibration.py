"""Agreement of a judge with people over a scored sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.operators.metrics import summary
from loomspan.operators.ranking import average_ranks


def gate_agreement(df: DataFrame, threshold: float, judge: str = "judge", human: str = "human") -> DataFrame:
    j, h = F.col(judge) >= threshold, F.col(human) >= threshold
    out = df.agg(F.count_if(j == h).alias("agreed"), F.count_if(j & ~h).alias("lenient"), F.count_if(~j & h).alias("strict"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("rate", F.when(F.col("n") > 0, F.col("agreed") / F.col("n")).otherwise(0.0))


def spearman(df: DataFrame, judge: str = "judge", human: str = "human") -> DataFrame:
    """Rank correlation with average ranks; null for fewer than three rows or a
    side of one value.  Ranks are made per different value, then joined."""
    ranked = df.select(judge, human).join(average_ranks(df, judge), judge).join(average_ranks(df, human), human)
    x, y = f"{judge}_rank", f"{human}_rank"
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    stats = ranked.agg(F.count(F.lit(1)).alias("n"), (F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))).alias("r"), F.count_distinct(x).alias("dx"), F.count_distinct(y).alias("dy"))
    return stats.select("n", F.when((F.col("n") >= 3) & (F.col("dx") > 1) & (F.col("dy") > 1), F.col("r")).alias("rho"))


def criterion_gap(df: DataFrame, judge: str = "judge_criteria", human: str = "human_criteria") -> DataFrame:
    """Mean signed difference per criterion that both sides scored, to four places."""
    both = df.select(F.explode(human).alias("criterion", "h"), F.col(judge).alias("j"))
    both = both.select("criterion", "h", F.try_element_at("j", "criterion").alias("jv")).where("jv is not null and h is not null")
    return both.groupBy("criterion").agg(F.round(F.avg(F.col("jv") - F.col("h")), 4).alias("gap"))


def calibrate(df: DataFrame, threshold: float) -> dict:
    """All of it as one document, from a few small aggregations."""
    if df.isEmpty():
        raise ValueError("no scored records")
    row = lambda d: d.first().asDict()
    return {
        "judge": row(summary(df, "judge")),
        "human": row(summary(df, "human")),
        "agreement": row(gate_agreement(df, threshold)),
        "rank_correlation": spearman(df).first()["rho"],
        "criterion_gap": {r["criterion"]: r["gap"] for r in criterion_gap(df).orderBy("criterion").collect()},
        "threshold": threshold,
    }


def assert_rubric(df: DataFrame, rubric_id: str) -> None:
    """An error if a record names another rubric; blanks are ignored."""
    other = df.where((F.col("rubric_id") != "") & (F.col("rubric_id") != rubric_id)).select("rubric_id").distinct().limit(5).collect()
    if other:
        raise ValueError(f"sample was scored with {sorted(r['rubric_id'] for r in other)}, not {rubric_id!r}")
