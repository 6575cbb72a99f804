"""Views of the driver's tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticket_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tickets: four dimensions, one row per order."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    status = F.when(F.col("o_orderstatus") == "F", "resolved").when(F.col("o_orderstatus") == "O", "unresolved").otherwise("escalated")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        "o_orderkey", F.col("c_mktsegment").alias("category"), F.col("o_orderpriority").alias("priority"), (F.col("o_orderkey") % 4).cast("string").alias("channel"), status.alias("resolution_status")
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with the contract's roles; others stay as they are, as violations."""
    role = F.when(F.col("role") == "user", "customer").when(F.col("role") == "assistant", "agent").otherwise(F.col("role"))
    return table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("turn"), role.alias("role"), "text")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = turns(spark, sf_dir).select("conv_id", F.struct(F.col("turn").alias("index"), "role", F.col("text").alias("content")).alias("t"))
    return t.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as scored records, judge and human in [0, 1], two criteria each."""
    li = table(spark, sf_dir, "lineitem")
    judge, human = F.col("l_discount") * 10, F.col("l_tax") * 12.5
    return li.select(
        "l_orderkey", "l_linenumber", judge.alias("judge"), human.alias("human"),
        F.create_map(F.lit("single_issue"), judge, F.lit("metadata_fit"), F.col("l_quantity") / 50).alias("judge_criteria"),
        F.create_map(F.lit("single_issue"), human, F.lit("metadata_fit"), judge).alias("human_criteria"),
    )


def reason() -> Column:
    """Why an event, taken as an attempt, was rejected; null if it was not."""
    return F.when(F.col("event_type") == "error", "structural_invalid").when(F.col("event_type") == "signup", "privacy_finding")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts at slots: a slot per user, numbered by event."""
    e = table(spark, sf_dir, "events")
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    return e.select("event_id", F.col("user_id").alias("slot"), n.alias("attempt"), reason().alias("reason"), F.col("event_type").alias("model_id"), reason().isNull().alias("accepted"))
