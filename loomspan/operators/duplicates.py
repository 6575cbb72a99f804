"""Exact duplicates: flagged and grouped, never dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_duplicates(df: DataFrame, fingerprint: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(fingerprint).alias("n_unique")).withColumn("duplicates", F.col("n") - F.col("n_unique"))


def flag_duplicates(df: DataFrame, fingerprint: str, order: str) -> DataFrame:
    """Adds ``is_duplicate``: whether a row with the fingerprint comes before.

    The first rows are aggregated, not ranked, so a fingerprint of many rows is
    combined before the shuffle."""
    firsts = df.groupBy(fingerprint).agg(F.min(order).alias("_first")).withColumnRenamed(fingerprint, "_fp")
    return df.join(firsts, F.col(fingerprint).eqNullSafe(F.col("_fp"))).withColumn("is_duplicate", F.col(order) > F.col("_first")).drop("_fp", "_first")


def duplicate_groups(df: DataFrame, fingerprint: str, order: str) -> DataFrame:
    """Fingerprints of several rows: how many, and which row is kept (the first)."""
    return df.groupBy(fingerprint).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("kept")).where("n > 1")


def duplicate_ids(df: DataFrame, id_col: str) -> DataFrame:
    return df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
