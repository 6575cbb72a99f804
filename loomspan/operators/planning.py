"""Slots: which record has which members, times and length, decided before any is made."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomspan.functions.text import keyed_hash
from loomspan.operators.composition import apportion

#: Pool items that one row spreads into, and positions dealt in one task.
SPAN = 50_000
POSITIONS_PER_TASK = 200_000
#: Rows that a hash range should hold.
RANGE_ROWS = 50_000


def ranked(df: DataFrame, group: str, key: str, *ties: str, size: int = 0) -> DataFrame:
    """Adds ``place``: the 0-based rank by ``key`` (a 60-bit hash) within ``group``,
    counted over hash ranges first and within one range second.  Told the ``size`` of a
    group, it makes so many ranges and tasks that one holds about ``RANGE_ROWS`` of each."""
    bits = max(6, (size // RANGE_ROWS).bit_length())
    d = df.withColumn("_b", F.shiftright(F.col(key), 60 - bits))
    sizes = d.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = F.row_number().over(Window.partitionBy(group, "_b").orderBy(key, *ties))
    if size:
        d = d.repartition(-(-size // RANGE_ROWS), group, "_b")
    return d.withColumn("_r", inside).join(offsets, [group, "_b"]).withColumn("place", F.col("_o") + F.col("_r") - 1).drop("_b", "_r", "_o")


def pool_items(counts: DataFrame, n: int) -> DataFrame:
    """``dimension, member, item``: each member's stretch of the items 0 to n - 1.  The
    pool is as large as the corpus, so a member's items are made a span at a time, in
    many tasks."""
    before = Window.partitionBy("dimension").orderBy("member").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0))).where("n > 0").withColumn("end", F.col("at") + F.col("n") - 1)
    cut = spans.select("dimension", "member", "end", F.explode(F.sequence("at", "end", F.lit(SPAN).cast("long"))).alias("start"))
    dealt = cut.repartition(max(1, -(-n // POSITIONS_PER_TASK)))
    return dealt.select("dimension", "member", F.explode(F.sequence("start", F.least(F.col("start") + SPAN - 1, F.col("end")))).alias("item"))


def pool_assignment(comp: DataFrame, n: int, seed: int) -> DataFrame:
    """``dimension, position, member``: each member as often as apportioned, dealt to
    the positions in a shuffled order of its own for each dimension."""
    keyed = pool_items(apportion(comp, n), n).withColumn("key", keyed_hash(seed, "pool", F.col("dimension"), F.col("item")))
    return ranked(keyed, "dimension", "key", "item", size=n).select("dimension", F.col("place").cast("long").alias("position"), "member")


def draws(n: int, seed: int, settings: dict, subdomains: list[str], spark: SparkSession) -> DataFrame:
    """Per position: subdomain, turn count, and creation time, each from a stream of its own."""
    lo, hi, days = settings["min_turns"], settings["max_turns"], settings["window_days"]
    pos = spark.range(n).select(F.col("id").alias("position"))
    draw = lambda stream, m: F.pmod(keyed_hash(seed, F.col("position"), stream), F.lit(m))
    names = F.array(*map(F.lit, sorted(subdomains)))
    end = F.unix_timestamp(F.lit(settings["window_end"]).cast("date").cast("timestamp"))
    start = end - days * 86400
    return pos.select(
        "position",
        F.get(names, draw("subdomain", len(subdomains)).cast("int")).alias("subdomain"),
        (draw("turns", hi - lo + 1) + lo).cast("int").alias("turn_count"),
        (start + draw("created", max(days * 86400, 1))).alias("created_s"),
        (draw("resolution", settings["max_resolution_seconds"] - settings["min_resolution_seconds"] + 1) + settings["min_resolution_seconds"]).alias("resolution_s"),
    )


def slots(comp: DataFrame, n: int, seed: int, settings: dict, subdomains: list[str]) -> DataFrame:
    """The whole plan: a row per position."""
    dealt = pool_assignment(comp, n, seed).groupBy("position").pivot("dimension", ["category", "priority", "channel", "resolution_status"]).agg(F.first("member"))
    drawn = draws(n, seed, settings, subdomains, comp.sparkSession)
    resolved = F.when(F.col("resolution_status") == "resolved", F.col("created_s") + F.col("resolution_s"))
    return dealt.join(drawn, "position").select(
        "position", "category", "priority", "channel", "resolution_status", "turn_count", "subdomain",
        F.timestamp_seconds("created_s").alias("created_at"), F.timestamp_seconds(resolved).alias("resolved_at"),
    )


def seeded_sample(df: DataFrame, n: int, seed: int, id_col: str) -> DataFrame:
    """``n`` rows, the same for a seed in any partitioning: those with the smallest
    keyed hash, found by a top-n rather than a sort."""
    return df.orderBy(keyed_hash(seed, "sample", F.col(id_col)), id_col).limit(n)
