"""Places, running sums, ranks and medians over a whole table.

A window over a table without a partition key is one task.  Here rows are dealt to ranges
of the order, whose bounds Spark samples, and are sorted within each; what a range needs
of those before it is one number.  There are as many of those numbers as partitions, so
the driver may add them up.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.sources import staging

#: Bits of ``monotonically_increasing_id`` that count rows within a partition.
_ROW_BITS = 33


def _in_ranges(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` in sorted ranges, written, with ``_at``, which holds range and place."""
    sorted_ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return staging.staged(sorted_ranges.withColumn("_at", F.monotonically_increasing_id()), name)


def _range_of() -> Column:
    return F.shiftrightunsigned(F.col("_at"), _ROW_BITS)


def _with_sums_before(placed: DataFrame, amount: Column) -> DataFrame:
    """Adds ``_before``: the sum of ``amount`` over all ranges before the row's own."""
    spark = placed.sparkSession
    sums = sorted((r["part"], r["total"]) for r in placed.groupBy(_range_of().alias("part")).agg(F.sum(amount).alias("total")).collect())
    before = [0, *accumulate(total for _, total in sums)]
    table = spark.createDataFrame([(part, before[i]) for i, (part, _) in enumerate(sums)], "_part long, _before long")
    return placed.join(F.broadcast(table), _range_of() == F.col("_part")).drop("_part")


def numbered(df: DataFrame, *order: Column, name: str = "place") -> DataFrame:
    """Adds the place of each row, from 1, in ``order``.

    ``df`` is evaluated twice, to sample and to sort, so it should be a table at rest.
    Many rows equal in ``order`` need a last column that tells them apart, or they are
    one range."""
    placed = _with_sums_before(_in_ranges(df, list(order), "numbered"), F.lit(1))
    within = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.withColumn(name, F.col("_before") + within + 1).drop("_at", "_before")


def running_sums(df: DataFrame, order: list[str], amount: str, name: str = "upto") -> DataFrame:
    """Adds the sum of ``amount`` over all rows up to and with each in ``order``, whose
    columns should tell rows apart."""
    placed = _with_sums_before(_in_ranges(df, [F.col(c) for c in order], "running"), F.col(amount))
    inside = Window.partitionBy(_range_of()).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.withColumn(name, F.col("_before") + F.sum(amount).over(inside)).drop("_at", "_before")


def _counted(df: DataFrame, *columns: str) -> DataFrame:
    return staging.staged(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")), "counted")


def average_ranks(df: DataFrame, value: str) -> DataFrame:
    """``value`` and its rank per different value: equal values share their mean rank.
    Equal values are counted first, so a value of very many rows is one row here."""
    upto = running_sums(_counted(df.select(value), value), [value], "_n")
    return upto.select(value, (F.col("upto") - (F.col("_n") - 1) / 2.0).alias(f"{value}_rank"))


def upper_median(df: DataFrame, value: str, *group: str) -> DataFrame:
    """The value at place n // 2, from 0, of the sorted values that aren't null, per group.

    Groups and values are one order with one running sum, so a group of any size is
    spread over ranges."""
    upto = running_sums(_counted(df.where(F.col(value).isNotNull()).select(*group, value), *group, value), [*group, value], "_n")
    if not group:
        total = upto.agg(F.max("upto").alias("_all")).withColumn("_first", F.lit(0).cast("long"))
        joined = upto.crossJoin(F.broadcast(total))
    else:
        # of each group one row: where its sums begin and how many rows it has
        total = upto.groupBy(*group).agg(F.sum("_n").alias("_all"), (F.max("upto") - F.sum("_n")).alias("_first"))
        named = total.select(*(F.col(g).alias(f"_g_{g}") for g in group), "_all", "_first")
        same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group]
        joined = upto.join(named, same)
    to = F.col("upto") - F.col("_first")
    half = F.floor(F.col("_all") / 2)
    return joined.where((half < to) & (half >= to - F.col("_n"))).select(*group, F.col(value).alias("median"))
