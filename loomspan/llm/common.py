"""Session-level helpers of the corpus operators: shared storage, sizes, hashing."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word separator class as Java and DuckDB regular expressions write it.
SPACE_CLASS = r"[\x20\x09-\x0D]+"

#: What a null id is taken for: larger than every other.
NULL_ID = (1 << 63) - 1

#: Bytes of a table's values that may be broadcast.
BROADCAST_BYTES = 32 << 20


#: Rows that Spark hands to a Python worker at once, where the session has its default:
#: a batch of long texts stays small.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.
    Only where that is unset and all runs on one machine, a temporary one is made."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not set_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        set_dir = getattr(spark, "_loomspan_shared", None) or tempfile.mkdtemp(prefix="loomspan-")
        spark._loomspan_shared = set_dir
    return set_dir.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    It cuts the lineage: a lost executor costs a read of this table, never a
    recomputation of what made it.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{shared_dir(spark)}/loomspan/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._loomspan_path = path
    return out


def bound_batches(spark: SparkSession) -> None:
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._loomspan_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def _width(field: T.StructField) -> Column:
    """Bytes of a column's value, about."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(field.dataType, T.ArrayType):
        return F.greatest(F.size(c), F.lit(0)) * 8 + 8
    return F.lit(8)


def small(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if its values have at most ``BROADCAST_BYTES``, and
    ``most`` if given, else as it is, so that Spark shuffles it.  ``df`` should be made of a written table, as
    its values are added up.  Arrays are taken to hold numbers."""
    width = reduce(add, (_width(f) for f in df.schema.fields)).cast("long")
    size = df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= min(BROADCAST_BYTES, BROADCAST_BYTES if most is None else most) else df


def keyed_rows(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``id`` (nulls as ``NULL_ID``), ``rid``, which tells texts of one id apart, ``text``
    (nulls as empty) and the whole ``row``."""
    text = F.coalesce(df[text_col], F.lit(""))
    row = F.struct(*(df[c] for c in df.columns))
    return df.select(F.coalesce(df[id_col], F.lit(NULL_ID)).cast("long").alias("id"), F.xxhash64(text).alias("rid"), text.alias("text"), row.alias("row"))


def with_copies(source: DataFrame) -> DataFrame:
    """Adds ``again``: whether a row equal in id and text comes before.

    Such rows are counted first, and only they are numbered: within the task that
    reads them, so that no window holds more than a task's rows."""
    counted = source.groupBy("id", "rid").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = written(counted.select(F.col("id").alias("i"), F.col("rid").alias("r")), "copies")
    if copies.isEmpty():
        return source.withColumn("again", F.lit(False))
    same = (F.col("id") == F.col("i")) & (F.col("rid") == F.col("r"))
    at = source.withColumn("task", F.spark_partition_id())
    alone = at.join(small(copies), same, "left_anti").withColumn("again", F.lit(False))
    several = at.join(small(copies), same, "left_semi")
    least = several.groupBy(F.col("id").alias("i"), F.col("rid").alias("r")).agg(F.min("task").alias("first"))
    nth = F.row_number().over(Window.partitionBy("id", "rid", "task").orderBy("task"))
    numbered = several.withColumn("nth", nth).join(least, same).withColumn("again", (F.col("task") != F.col("first")) | (F.col("nth") > 1))
    return alone.unionByName(numbered.select(*alone.columns))


def has_word(text: Column) -> Column:
    return text.rlike(r"[^\x20\x09-\x0D]")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_count(text: Column) -> Column:
    """Number of words of ``text``; 0 for null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_CLASS)
    return (
        F.size(parts)
        - F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
        - F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    ).cast("long")
