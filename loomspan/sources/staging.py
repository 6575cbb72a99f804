"""Tables written between the steps of a job.

They go to the folder that driver and executors share, named in ``spark.checkpoint.dir``,
so that a lost executor costs a read and not what made the table.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder.  Where none is set, one machine's own serves a local session
    and is an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_loomspan_shared", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = spark._loomspan_shared = tempfile.mkdtemp(prefix="loomspan-")
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loomspan/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._staged_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
