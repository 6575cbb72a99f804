"""A corpus that arrives as files: read as a stream, good records and bad lines apart.

Each file is JSON Lines and arrives whole.  A batch is one or several files; its lines are
numbered within their files as the batch reader numbers them, so a bad line is reported
with the same file and number by either.  Records and bad lines of a batch are written to
folders named by the batch's number, so a batch that comes again after a crash replaces
what it wrote before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from loomspan import schema
from loomspan.operators import validator
from loomspan.sources.store import Store, join

BAD = "file string, line_no long, line string, error string"
GOOD = f"file string, line_no long, record struct<{schema.RECORD_DDL}>"


@dataclass
class CorpusStream:
    """Files in ``source`` into ``target``: ``records``, ``bad_lines`` and a checkpoint."""

    spark: SparkSession
    source: str
    target: str
    files_per_batch: int | None = None

    def lines(self) -> DataFrame:
        """The stream of lines, with the file and the block that each comes from."""
        reader = self.spark.readStream.option("recursiveFileLookup", "true")
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        return reader.text(self.source).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))

    def each(self, lines: DataFrame, batch: int) -> None:
        """Writes one batch to both sinks."""
        parsed = validator.parsed_lines(validator.numbered_lines(lines)).persist()
        try:
            parsed.where("error is null").select("file", "line_no", "record").write.mode("overwrite").parquet(join(self.target, "records", f"batch={batch}"))
            parsed.where("error is not null").select("file", "line_no", "line", "error").write.mode("overwrite").parquet(join(self.target, "bad_lines", f"batch={batch}"))
        finally:
            parsed.unpersist()

    def start(self, **trigger) -> StreamingQuery:
        w = self.lines().writeStream.option("checkpointLocation", join(self.target, "checkpoint")).foreachBatch(self.each)
        return (w.trigger(**trigger) if trigger else w).start()

    def _read(self, kind: str, ddl: str) -> DataFrame:
        path = join(self.target, kind)
        if not Store(self.spark).exists(path):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(path)

    def records(self) -> DataFrame:
        """All good records so far."""
        return self._read("records", GOOD).select("record.*")

    def bad_lines(self) -> DataFrame:
        return self._read("bad_lines", BAD)

    def findings(self) -> DataFrame:
        """What all gates say of the records so far."""
        return validator.all_findings(self.records())
