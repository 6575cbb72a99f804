"""Validation of corpora from elsewhere: all findings of all gates in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspan import schema
from loomspan.functions.text import squeezed_fingerprint
from loomspan.operators import gates

#: Ids that a group of duplicates lists; ``duplicate_members`` has them all, as rows.
MOST_LISTED = 100


def numbered_lines(text: DataFrame) -> DataFrame:
    """``file, line_no, line`` from lines as tasks read them, with the ``block`` of the
    file each comes from.

    Lines are numbered from 1 in two steps: within the pieces that tasks read, then by
    the pieces' lengths, so no task holds a whole file.  ``text`` is evaluated twice, in
    the same pieces."""
    text = text.select("file", "block", F.monotonically_increasing_id().alias("at"), "line")
    starts = text.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = starts.select("file", "block", "first", before.alias("before"))
    return text.join(starts, ["file", "block"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_no"), "line")


def _unknown(line: Column) -> Column:
    """Names of fields that the contract doesn't have, at any level."""
    record = T.StructType.fromDDL(schema.RECORD_DDL)
    inner = {f.name: f.dataType for f in record.fields if isinstance(f.dataType, T.StructType)}
    extra = lambda json, kind: F.array_except(F.coalesce(F.json_object_keys(json), F.array().cast("array<string>")), F.array(*map(F.lit, kind.fieldNames())))
    below = lambda name, names: F.transform(names, lambda x: F.concat(F.lit(f"{name}."), x))
    turns = F.coalesce(F.from_json(F.get_json_object(line, "$.turns"), "array<string>"), F.array().cast("array<string>"))
    in_turns = F.array_distinct(F.flatten(F.transform(turns, lambda t: extra(t, record["turns"].dataType.elementType))))
    return F.array_sort(F.concat(extra(line, record), *(below(k, extra(F.get_json_object(line, f"$.{k}"), kind)) for k, kind in inner.items()), below("turns", in_turns)))


def parsed_lines(numbered: DataFrame) -> DataFrame:
    """``file, line_no, line, record, error``: a bad line has an error and no record.
    Blank lines are left out."""
    unknown = F.array_join(_unknown(F.col("line")), ", ")
    error = F.when(F.json_object_keys("line").isNull(), F.lit("not_json")).when(unknown != "", F.concat(F.lit("unknown fields: "), unknown))
    parsed = numbered.where(F.trim("line") != "").withColumn("record", F.from_json("line", schema.RECORD_DDL)).withColumn("error", error)
    return parsed.withColumn("record", F.when(F.col("error").isNull(), F.col("record")))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, line, record, error`` of JSON Lines; a bad line is a row with an
    error, and reading goes on.  Blank lines are skipped, but counted."""
    text = spark.read.text(path).select(F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), F.col("value").alias("line"))
    return parsed_lines(numbered_lines(text))


def time_findings(turns: DataFrame) -> DataFrame:
    """Turns that were said before their record was made or after it was resolved, from
    ``record_id, index, said_at, created_at, resolved_at``; a turn without a time is none."""
    bad = (F.col("said_at") < F.col("created_at")) | (F.col("said_at") > F.col("resolved_at"))
    return turns.where(bad).select("record_id", F.lit("times").alias("gate"), F.concat(F.lit("turn_time_out_of_bounds:"), F.col("index").cast("string")).alias("finding"))


def upstream_findings(derived: DataFrame, upstream: DataFrame) -> DataFrame:
    """Records of a derived set whose id the set it was made of doesn't have."""
    ids = upstream.select(F.col("record_id").alias("_up")).distinct()
    return derived.join(ids, F.col("record_id").eqNullSafe(F.col("_up")), "left_anti").select("record_id", F.lit("upstream").alias("gate"), F.lit("unknown_upstream_id").alias("finding"))


def duplicate_groups(records: DataFrame) -> DataFrame:
    """``fingerprint, kept, members, n``: records of the same turns, white space and
    normal form aside; the first by record index is kept.  Ids of a group are listed
    up to ``MOST_LISTED``, ``n`` counts them all."""
    fp = records.select(squeezed_fingerprint("turns").alias("fingerprint"), F.struct("record_index", "record_id").alias("r"))
    per = fp.groupBy("fingerprint").agg(F.min("r").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rank = F.row_number().over(Window.partitionBy("fingerprint").orderBy("r"))
    members = fp.join(per.select("fingerprint"), "fingerprint", "left_semi").withColumn("k", rank).where(F.col("k") <= MOST_LISTED)
    listed = members.groupBy("fingerprint").agg(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["record_id"]).alias("members"))
    return per.join(listed, "fingerprint").select("fingerprint", F.col("first.record_id").alias("kept"), "members", "n")


def duplicate_members(records: DataFrame) -> DataFrame:
    """``fingerprint, kept, record_id``: every member of every group, however large."""
    fp = records.select(squeezed_fingerprint("turns").alias("fingerprint"), F.struct("record_index", "record_id").alias("r"))
    per = fp.groupBy("fingerprint").agg(F.min("r").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return fp.join(per, "fingerprint").select("fingerprint", F.col("first.record_id").alias("kept"), F.col("r.record_id").alias("record_id"))


def contract_findings(records: DataFrame) -> DataFrame:
    """``record_id, gate, finding``: a row per violation."""
    return records.select("record_id", F.lit("contract").alias("gate"), F.explode(gates.violations()).alias("finding"))


def version_findings(records: DataFrame) -> DataFrame:
    bad = records.where(F.coalesce(F.col("schema_version") != schema.SCHEMA_VERSION, F.lit(True))).select("record_id", F.lit("version").alias("gate"), F.lit("unsupported_version").alias("finding"))
    mixed = records.agg(F.count_distinct("schema_version").alias("n")).where("n > 1").select(F.lit(None).cast("string").alias("record_id"), F.lit("version").alias("gate"), F.lit("mixed_versions").alias("finding"))
    return bad.unionByName(mixed)


def duplicate_findings(records: DataFrame) -> DataFrame:
    ids = records.groupBy("record_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("record_id", F.lit("duplicates").alias("gate"), F.lit("duplicate_record_id").alias("finding"))
    fp = records.withColumn("fp", squeezed_fingerprint("turns"))
    first = fp.groupBy("fp").agg(F.min("record_index").alias("m"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = fp.join(first, "fp").where(F.col("record_index") > F.col("m")).select("record_id", F.lit("duplicates").alias("gate"), F.lit("duplicate_content").alias("finding"))
    return ids.unionByName(same)


def all_findings(records: DataFrame) -> DataFrame:
    """Every gate runs, whatever the others find; an empty corpus is a finding."""
    empty = records.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(None).cast("string").alias("record_id"), F.lit("artifact").alias("gate"), F.lit("empty").alias("finding"))
    return contract_findings(records).unionByName(version_findings(records)).unionByName(duplicate_findings(records)).unionByName(empty)


def report(findings: DataFrame) -> DataFrame:
    return findings.groupBy("gate", "finding").agg(F.count(F.lit(1)).alias("n"))
