"""Mixing sources to target weights with a low-discrepancy schedule.

Targets.  Sources take weights 5, 2, 1, repeating, in code-point order with null
last, and share the corpus's words; a source's target stops at ``MAX_EPOCHS``
times its size and the excess is shared again by weight until none is above.

Schedule.  Slot n draws the point frac(n * golden ratio); the source whose piece
of the cumulative targets holds the point gets the slot.  Slots are ranked per
source.  A source's documents, in an order shuffled by a hash, form a stream of
words that starts again at its end; it is cut into blocks of equal length, and the
slot ranked k takes block k.  The source's last slot is cut to meet its target, and
slots that the finite schedule left out are appended at its end.

No window holds a whole source: word positions are summed over hash buckets first,
then within a bucket, so that a source with a third of all rows is many tasks.

Defined results: a null or empty text has size 0 and is taken 0 times; a null
source is a source of its own, the last; documents with a null id come last in their
source's stream, smaller ones first; repeated rows are separate documents of the
stream; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.llm import common

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Most words in a block; fewer where the corpus is small, so that each source has many slots.
BLOCK_WORDS = 4096
SLOTS_PER_SOURCE = 512
#: Pieces in which a source's stream is summed.
BUCKETS = 1024
#: Pieces of the documents of one source and size that have a null id.
NULL_PIECES = 16
_GOLDEN = 0.6180339887498949


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, weight, target`` from rows of ``source, size``.

    The sources that reach their limit are a prefix in the order of limit over
    weight; a source is in it if its limit is below the level that the words not
    given out before it would put all sources from it on at.  The windows run over
    one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", w.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = (
        per.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left_words", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(after))
        .withColumn("level", F.col("left_words") / F.col("left_weight"))
    )
    per = per.withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
    # the first source that is not capped has the most weight left
    first = F.max(F.when(~F.col("capped"), F.struct("left_weight", "level"))).over(everything)
    return per.select(
        "source", "source_size", "weight",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * first["level"]).alias("target"),
    )


def _shuffled(docs: DataFrame) -> DataFrame:
    """Adds ``start``: words of the source's stream before the document.

    Null ids have buckets above all others, in the order of size.  Those of one
    source and size can't be told apart, so ``piece`` may deal them in any way."""
    docs = docs.withColumn("key", F.md5(F.col("doc_id").cast("string")))
    hashed = F.conv(F.substring("key", 1, 4), 16, 10).cast("long") % BUCKETS
    docs = docs.withColumn("bucket", F.coalesce(hashed, BUCKETS + F.col("size") * NULL_PIECES + F.col("piece")))
    per = docs.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return docs.join(per, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).withColumn("start", F.col("offset") + F.col("within")).drop("s", "b", "offset", "within", "bucket", "key", "piece")


def slot_schedule(targets: DataFrame, block_words: int = BLOCK_WORDS, slots_per_source: int = SLOTS_PER_SOURCE) -> DataFrame:
    """``slot, source, rank, block_from, block_to``: which words of which source's
    unrolled stream each slot takes.  Slots of appended blocks have no number.

    ``targets`` must be a written table."""
    spark = targets.sparkSession
    whole = F.round("target").cast("long")
    total = Window.partitionBy()
    t = targets.where(whole > 0).withColumn("want", whole)
    t = t.withColumn("block", F.greatest(F.lit(1), F.least(F.lit(block_words), (F.sum("want").over(total) / (slots_per_source * F.count(F.lit(1)).over(total))).cast("long"))))
    t = t.withColumn("need", F.ceil(F.col("want") / F.col("block")).cast("long"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = t.withColumn("hi", F.sum("need").over(order) / F.sum("need").over(total)).withColumn("lo", (F.sum("need").over(order) - F.col("need")) / F.sum("need").over(total)).withColumn("slots", F.sum("need").over(total))
    n = t.agg(F.coalesce(F.max("slots"), F.lit(0))).first()[0]
    points = spark.range(n).select(F.col("id").alias("slot"), (F.col("id") * F.lit(_GOLDEN)).alias("p")).select("slot", (F.col("p") - F.floor("p")).alias("point"))
    # one row per source: as small as its count, which is checked
    pieces = common.small(t.select("source", "need", "block", "want", "lo", "hi"))
    drawn = points.join(pieces, (F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi")), "inner")
    ranked = _ranked(drawn)
    got = ranked.where(F.col("rank") <= F.col("need"))
    short = got.groupBy("source").agg(F.count(F.lit(1)).alias("got")).withColumnRenamed("source", "s")
    added = (
        t.join(short, F.col("source").eqNullSafe(F.col("s")), "left")
        .withColumn("got", F.coalesce("got", F.lit(0)))
        .where(F.col("got") < F.col("need"))
        .select(F.lit(None).cast("long").alias("slot"), "source", F.explode(F.sequence(F.col("got") + 1, F.col("need"))).alias("rank"), "block", "want")
    )
    slots = got.select("slot", "source", "rank", "block", "want").unionByName(added)
    return slots.select("slot", "source", "rank", "block", ((F.col("rank") - 1) * F.col("block")).alias("block_from"), F.least(F.col("rank") * F.col("block"), F.col("want")).alias("block_to"))


def _ranked(drawn: DataFrame) -> DataFrame:
    """Slots ranked per source in two steps, over runs of slots and within a run."""
    drawn = drawn.withColumn("run", F.floor(F.col("slot") / 65536))
    per = drawn.groupBy("source", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("source").alias("s"), F.col("run").alias("r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("source", "run").orderBy("slot"))
    return drawn.withColumn("within", inside).join(per, F.col("source").eqNullSafe(F.col("s")) & (F.col("run") == F.col("r"))).withColumn("rank", F.col("offset") + F.col("within")).drop("s", "r", "offset", "within", "run")


def mix_sources(df: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The documents with what the mix takes of each, and the slot schedule.

    Documents: id, ``source``, ``size``, ``source_size``, ``target``, ``taken``
    (words, repeats counted), and of the slots that take them the first, the number and
    the sum (``first_slot``, ``n_slots``, ``slot_sum``; slots that were appended have no
    number).  Only ids, sources and sizes are shuffled.
    """
    piece = F.pmod(F.monotonically_increasing_id(), F.lit(NULL_PIECES))
    docs = common.written(df.select(df[id_col].alias("doc_id"), df[source_col].alias("source"), common.word_count(df[text_col]).alias("size"), piece.alias("piece")), "mix-docs")
    targets = common.written(source_targets(docs), "mix-targets")
    schedule = common.written(slot_schedule(targets), "mix-schedule")
    size, start = F.col("size"), F.col("start")
    t = targets.select(F.col("source").alias("s"), "source_size", "target")
    placed = common.written(_shuffled(docs).join(common.small(t), F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("row", F.monotonically_increasing_id()), "mix-placed")
    block = schedule.agg(F.coalesce(F.max("block"), F.lit(1))).first()[0]
    want = F.round("target").cast("long")
    # where the document stands in each turn of the stream, as far as the target goes
    turns = placed.where((size > 0) & (start < want)).select("row", "source", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((want - start - 1) / F.col("source_size")))).alias("turn"), start.alias("at"), "source_size")
    turns = turns.select("row", "source", (F.col("turn") * F.col("source_size") + F.col("at")).alias("from"), (F.col("turn") * F.col("source_size") + F.col("at") + size).alias("to"))
    pieces = turns.select("row", "source", "from", "to", F.explode(F.sequence(F.floor(F.col("from") / block) + 1, F.floor((F.col("to") - 1) / block) + 1)).alias("rank"))
    slots = schedule.select(F.col("source").alias("s"), F.col("rank").alias("k"), "slot", "block_from", "block_to")
    hit = pieces.join(slots, F.col("source").eqNullSafe(F.col("s")) & (F.col("rank") == F.col("k")))
    hit = hit.withColumn("words", F.least("to", "block_to") - F.greatest("from", "block_from")).where("words > 0")
    taken = hit.groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.count_distinct("slot").alias("n_slots"), F.sum_distinct("slot").alias("slot_sum"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = placed.join(taken, "row", "left").select(F.col("doc_id").alias(id_col), "source", "size", "source_size", "target", none("taken"), "first_slot", none("n_slots"), none("slot_sum"))
    return out, schedule
