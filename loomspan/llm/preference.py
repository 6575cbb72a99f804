"""Preference formatting of chosen and rejected conversations.

The longest common turn prefix of both conversations is rendered once as the
prompt; what is left of each is a completion, with the character ranges in it that
are trained on (assistant turns' text and end mark) and all else masked.

All of it is array expressions on one row per pair; turns are gathered per
conversation by aggregation.

Defined results: a null role reads as an empty one and a null text as an empty
text, both in comparisons and in rendering; turns with one number are ordered by
role and text, repeated rows are repeated turns; a null conversation id is one
conversation; turns with a null number come first; other columns are ignored; an
empty table gives an empty result.  A pair without a rejected conversation has a
null completion for it, and its prompt ends before its last assistant turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MID, CLOSE = "<|", "|>\n", "\n<|end|>\n"
TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def gather_turns(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: its id and its ``turns`` in order."""
    t = turns.select(turns[id_col].alias(id_col), F.struct(turns["turn"].cast("long").alias("turn"), F.coalesce(turns["role"], F.lit("")).alias("role"), F.coalesce(turns["text"], F.lit("")).alias("text")).alias("t"))
    return t.groupBy(id_col).agg(F.sort_array(F.collect_list("t")).alias("turns"))


def _turn(t: Column) -> Column:
    return F.concat(F.lit(OPEN), t["role"], F.lit(MID), t["text"], F.lit(CLOSE))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _turn), "")


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns that are equal in role and text."""
    n = F.least(F.size(chosen), F.size(rejected))
    differ = F.filter(
        F.transform(F.sequence(F.lit(1), n + 1), lambda i: F.when(i > n, i).when((F.get(chosen, i - 1)["role"] != F.get(rejected, i - 1)["role"]) | (F.get(chosen, i - 1)["text"] != F.get(rejected, i - 1)["text"]), i)),
        lambda i: i.isNotNull(),
    )
    return F.element_at(differ, 1) - 1


def trained_ranges(turns: Column) -> Column:
    """Start and end of what is trained on in the rendered turns, in characters."""
    step = lambda acc, t: F.struct(
        (acc["at"] + F.length(_turn(t))).alias("at"),
        F.when(
            t["role"] == "assistant",
            F.concat(acc["out"], F.array(F.struct((acc["at"] + F.length(F.concat(F.lit(OPEN), t["role"], F.lit(MID)))).alias("start"), (acc["at"] + F.length(_turn(t))).alias("end")))),
        ).otherwise(acc["out"]).alias("out"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    return F.aggregate(turns, start, step, lambda acc: acc["out"])


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Adds ``prompt_turns``, ``prompt``, and for either side its completion and the
    ranges trained on, to rows with two arrays of turns."""
    both = F.col(rejected).isNotNull()
    n = F.when(both, common_turns(F.col(chosen), F.col(rejected))).otherwise(F.greatest(F.lit(0), F.size(chosen) - 1))
    p = pairs.withColumn("prompt_turns", n)
    rest = lambda c: F.slice(F.col(c), F.col("prompt_turns") + 1, F.greatest(F.size(c), F.lit(0)))
    p = p.withColumn("_c", rest(chosen)).withColumn("_r", F.when(both, rest(rejected)))
    return p.select(
        *pairs.columns,
        F.col("prompt_turns").cast("long").alias("prompt_turns"),
        render(F.slice(F.col(chosen), F.lit(1), F.col("prompt_turns"))).alias("prompt"),
        render(F.col("_c")).alias("chosen_completion"),
        trained_ranges(F.col("_c")).alias("chosen_mask"),
        render(F.col("_r")).alias("rejected_completion"),
        trained_ranges(F.col("_r")).alias("rejected_mask"),
    )


def pair_conversations(turns: DataFrame) -> DataFrame:
    """Pairs for a table without preferences: each conversation is chosen.  The rejected
    one is the same up to a turn drawn by a hash of its id, and goes on as the
    conversation beside it (whole-number id with the lowest bit turned) does from that
    turn.  Without one beside it there is no rejected conversation."""
    convs = gather_turns(turns)
    beside = convs.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("for"), F.col("turns").alias("other"))
    joined = convs.join(beside, F.col("conv_id") == F.col("for"), "left")
    at = (F.conv(F.substring(F.md5(F.col("conv_id").cast("string")), 1, 4), 16, 10).cast("long") % F.size("turns")).cast("int")
    rest = F.slice("other", at + 1, F.greatest(F.size("other"), F.lit(0)))
    return joined.select("conv_id", F.col("turns").alias("chosen"), F.when(F.col("other").isNotNull(), F.concat(F.slice("turns", F.lit(1), at), rest)).alias("rejected"))
