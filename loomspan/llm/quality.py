"""Quality rules as one projection: a threshold table compiled to columns.

Everything is a built-in expression, so that the rules run in one pass with no
shuffle and no Python.  ``RULES`` is the table: a feature, a bound on either side,
and the least number of words from which the rule is asked.  ``compile_rules``
turns it into one array of failed rule names.

A text that repeats itself is recognised by its 3-word windows.  They are sorted
with their positions inside the row, equal neighbours mark repeated windows, and
the words under any marked window are counted once each.

Defined results: a null text counts as a text without words, so it fails the
length rule; repeated rows are judged alike; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm.common import SPACE_CLASS

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

#: Function words of the four languages the corpus holds.
STOP_WORDS = (
    "the and of to in is that it for was on are as with be by this have from or at not "
    "der die das und den von zu mit ist im sich auf des dem nicht ein eine für "
    "de la le les et des en un une du que est pour dans qui sur au avec "
    "el los las del y por con una su para es al lo como se"
).split()


@dataclass(frozen=True)
class Rule:
    feature: str
    least: float | None = None
    most: float | None = None
    #: Asked of texts with this many words at least.
    from_words: int = 0


RULES = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbols_per_word", None, 0.25),
    Rule("dup_line_ratio", None, 0.5),
    Rule("stop_word_ratio", 0.06, None, 50),
    Rule("shouted_ratio", None, 0.4, 50),
)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS), lambda w: w != "")


def _windows(hashes: str) -> Column:
    """64-bit hashes of the 3-word windows, from the words' own hashes.

    Within one text of 20,000 words two different windows share a hash with a
    probability of about 1e-11."""
    return F.expr(f"transform(slice({hashes}, 1, greatest(size({hashes}) - 2, 0)), (a, i) -> xxhash64(a, {hashes}[i + 1], {hashes}[i + 2]))")


#: Positions of windows that occur again, ascending: sorted by hash, they have an equal neighbour.
_SORTED = "sort_array(transform(windows, (w, i) -> struct(w, i)))"
_MARKED = "sort_array(filter(transform(ranked, (x, k) -> if((k > 0 and get(ranked, k - 1).w = x.w) or get(ranked, k + 1).w = x.w, x.i, -1)), i -> i >= 0))"
#: Each marked window covers three words, less what the one before it covered.
_COVERED = "aggregate(transform(marked, (p, k) -> if(k = 0, 3, least(3, p - get(marked, k - 1)))), 0L, (a, x) -> a + x)"


def measures(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row the id and all features that the rules use."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step1 = df.select(df[id_col].alias("id"), df[text_col].alias("text")).select(
        "id",
        _words(text).alias("words"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]{4,}")).alias("n_shouted"),
        F.size(lines).alias("n_lines"),
        F.size(F.array_distinct(lines)).alias("n_distinct_lines"),
    )
    stop = F.filter("words", lambda w: F.lower(w).isin(*STOP_WORDS))
    step2 = step1.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.col("n_lines") - F.col("n_distinct_lines")).cast("long").alias("n_dup_lines"),
        "n_lines",
        F.size(stop).alias("n_stop"),
        "n_shouted",
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    step3 = step2.withColumn("windows", _windows("hashes")).drop("hashes")
    # most texts repeat no window: only the others are sorted
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    step4 = step3.withColumn("ranked", F.when(repeats, F.expr(_SORTED)).otherwise(F.expr("array()").cast("array<struct<w:bigint,i:int>>"))).drop("windows")
    step5 = step4.withColumn("marked", F.expr(_MARKED)).drop("ranked")
    n = F.greatest(F.col("n_words"), F.lit(1))
    return step5.select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.expr(_COVERED).alias("n_repeat_words"),
        (F.col("word_chars") / n).alias("mean_word_chars"),
        (F.col("n_symbols") / n).alias("symbols_per_word"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_line_ratio"),
        (F.col("n_stop") / n).alias("stop_word_ratio"),
        (F.col("n_shouted") / n).alias("shouted_ratio"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a row of ``measures`` fails."""
    failed = []
    for r in rules:
        out = F.lit(False)
        if r.least is not None:
            out = out | (F.col(r.feature) < r.least)
        if r.most is not None:
            out = out | (F.col(r.feature) > r.most)
        failed.append(F.when(out & (F.col("n_words") >= r.from_words), F.lit(r.feature)))
    return F.filter(F.array(*failed), lambda x: x.isNotNull())


def judge(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measures`` with ``base_failed``, ``failed_rules`` and ``kept``."""
    out = measures(df, text_col, id_col).withColumn("base_failed", base_failed()).withColumn("failed_rules", compile_rules(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
