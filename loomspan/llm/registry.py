"""The queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm import bpe, common, leaks, lines, mixing, pii, preference, quality, repair, resampling, shingles, substrings, tokens, toxicity
from loomspan.llm.sql import ORACLES  # noqa: F401

TOKENIZER = "piece_bpe_32k.model"
MAX_TOKENS = 4096
BYTE_BPE = "byte_bpe_50k.json"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(common.documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(common.documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.find_leaks(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", F.round("lcs_share", 6).alias("lcs_share"), F.round("answer_share", 6).alias("answer_share"))


def op4_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.near_duplicates(common.documents(spark, sf_dir))


def _ranges(c: str):
    return F.array_join(F.transform(c, lambda r: F.concat_ws(":", r["start"], r["end"])), ",")


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    out = preference.format_pairs(preference.pair_conversations(turns))
    return out.select("conv_id", "prompt_turns", "prompt", "chosen_completion", _ranges("chosen_mask").alias("chosen_mask"), "rejected_completion", _ranges("rejected_mask").alias("rejected_mask"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(common.documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "kept_sha256")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(common.documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mixing.mix_sources(common.documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots", "slot_sum")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each call starts a cache of its own, so that it counts every content anew."""
    import public_tokenizers

    cache = f"{common.shared_dir(spark)}/loomspan/token-cache-{uuid.uuid4().hex}"
    counts = tokens.token_counts(common.documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resample(common.documents(spark, sf_dir), target, percent=10, least_words=20, seed=2024)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(BYTE_BPE)
    return bpe.digests(bpe.decode(bpe.encode(common.documents(spark, sf_dir), path), path))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair.digests(repair.repair(repair.damage(turns)), turns)


QUERIES = {f.__name__: f for f in (op1_pii, op2_quality_rules, op3_decontamination, op4_jaccard_rtree, op5_preference_format, op6_line_dedup, op7_suffix_array_dedup, op8_toxicity, op9_mixing, op10_token_counts, op11_resampling, op12_bpe, op13_repair)}
