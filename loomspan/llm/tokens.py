"""Token counts with a digest cache.

A text is known by the SHA-256 of its normalised content (the UTF-8 bytes; null
is the empty text), and a tokenizer by the SHA-256 of its vocabulary file and the
way it is called.  Counts already in the cache are joined by these digests; of the
rest, each distinct content is encoded once, and the new counts are appended to
the cache, which later runs and other tables read.

The cache is Parquet in a folder all executors reach, partitioned by tokenizer
digest.  Appends are idempotent: a key appended twice by jobs that ran at the same
time carries the same count, and readers take one row per key.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
keep their rows and are encoded once; other columns are ignored; an empty table
gives an empty result; ids may be null or repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm import common, textcore

CACHE_SCHEMA = "content_sha binary, tokenizer string, n_tokens long"
#: Texts longer than this are encoded alone, so that a batch stays small.
BATCH_BYTES = 1 << 20
#: A content of more rows than this part of all is hot; so there are at most as many.
MOST_HOT = 10_000


@lru_cache(maxsize=4)
def _encoder(path: str):
    """(texts -> counts) for a vocabulary file: .model or .json."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_padding()
    tok.no_truncation()
    return lambda texts: [len(x) for x in tok.encode_batch(texts, add_special_tokens=False)]


def tokenizer_digest(path: str) -> str:
    """Names the vocabulary and the call: a new file or call is a new cache key."""
    h = hashlib.sha256(b"no special tokens, no truncation, no padding;")
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    return h.hexdigest()


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _encoder(path)
        for b in batches:
            texts = b.column(1)
            _, off = textcore.utf8(texts)
            counts: list[int] = []
            for lo, hi in textcore.chunks(off, BATCH_BYTES):
                counts += count(texts.slice(lo, hi - lo).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64())], ["content_sha", "n_tokens"])

    return run


def _cached(spark: SparkSession, cache: str) -> DataFrame:
    """What the cache holds; nothing if it was never written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(CACHE_SCHEMA).parquet(cache)
    return spark.createDataFrame([], CACHE_SCHEMA)


def token_counts(df: DataFrame, tokenizer: str, cache: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_tokens``.  ``tokenizer`` is a vocabulary file
    present on every machine, ``cache`` a shared folder, made when missing.

    Only digests are shuffled where the misses are few enough to broadcast (the
    count is checked); beyond that the join shuffles texts once.
    """
    spark = df.sparkSession
    digest = tokenizer_digest(tokenizer)
    source = df.select(df[id_col].alias("id"), F.coalesce(df[text_col], F.lit("")).alias("text")).withColumn("content_sha", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    keys = common.written(source.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "content_sha"), "token-keys")
    known = _cached(spark, cache).where(F.col("tokenizer") == digest).select("content_sha", "n_tokens")
    # of each content that the cache lacks, one row says where its text stands
    per = keys.groupBy("content_sha").agg(F.min("id").alias("at"), F.count(F.lit(1)).alias("rows"))
    misses = common.written(per.join(known, "content_sha", "left_anti").withColumnRenamed("content_sha", "want"), "token-misses")
    texts = source.join(common.small(misses), (F.col("content_sha") == F.col("want")) & F.col("id").eqNullSafe(F.col("at"))).select("content_sha", "text", "rows")
    # rows equal in id and text are among those of contents that several rows have
    once = texts.where("rows = 1").unionByName(texts.where("rows > 1").dropDuplicates(["content_sha"]))
    fresh = once.select("content_sha", "text").mapInArrow(_encode(tokenizer), "content_sha binary, n_tokens long")
    fresh.select("content_sha", "n_tokens", F.lit(digest).alias("tokenizer")).write.mode("append").partitionBy("tokenizer").parquet(cache)
    counts = _cached(spark, cache).where(F.col("tokenizer") == digest).groupBy("content_sha").agg(F.max("n_tokens").alias("n_tokens"))
    # contents of very many rows are few, and joined by broadcast: no task holds all rows of one
    total = per.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = common.written(per.where(F.col("rows") > max(1000, total // MOST_HOT)).select("content_sha").join(counts, "content_sha"), "token-hot")
    cold = keys.join(F.broadcast(hot.select("content_sha")), "content_sha", "left_anti").join(counts, "content_sha")
    out = cold.unionByName(keys.join(F.broadcast(hot), "content_sha"))
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens")
