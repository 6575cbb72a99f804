"""Importance resampling towards a target distribution of hashed n-grams.

Words of ASCII lower case are interned, batch by batch, in an open-addressed table of
numpy arrays: a slot is found by the xxhash64 of the n-gram's bytes and linear probing,
and is taken for equal only once the bytes themselves are.  A slot stores its n-gram's
bucket and count; each occurrence keeps its slot's number.  Summed over slots, counts
give the buckets of the corpus and of the target, and from these the gain of a bucket.
On a second reading occurrences gather their gains through their slots.

What leaves a task is one count per bucket, or one row per document; there are as many
buckets as a parameter says, so the driver may hold them.  Drawing is by score plus
Gumbel noise from a digest of the id; places are found in ranges of the score
(``ranking.numbered``), never in one task.

Defined results: null texts are empty; a document without words has no features, weight
0 and a score of noise alone; a null id reads as an empty one in the noise and comes
last among ties; rows equal in id and text are documents of their own; ties in score and
id go to fewer features; other columns are ignored; empty tables give empty results, and
an empty target gives gains as for counts of 0.  A word of any length is one word.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm import common, textcore
from loomspan.operators import ranking

#: Bytes outside words, once A-Z are lower-cased.
BETWEEN = np.ones(256, bool)
BETWEEN[0x30:0x3A] = BETWEEN[0x61:0x7B] = BETWEEN[0x80:] = False

# The five primes of the 64-bit xxHash.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

#: Bytes from which a span is hashed and compared alone.
ALONE = 32

_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


@dataclass(frozen=True)
class Features:
    """Runs of ``low`` to ``high`` consecutive words, dealt to ``buckets`` buckets."""

    low: int = 1
    high: int = 1
    buckets: int = 10_000


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """xxhash64, with seed 0, of byte ranges: short ones together, lane by lane, and
    longer ones by the library."""
    size = end - start
    h = size.astype(np.uint64) + P5
    word = textcore.octets(data)
    short = np.flatnonzero(size < ALONE)
    done = np.zeros(len(size), np.int64)
    at = short[size[short] >= 8]
    while len(at):
        lane = word[start[at] + done[at]]
        h[at] = _turned(h[at] ^ (_turned(lane * P2, 31) * P1), 27) * P1 + P4
        done[at] += 8
        at = at[size[at] - done[at] >= 8]
    at = short[size[short] - done[short] >= 4]
    h[at] = _turned(h[at] ^ ((word[start[at] + done[at]] & _MASK[4]) * P1), 23) * P2 + P3
    done[at] += 4
    at = short[size[short] > done[short]]
    while len(at):
        h[at] = _turned(h[at] ^ ((word[start[at] + done[at]] & _MASK[1]) * P5), 11) * P1
        done[at] += 1
        at = at[size[at] > done[at]]
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size >= ALONE).tolist():
        h[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]])
    return h


class SlotTable:
    """The n-grams of one batch: byte ranges of ``data``, interned.

    ``slot`` is each occurrence's slot; per slot there are ``holder``, the occurrence
    whose bytes it stands for (-1: free), ``key``, ``bucket`` and ``count``."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int, keys: np.ndarray | None = None):
        n = len(start)
        keys = xxh64(data, start, end) if keys is None else keys
        # at most half of it is ever taken
        self.mask = (1 << max(3, (2 * n - 1).bit_length())) - 1 if n else 7
        self.holder = np.full(self.mask + 1, -1, np.int64)
        self.key = np.zeros(self.mask + 1, np.uint64)
        self.slot = np.empty(n, np.int64)
        word = textcore.octets(data)
        left, at = np.arange(n), (keys & np.uint64(self.mask)).astype(np.int64)
        while len(left):
            free = self.holder[at] < 0
            # of several that write to a slot one stays; the others compare with it
            self.holder[at[free]] = left[free]
            self.key[at[free]] = keys[self.holder[at[free]]]
            same = self.key[at] == keys[left]
            same[same] = _equal(data, word, start, end, self.holder[at[same]], left[same])
            self.slot[left[same]] = at[same]
            left, at = left[~same], (at[~same] + 1) & self.mask
        self.count = np.bincount(self.slot, minlength=self.mask + 1)
        self.bucket = np.zeros(self.mask + 1, np.int64)
        used = np.flatnonzero(self.count)
        held, raw = self.holder[used], data.tobytes()
        spans = zip(start[held].tolist(), end[held].tolist())
        self.bucket[used] = [zlib.crc32(raw[a:z]) % buckets for a, z in spans]


def _equal(data: np.ndarray, word: np.ndarray, start: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the spans of the occurrences ``a`` hold the bytes of those of ``b``."""
    size = end[a] - start[a]
    same = (size == end[b] - start[b]) | (a == b)
    at, done = np.flatnonzero(same & (a != b) & (size < ALONE)), 0
    while len(at):
        differ = (word[start[a[at]] + done] ^ word[start[b[at]] + done]) & _MASK[np.minimum(size[at] - done, 8)]
        same[at[differ != 0]] = False
        done += 8
        at = at[(differ == 0) & (size[at] > done)]
    for i in np.flatnonzero(same & (a != b) & (size >= ALONE)).tolist():
        same[i] = np.array_equal(data[start[a[i]] : end[a[i]]], data[start[b[i]] : end[b[i]]])
    return same


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words set side by side with one blank behind each, and where each begins."""
    size = end - start
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(int(begin[-1]), 32, np.uint8)
    shift = np.repeat(start - begin[:-1], size)
    to = np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)
    out[to] = data[to + shift]
    return out, begin


def _occurrences(data: np.ndarray, offsets: np.ndarray, features: Features, skip: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of all runs, the text of each, and words per text.  Runs
    within the first ``skip`` words were counted with the piece before."""
    start, end, first = textcore.word_spans(data, offsets, BETWEEN)
    n_words = np.diff(first)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    if features.low == features.high == 1:
        return data, start[skip:], end[skip:], doc[skip:], n_words
    data, begin = _joined(data, start, end)
    starts, ends, docs = [], [], []
    for n in range(features.low, features.high + 1):
        i = np.arange(len(start) - n + 1)
        i = i[(doc[i] == doc[i + n - 1]) & (i + n > skip)]
        starts.append(begin[i])
        ends.append(begin[i + n] - 1)
        docs.append(doc[i])
    return data, np.concatenate(starts), np.concatenate(ends), np.concatenate(docs), n_words


def _pieces(data: np.ndarray, offsets: np.ndarray, features: Features) -> Iterator[tuple[int, int, int, int, int]]:
    """Row ranges, byte ranges and words to skip: rows of about a chunk, and of a longer
    text pieces cut between words, each with the last words of the piece before."""
    limit = textcore.CHUNK_BYTES
    for lo, hi in textcore.chunks(offsets, limit):
        a, z, skip = int(offsets[lo]), int(offsets[hi]), 0
        while hi == lo + 1 and z - a > limit:
            cut, width = a, limit
            while cut == a and a + width < z:
                gaps = np.flatnonzero(BETWEEN[data[a : a + width]])
                spans = textcore.word_spans(data[a : a + gaps[-1]], np.array([0, gaps[-1]]), BETWEEN) if len(gaps) else None
                # a piece must hold more than what was carried, or it would not end
                if spans is not None and len(spans[0]) > max(skip, features.high):
                    cut = a + int(gaps[-1])
                    begins = spans[0]
                width *= 2
            if cut == a:
                break
            yield lo, hi, a, cut, skip
            carried = features.high - 1
            a, skip = (a + int(begins[-carried]), carried) if carried else (cut, 0)
        yield lo, hi, a, z, skip


def _tables(column: pa.Array, features: Features) -> Iterator[tuple[int, int, SlotTable, np.ndarray, np.ndarray]]:
    """Per piece: its rows, the interned occurrences, the row of each and new words per row."""
    data, offsets = textcore.utf8(column)
    data = textcore.LOWER[data]
    for lo, hi, a, z, skip in _pieces(data, offsets, features):
        off = np.clip(offsets[lo : hi + 1], a, z) - a
        text, start, end, doc, n_words = _occurrences(data[a:z], off, features, skip)
        n_words[0] -= skip
        yield lo, hi, SlotTable(text, start, end, features.buckets), doc, n_words


def _count(features: Features):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(features.buckets, np.int64)
        for b in batches:
            for _, _, table, _, _ in _tables(b.column(0), features):
                total += np.bincount(table.bucket, weights=table.count, minlength=features.buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    return run


def bucket_counts(df: DataFrame, features: Features = Features(), text_col: str = "text") -> np.ndarray:
    """Occurrences per bucket over all texts."""
    common.bound_batches(df.sparkSession)
    parts = df.select(df[text_col].alias("text")).mapInArrow(_count(features), "bucket long, n long")
    out = np.zeros(features.buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the logarithm of how much likelier the target makes
    it, with one occurrence added to each, rounded down."""
    size = len(source)
    s_all, t_all = float(source.sum() + size), float(target.sum() + size)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weigh(features: Features, gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, found, weight = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for lo, hi, table, doc, n_words in _tables(b.column(1), features):
                words[lo:hi] += n_words
                found[lo:hi] += np.bincount(doc, minlength=hi - lo)
                upto = np.concatenate([[0], np.cumsum(gain[table.bucket][table.slot])])
                if features.low == features.high:
                    edge = np.searchsorted(doc, np.arange(hi - lo + 1))
                    weight[lo:hi] += upto[edge[1:]] - upto[edge[:-1]]
                else:
                    np.add.at(weight[lo:hi], doc, np.diff(upto))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x) for x in (words, found, weight))], ["id", "n_words", "n_features", "weight"])

    return run


def noise(doc_id: Column, seed: int) -> Column:
    """A thousand times Gumbel noise drawn by a digest of seed and id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(df: DataFrame, target: DataFrame, percent: int, least_words: int, seed: int, features: Features = Features(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, ``n_features``, ``weight``, ``score`` and ``rank``, which is null for
    those not drawn.  Of the rows with ``least_words``, ``percent`` of a hundred are drawn."""
    gain = gains(bucket_counts(df, features, text_col), bucket_counts(target, features, text_col))
    id_type = df.schema[id_col].dataType.simpleString()
    source = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    weighed = source.mapInArrow(_weigh(features, gain), f"id {id_type}, n_words long, n_features long, weight long")
    # the row's own number spreads rows that are equal in all else over ranges
    scored = common.written(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)).withColumn("row", F.monotonically_increasing_id()), "resampling")
    fit = scored.where(F.col("n_words") >= least_words)
    drawn = percent * fit.count() // 100
    placed = ranking.numbered(fit, F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("row"), name="place")
    ranked = placed.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
