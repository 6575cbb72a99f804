"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers import DATA, duck, rows_of, rows_of_sql
from hypothesis import given, settings
from hypothesis import strategies as st

from loomspan.llm import resampling, textcore
from loomspan.llm.registry import QUERIES
from loomspan.llm.resampling import Features
from loomspan.llm.sql import ORACLES

DDL = "doc_id long, text string, rank string, score string"
TEXTS = [None, "", " \t--", "ABC abc Äbc äbc", "x" * 40 + " " + "x" * 41, "a b c " * 9, "é١ x7 x-7", "word " * 25, "word " * 25, "z" * 5000 + " y"]


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def runs(text, low, high):
    w = words_of(text)
    return [" ".join(w[i : i + n]) for n in range(low, high + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent, least, seed, f):
    bucket = lambda x: zlib.crc32(x.encode()) % f.buckets
    s, t = (Counter(bucket(x) for text in texts for x in runs(text, f.low, f.high)) for texts in ([x for _, x in docs], target))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + f.buckets) / ((s[b] + 1) * (t.total() + f.buckets))))
    rows = []
    for i, text in docs:
        found = runs(text, f.low, f.high)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(x)) for x in found)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text))])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], math.inf if r[0] is None else r[0], r[1]))
    for place, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def got(spark, docs, target, *args):
    df = spark.createDataFrame([(*d, "r", "s") for d in docs], DDL)
    out = resampling.resample(df, spark.createDataFrame([(x,) for x in target], "text string"), *args)
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in out.collect()), key=repr)


def corpus(n=120):
    r = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "Ünit", "a-b", "x" * 50]
    made = [" ".join(r.choices(vocabulary, k=r.randrange(60))) for _ in range(n)]
    ids = [None if r.random() < 0.05 else r.randrange(80) for _ in range(n + len(TEXTS))]
    return list(zip(ids, TEXTS + made)) + [(3, made[0]), (3, made[0]), (None, made[1])]


@pytest.mark.parametrize("f", [Features(), Features(1, 3, 64), Features(2, 2, 1000)])
@pytest.mark.parametrize("chunk", [64, 1 << 20])
def test_equals_plain_version(spark, monkeypatch, f, chunk):
    monkeypatch.setattr(textcore, "CHUNK_BYTES", chunk)
    docs, target = corpus(), ["w1 w2 w3 W4", None, "", "é é x7 " * 5]
    assert got(spark, docs, target, 40, 20, 5, f) == brute(docs, target, 40, 20, 5, f)


def test_pieces_of_a_long_text(monkeypatch):
    """In this process, as a worker does not see a changed chunk size."""
    text = "alpha beta  " * 40 + "x" * 300 + " gamma " * 30 + "-" * 200 + "end of it"
    for chunk in (16, 50, 333, 1 << 20):
        monkeypatch.setattr(textcore, "CHUNK_BYTES", chunk)
        for f in (Features(), Features(1, 3, 97), Features(3, 3, 97)):
            import pyarrow as pa

            (b,) = resampling._count(f)(iter([pa.RecordBatch.from_arrays([pa.array([text, "a b c d", None])], ["text"])]))
            want = Counter(zlib.crc32(x.encode()) % f.buckets for t in (text, "a b c d") for x in runs(t, f.low, f.high))
            assert dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())) == dict(want)


def test_empty_tables_and_equal_rows(spark):
    assert got(spark, [], [], 10, 0, 1) == []
    many = [(1, "same text here")] * 50 + [(None, None)] * 5
    rows = got(spark, many, [], 50, 0, 1)
    assert sorted(r[4] for r in rows if r[4]) == list(range(1, 28)) and rows == brute(many, [], 50, 0, 1, Features())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=70), max_size=40))
def test_hash_is_xxhash64_and_slots_are_distinct(spans):
    data = np.frombuffer(b"".join(spans), np.uint8)
    end = np.cumsum([len(x) for x in spans]).astype(np.int64)
    start = end - np.array([len(x) for x in spans], np.int64)
    assert resampling.xxh64(data, start, end).tolist() == [xxhash.xxh64_intdigest(x) for x in spans]
    # one hash for all: only the bytes tell spans apart
    for keys in (None, np.full(len(spans), 7, np.uint64)):
        table = resampling.SlotTable(data, start, end, 1000, keys)
        assert len(set(table.slot.tolist())) == len(set(spans)) == len(set(zip(table.slot.tolist(), spans)))
        assert all(table.count[s] == spans.count(b) and table.bucket[s] == zlib.crc32(b) % 1000 for s, b in zip(table.slot.tolist(), spans))


def test_query_equals_sql(spark):
    assert rows_of(QUERIES["op11_resampling"](spark, DATA)) == rows_of_sql(duck(), ORACLES["op11_resampling"])
