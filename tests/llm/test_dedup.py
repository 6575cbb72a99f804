"""Line, substring and shingle dedup against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomspan.llm import components, lines, shingles, substrings, suffixes

DDL = "doc_id long, text string"


def corpus(seed, n=60):
    """Texts with copies, edits, shared passages, repeats, nulls and ties."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcé") for _ in range(r.randrange(1, 4)))
    passage = " ".join(word() for _ in range(30))
    texts = [None, "", " ", "a", "a b", "A B", "a b c d e", "x" * 49, "x" * 120]
    base = []
    for _ in range(n):
        kind = r.random()
        if kind < 0.3 and base:
            w = r.choice(base).split(" ")
            for _ in range(r.randrange(3)):
                i = r.randrange(len(w))
                w[i : i + 1] = r.choice([[], [word()], [w[i], word()]])
            t = " ".join(w)
        elif kind < 0.45:
            t = word() + " " + passage + "\n" + " ".join(word() for _ in range(r.randrange(20)))
        else:
            t = "".join(word() + r.choice([" ", " ", " ", " ", "\n"]) for _ in range(r.randrange(5, 90)))
        base.append(t)
        texts.append(t)
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL).withColumn("id", F.lit("x")).withColumn("h", F.lit(1)).repartition(3)


def test_shared_anchors_are_told_per_block_not_per_document():
    """A part gives a row a block, however many documents share its anchors."""
    names = [np.array([(i + b, 7) for i in range(0, 200, 2)], np.int64) for b in (0, 1)]
    at = np.arange(100, dtype=np.uint32)
    marks = np.arange(100, dtype=np.uint32)
    row = lambda part, block, docs, at, m: {"part": part, "block": block, "docs": docs.tobytes(), "places": at.tobytes(), "marks": m.tobytes()}
    told = substrings._shared_anchors(pa.Table.from_pylist([row(3, 10, names[0], at, marks), row(3, 11, names[1], at, marks + 1)]))
    assert told.num_rows == 2
    mine = substrings._of_block(told.slice(0, 1))
    whole = lambda m: (m << 32) | 3
    assert {(i, k): np.frombuffer(m, np.uint64).tolist() for i, k, m in zip(*(mine.column(c).to_pylist() for c in ("id", "key", "marks")))} == {(2 * i, 7): [whole(i)] for i in range(1, 100)}


def test_suffix_array_is_sorted():
    r = np.random.default_rng(1)
    for _ in range(300):
        s = r.integers(97, 97 + r.integers(1, 4), r.integers(0, 60)).astype(np.uint8)
        b = bytes(s)
        assert suffixes.suffix_array(s, 1000).tolist() == sorted(range(len(b)), key=lambda i: b[i:])


def cut(rows):
    out, first = {}, {}
    data = {k: (i, (t or "").encode()) for k, (i, t) in enumerate(rows)}
    for i, b in data.values():
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            first[w] = min(first.get(w, i), i)
    for k, (i, b) in data.items():
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\x01" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[k] = (i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(out.values())


@pytest.mark.parametrize("seed,crowded", [(1, False), (2, True)])
def test_substrings(spark, seed, crowded, monkeypatch):
    if crowded:
        monkeypatch.setattr(substrings, "MAX_RUNS", 2)
    rows = corpus(seed)
    rows.append((70, rows[-1][1]))  # a copy with a larger id
    rows.append((70, rows[20][1]))  # an id used twice
    got = substrings.remove_repeats(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == cut(rows)


def test_substrings_of_nothing(spark):
    assert substrings.remove_repeats(spark.createDataFrame([], DDL)).count() == 0
    got = substrings.remove_repeats(spark.createDataFrame([(None, "y" * 60), (3, "y" * 60)], DDL), with_text=True).collect()
    assert sorted(((r["doc_id"] is None), r["n_removed"], len(r["kept"])) for r in got) == [(False, 0, 60), (True, 60, 0)]


def groups(rows):
    def shingle(t):
        w = [x for x in lines.split_words("".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "").replace("\n", " "))) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = {i: shingle(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted((i, len(sets[i]), find(i)) for i in sets)


@pytest.mark.parametrize("seed,hot,block", [(3, 64, 1024), (4, 2, 3)])
def test_near_duplicates(spark, seed, hot, block, monkeypatch):
    monkeypatch.setattr(shingles, "HOT", hot)
    monkeypatch.setattr(shingles, "BLOCK", block)
    rows = corpus(seed, 90)
    got = shingles.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == groups(rows)


def test_near_duplicates_of_nothing(spark):
    assert shingles.near_duplicates(spark.createDataFrame([], DDL)).count() == 0
    got = shingles.near_duplicates(spark.createDataFrame([(None, "a b"), (None, None), (5, "a b")], DDL)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 1, 5), (None, 0, None), (5, 1, 5)], key=str)


def test_count_vectors_bound_the_overlap():
    r = np.random.default_rng(5)
    for _ in range(200):
        every = r.integers(0, 1 << 63, 400).astype(np.uint64)
        a, b = (np.unique(r.choice(every, r.integers(1, 300))) for _ in range(2))
        v, w = shingles.count_vector(a), shingles.count_vector(b)
        g = min(len(v), len(w))
        assert np.minimum(shingles.fold_vector(v, g), shingles.fold_vector(w, g)).sum() >= len(np.intersect1d(a, b))


def test_rtree_finds_all():
    r = np.random.default_rng(6)
    sets = [np.unique(r.integers(0, 260, 200)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(80)]
    n = np.array([len(s) for s in sets])
    points = np.stack([shingles.fold_vector(shingles.count_vector(s), 128) for s in sets])
    q, row = shingles.RTree(points, n).search(points, n)
    found = set(zip(q.tolist(), row.tolist()))
    for i in range(80):
        for j in range(80):
            if 7 * len(np.intersect1d(sets[i], sets[j])) >= 3 * (n[i] + n[j]):
                assert (i, j) in found


def test_nearest_pairs_first_then_all():
    r = np.random.default_rng(8)
    base = r.integers(0, 1 << 63, 120).astype(np.uint64)
    sets = [np.unique(np.concatenate([r.choice(base, 112, replace=False), r.integers(0, 1 << 63, 8).astype(np.uint64)])) for _ in range(60)]
    k, n = np.arange(60), [len(s) for s in sets]
    zeros = pa.array(np.zeros(60, np.int32))
    table = pa.table({"cls": pa.array(k), "n": pa.array(n, pa.int32()), "comp": pa.array(k), "block": zeros, "piece": zeros})
    vectors = pa.table({"vcls": pa.array(k), "vec": pa.array([shingles.count_vector(s).tobytes() for s in sets], pa.binary())})
    near, every = (set(zip(*shingles._rtree_join(table, vectors, first).to_pydict().values())) for first in (True, False))
    linked = {(i, j) for i in range(60) for j in range(i) if 7 * len(np.intersect1d(sets[i], sets[j])) >= 3 * (n[i] + n[j])}
    assert {(j, i) for i, j in linked} <= every
    assert near < every and len(near) <= 60 * shingles.NEAREST
    assert {i for p in near for i in p} == {i for p in every for i in p}


def test_compatible_sets_keep_every_link():
    """A pair that links is compatible at the first shingle that both have."""
    r = np.random.default_rng(11)
    linked = 0
    for _ in range(400):
        n = int(r.integers(1, 80))
        base = r.permutation(400)[:n]
        other = np.unique(np.concatenate([base[r.random(n) < r.uniform(0.7, 1)], r.integers(400, 800, r.integers(0, 1 + n // 4))]))
        order = r.permutation(800)
        a, b = (sorted(set(x.tolist()), key=lambda i: order[i]) for x in (base, other))
        both = set(a) & set(b)
        if both and 7 * len(both) >= 3 * (len(a) + len(b)):
            first = min(both, key=lambda i: order[i])
            assert shingles.compatible(np.array([len(a), len(b)]), np.array([a.index(first), b.index(first)]))[0, 1]
            linked += 1
    assert linked > 100


def pivots(rows):
    h, cls, n, place = (np.array(c, np.int64) for c in zip(*rows))
    batch = pa.RecordBatch.from_arrays([pa.array(h), pa.array(cls), pa.array((n << 32) + place)], ["h", "cls", "at"])
    return [r for b in shingles._pair_with_pivots(iter([batch])) for r in zip(*b.to_pydict().values())]


def test_a_shared_passage_makes_no_bucket():
    """Sets of one size that meet late in their prefixes share too little to link; a
    bucket of two groups that do is two, and only the one with a pair beside the pivot's goes on."""
    assert pivots([(7, c, 100, 20) for c in range(50)]) == []
    got = pivots([(7, 1, 100, 3), (7, 2, 1000, 5), (7, 3, 101, 2), (7, 4, 1001, 9), (7, 5, 102, 0), (7, 6, 500, 1)])
    assert {r[1:] for r in got if r[0] is None} == {(4, 1001, 2)}
    assert {r[1:] for r in got if r[0] is not None} == {(1, 100, 1), (3, 101, 1), (5, 102, 1)}
    assert len({r[0] for r in got}) == 2


def test_a_search_leaves_out_its_own_component():
    r = np.random.default_rng(12)
    base = r.integers(0, 1 << 63, 120).astype(np.uint64)
    sets = [np.unique(np.concatenate([r.choice(base, 112, replace=False), r.integers(0, 1 << 63, 8).astype(np.uint64)])) for _ in range(60)]
    n, comp = np.array([len(s) for s in sets]), np.where(np.arange(60) < 40, 5, np.arange(60))
    points = np.stack([shingles.count_vector(s) for s in sets])
    every = set(zip(*(x.tolist() for x in shingles.RTree(points, n).search(points, n))))
    got = set(zip(*(x.tolist() for x in shingles.RTree(points, n, comp).search(points, n, comp))))
    assert got == {(i, j) for i, j in every if comp[i] != comp[j]}


def test_blocks_of_one_component_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(shingles, "BLOCK", 4)
    rows = [(1, c, 50, 0 if c < 40 else c, 0) for c in range(48)]
    got = shingles._pieces(spark.createDataFrame(rows, "h long, cls long, n int, comp long, c1 long")).collect()
    meet = {}
    for r in got:
        meet.setdefault(r["piece"], set()).add(r["cls"])
    pairs = {(a, b) for g in meet.values() for a in g for b in g if a < b}
    assert {(a, b) for a in range(48) for b in range(max(a + 1, 40), 48)} <= pairs
    assert len(got) < 48 * 6  # 12 blocks, all pairs of which are 48 * 12 rows


def test_near_duplicates_of_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(shingles, "HOT", 2)
    monkeypatch.setattr(shingles, "BLOCK", 16)
    r = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(80):
        words = list(base)
        for _ in range(r.randint(0, 3)):
            words[r.randrange(60)] = f"x{r.randrange(1000)}"
        rows.append((i, " ".join(words)))
    got = shingles.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == groups(rows)


def test_components(spark):
    links = [(5, 4), (4, 3), (3, 2), (9, 8), (7, 9), (1, 1)] + [(i, i + 1) for i in range(20, 45)]
    got = {r["node"]: r["root"] for r in components.connected(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {2: 2, 3: 2, 4: 2, 5: 2, 7: 7, 8: 7, 9: 7} | {i: 20 for i in range(20, 46)}
    assert components.connected(spark.createDataFrame([], "u long, v long")).count() == 0


def edits(x, y):
    """Word edit distance by the full table; more than one reads as two."""
    if abs(len(x) - len(y)) > 1:
        return 2
    row = list(range(len(y) + 1))
    for i, a in enumerate(x):
        new = [i + 1]
        for j, b in enumerate(y):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row[-1], 2)


def kept_lines(rows):
    """Direct: a line goes if any earlier line is within the bound."""
    places = sorted((i, k, lines.split_words(x)) for i, t in rows for k, x in enumerate((t or "").split("\n")))
    before, gone = [], set()
    for i, k, w in places:
        if not w:
            continue
        if any(edits(w, v) * 4 <= max(len(w), len(v)) * (edits(w, v) < 2) for v in before):
            gone.add((i, k))
        before.append(w)
    return {i: "\n".join(x for k, x in enumerate((t or "").split("\n")) if (i, k) not in gone) for i, t in rows}


def test_lines(spark):
    rows = corpus(7) + [(100, "one two three four five six seven eight\nzero"), (101, "one two three four six seven eight nine\none two three four five six seven EIGHT\none two three five six seven eight nine"), (102, "zero\nzero"), (103, "one two three four five six seven eight ten")]
    got = lines.dedup_lines(frame(spark, rows)).collect()
    want = kept_lines(rows)
    assert {r["doc_id"]: r["kept"] for r in got} == want
    dropped = {r["doc_id"]: r["text"] for r in lines.drop_lines(frame(spark, rows)).collect()}
    assert {i: t or "" for i, t in dropped.items()} == want and dropped[0] is None
    assert lines.dedup_lines(spark.createDataFrame([], DDL)).count() == 0


def test_within_one_word():
    w = str.split
    assert lines.within_one_word(w("a b c"), w("a b c")) and lines.within_one_word(w("a b"), w("a x b")) and lines.within_one_word(w("a b c"), w("a x c"))
    assert not lines.within_one_word(w("a b c"), w("b c d")) and not lines.within_one_word(w("a"), w("a b c"))
