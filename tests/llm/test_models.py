"""Toxicity, decontamination, token counts and the pipeline."""

import bisect
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspan.llm import leaks, tokens, toxicity

SF = "/root/testdata/sf0.001"


def test_gradients_are_right():
    words = toxicity.Training(iter([b"you idiot the cat sat on a mat and more", b"nice day the sun is up"]))
    r = np.random.default_rng(3)
    m = {k: v.astype(np.float64) for k, v in toxicity.new_model().items()}
    y, rows = np.array([1.0, 0.0]), np.arange(2)
    grads = {k: np.zeros_like(v) for k, v in m.items()}
    weight = np.array([0.5, 2.0])
    toxicity._step(m, words, rows, y, weight, grads)

    def loss():
        z = toxicity.window_logits(m, words)
        return np.mean(weight * (np.log1p(np.exp(z)) - y * z))

    for k in m:
        at = np.unravel_index(np.argmax(np.abs(grads[k])), grads[k].shape)
        keep, e = m[k][at], 1e-2
        m[k][at] = keep + e
        up = loss()
        m[k][at] = keep - e
        down = loss()
        m[k][at] = keep
        assert grads[k][at] == pytest.approx((up - down) / 2 / e, abs=2e-4)
    assert r is not None


def test_windows_cover_every_word():
    for n in (0, 1, 23, 24, 25, 36, 37, 100):
        text = " ".join(f"w{i}" for i in range(n)).encode()
        w = toxicity.Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        index = w.index(np.arange(len(w.doc)))
        assert set(index[index < n].tolist()) == set(range(n)) and len(index) >= 1


def labelled(n, seed):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        w = [r.choice("sun moon river stone tree bird cloud wind".split()) for _ in range(r.randrange(5, 80))]
        bad = r.random() < 0.3
        if bad:
            w[r.randrange(len(w))] = r.choice("badword awful" .split()) + r.choice(["", "s", "ly"])
        rows.append((" ".join(w), int(bad)))
    return rows


def test_learns_held_out_texts():
    train, test = labelled(400, 1), labelled(200, 2)
    m = toxicity.train(toxicity.Training(t.encode() for t, _ in train), np.array([y for _, y in train]), epochs=6)
    raw = [t.encode() for t, _ in test]
    s = toxicity.score_texts(m, np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert np.mean((s >= 0.5) == np.array([y for _, y in test])) > 0.95


def test_toxicity_cases(spark):
    m = toxicity.train(toxicity.Training(iter([b"x", b"y"])), np.zeros(2))
    df = spark.createDataFrame([(1, None), (None, ""), (3, "word " * 50_000), (3, "a")], "doc_id long, text string").withColumn("score", F.lit(1))
    got = toxicity.score(df, m).collect()
    assert len(got) == 4 and all(r["predicted"] == 0 and 0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"]: r["held_out"] for r in got} == {i: i is None or zlib.crc32(str(i).encode()) % 5 == 0 for i in (1, None, 3)}
    assert toxicity.score(df.limit(0), m).count() == 0


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        new = [0]
        for j, b in enumerate(y):
            new.append(row[j] + 1 if a == b else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_common_subsequence():
    r = np.random.default_rng(1)
    for _ in range(200):
        x, y = (r.integers(0, 5, r.integers(1, 30)).astype(np.uint64) for _ in range(2))
        assert leaks.common_subsequence(x, y) == lcs(x.tolist(), y.tolist())


def test_leaks_are_found(spark):
    """Copies and light paraphrases planted in invented prose, at any place of a text."""
    r = random.Random(4)
    vocab = ["".join(r.choice(["an", "er", "th", "on", "re", "ti", "en"]) for _ in range(r.randrange(2, 8))) for _ in range(4000)]
    prose = lambda n: [r.choice(vocab[:20] if r.random() < 0.4 else vocab) for _ in range(n)]
    items = [(i, prose(r.randrange(16, 60))) for i in range(30)]
    docs, planted = [], set()
    for d in range(240):
        w = prose(r.randrange(20, 400))
        if d % 4 == 0:
            i, words = r.choice(items)
            words = list(words)
            if d % 8 == 0:
                words[r.randrange(len(words))] = r.choice(vocab)
            at = r.randrange(len(w))
            w[at:at] = words
            planted.add((d, i))
        docs.append((d, " ".join(w)))
    docs += [(1000, None), (1001, ""), (None, "short")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(99, None), (98, "!!")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks.find_leaks(df, bench).collect()}
    assert len(planted & got) >= 0.9 * len(planted) and not got - planted
    assert leaks.find_leaks(df.limit(0), bench).count() == 0 and leaks.find_leaks(df, bench.limit(0)).count() == 0


def test_no_leak_is_lost(spark):
    """What is found is what judge() accepts of all pairs at every place: copies and
    edits of short and long items, at every offset of the block grid."""
    r = random.Random(9)
    vocab = ["".join(r.choice(["an", "er", "th", "on", "re", "ti", "en"]) for _ in range(r.randrange(2, 8))) for _ in range(1500)]
    prose = lambda n: [r.choice(vocab[:20] if r.random() < 0.5 else vocab) for _ in range(n)]
    items = [prose(n) for n in (6, 8, 10, 12, 15, 19, 24, 40)]
    docs = []
    for d in range(96):
        w, words = prose(72 + d % 7 * 12), list(items[d % 8])
        for at in r.sample(range(len(words)), round(len(words) * (0, 0.2, 0.3, 0.4)[d // 24])):
            words[at] = r.choice(vocab)
        w[24 + d % 24 : 24 + d % 24] = words
        docs.append((d, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    space = leaks.fit_space(df)
    held = leaks.prepare_items([(i, " ".join(w), None) for i, w in enumerate(items)], space)
    want = set()
    for d, text in docs:
        h = leaks._words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))[0]
        for k, item in enumerate(held.words):
            size = len(item) + 4 * leaks.BLOCK
            if any(leaks.judge(item, held.answers[k], h[a : a + size])[0] for a in range(len(h))):
                want.add((d, k))
    got = leaks.find_leaks(df, bench, space=space).collect()
    assert len(want) > 60 and {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    answered = spark.createDataFrame([(0, docs[0][1], "..."), (1, docs[1][1], docs[1][1][:20])], "item_id long, text string, answer string")
    found = leaks.find_leaks(df, answered, answer_col="answer", space=space).collect()
    assert {(0, 0), (1, 1)} <= {(r["doc_id"], r["item_id"]) for r in found}


def test_basis_decides_no_leak(spark):
    """A basis that knows nothing of the texts, as of one outside the sample, finds the same."""
    texts = [f"w{i % 7} x{i} y{i * i % 11} " * 4 + " ".join(f"i{i % 3}z{k}" for k in range(18)) for i in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(j, " ".join(f"i{j}z{k}" for k in range(18))) for j in range(3)], "item_id long, text string")
    blind = leaks.Space(np.ones(leaks.FEATURES, np.float32), np.zeros((leaks.FEATURES, leaks.RANK), np.float32))
    for space in (None, blind):
        got = {(r["doc_id"], r["item_id"]) for r in leaks.find_leaks(df, bench, space=space).collect()}
        assert got == {(i, i % 3) for i in range(12)}


P = pytest.importorskip("public_tokenizers")


def library_count(path, text):
    """Tokens of one text by the vocabulary's own library, called here, not by the operator."""
    if path.endswith(".model"):
        import sentencepiece

        return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))
    import tokenizers

    return len(tokenizers.Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


def test_token_query(spark, tmp_path):
    """All columns of the query, against the library; a text at the limit is not over it."""
    from loomspan.llm import registry

    path = P.path("piece_bpe_32k.model")
    n = bisect.bisect_right(range(6000), 4096, key=lambda k: library_count(path, "x," * k))
    longest, over = "x," * (n - 1), "x," * n
    assert 4094 <= library_count(path, longest) <= 4096 < library_count(path, over)
    texts = [None, "", "é hello", longest, over, over]
    spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = registry.QUERIES["op10_token_counts"](spark, str(tmp_path)).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    counts = [library_count(path, t or "") for t in texts]
    want = [(i // 2, len((t or "").encode()), n, n > 4096) for i, (t, n) in enumerate(zip(texts, counts))]
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts_and_cache(spark, tmp_path, name):
    texts = [None, "", "hello world", "hello world", "<s> </s> <unk>", "é \n\t" * 50, "x" * 5000, "<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "null id")], "doc_id long, text string").withColumn("n_bytes", F.lit("z"))
    path, cache = P.path(name), str(tmp_path / "cache")
    got = tokens.token_counts(df, path, cache).collect()
    want = {i: library_count(path, t or "") for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["n_tokens"] for r in got if r["doc_id"] is not None} == want and len(got) == 9
    assert all(r["n_bytes"] == len((texts[r["doc_id"]] or "").encode()) for r in got if r["doc_id"] is not None)
    kept = spark.read.parquet(cache)
    assert kept.count() == len({t or "" for t in texts}) + 1  # each content was encoded once
    again = tokens.token_counts(df.unionByName(df), path, cache)
    assert again.count() == 18 and spark.read.parquet(cache).count() == kept.count()
    assert tokens.token_counts(df.limit(0), path, str(tmp_path / "other")).count() == 0


def test_pipeline_stages(spark):
    """Each stage drops what its operator names, from all that the one before kept."""
    import corpus_pipeline as cp

    from loomspan.llm import common, shingles

    docs = spark.read.parquet(os.path.join(SF, "documents.parquet"))
    columns, before = docs.columns, docs
    for name, stage in cp.STAGES:
        after = common.written(stage(spark, before, SF), f"test-{name}")
        ids = {r[0] for r in after.select("doc_id").collect()}
        had = {r[0] for r in before.select("doc_id").collect()}
        assert ids <= had
        if name == "mixing":
            assert ids == had
            break
        assert after.columns == columns
        if name == "line_dedup":
            assert ids == had
        if name == "near_duplicates":
            groups = shingles.near_duplicates(before).collect()
            assert ids == {r["doc_id"] for r in groups if r["component_id"] == r["doc_id"]}
        if name == "decontamination":
            bench = spark.read.parquet(os.path.join(SF, "benchmark.parquet")).collect()
            text = {r["doc_id"]: r["text"] for r in before.collect()}
            exact = {i for i, t in text.items() if any(b["text"] in t for b in bench)}
            assert not exact & ids
        before = after


def test_power_step_in_slices_gives_the_same_space(spark, monkeypatch):
    """The slices that bound the fit's memory change no direction of the basis."""
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + j * j) % 50}" for j in range(60))) for i in range(40)], "doc_id long, text string")
    whole = leaks.fit_space(docs, rank=4)
    monkeypatch.setattr(leaks, "FIT_WORDS", 100)
    sliced = leaks.fit_space(docs, rank=4)
    assert np.allclose(whole.table @ whole.table.T, sliced.table @ sliced.table.T, rtol=1e-2, atol=1e-4)
