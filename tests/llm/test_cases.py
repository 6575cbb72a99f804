"""Cases that were wrong once: shared ids, equal rows, hostile words, long texts, no broadcasts."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dedup import DDL, corpus, cut, frame, groups, kept_lines

from loomspan.llm import common, lines, shingles, substrings, textcore, tokens, toxicity


def thue_morse(n, swap=False):
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


def test_hostile_words_have_different_hashes():
    a, b = (np.frombuffer(thue_morse(4096, s).encode(), np.uint8) for s in (False, True))
    zero = np.zeros(1, np.int64)
    for n in (16, 100, 4096):
        assert textcore.hash_spans(a, zero, zero + n)[0] != textcore.hash_spans(b, zero, zero + n)[0]
    w = np.array([3, 5], np.uint64)
    x, y = (w[[(bin(i).count("1") + s) % 2 for i in range(4096)]] for s in (0, 1))
    sums = [textcore.Sums(v, np.arange(4096)) for v in (x, y)]
    assert len({int(textcore.Sums.packed(s.raw(zero, zero + 4096), zero + 4096)[0]) for s in sums}) == 2


def test_documents_of_hostile_words_do_not_link(spark):
    rows = [(1, thue_morse(2048)), (2, thue_morse(2048, True))]
    assert {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(spark.createDataFrame(rows, DDL)).collect()} == {1: 1, 2: 2}


def test_rows_of_one_id_are_cut_apart(spark):
    shared = "a passage that is longer than fifty bytes and stands in two rows of it"
    rows = [(1, shared), (5, "x " + shared + " with the passage"), (5, "quite another text, without any of it, of more than fifty bytes"), (None, shared + "!"), (None, "nothing in common, but long enough to be looked at by it all")]
    got = substrings.remove_repeats(spark.createDataFrame(rows, DDL)).collect()
    want = cut([((1 << 62) if i is None else i, t) for i, t in rows])
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(x[1:] for x in want)


def test_equal_rows_keep_their_lines_once(spark):
    rows = [(4, "alpha beta\n\ngamma"), (4, "alpha beta\n\ngamma"), (4, "alpha beta\n\ngamma"), (None, "delta"), (None, "delta"), (None, None), (None, None)]
    got = lines.dedup_lines(frame(spark, rows)).collect()
    # a line feed before and after the blank line stays with what has no words
    assert sorted(r["kept"] for r in got) == sorted(["alpha beta\n\ngamma", "", "", "delta", "", "", ""])


def test_equal_rows_are_encoded_once(spark, tmp_path):
    P = pytest.importorskip("public_tokenizers")
    sentencepiece = pytest.importorskip("sentencepiece")
    path = P.path("piece_bpe_32k.model")
    texts = ["same text", "same text", "same text", "other", None, "<s> é"]
    df = spark.createDataFrame([(3, t) for t in texts], DDL)
    got = sorted(r["n_tokens"] for r in tokens.token_counts(df, path, str(tmp_path / "c")).collect())
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    assert got == sorted(len(model.encode(t or "")) for t in texts)
    assert spark.read.parquet(str(tmp_path / "c")).count() == 4


@pytest.mark.parametrize("limit", [64, 1 << 20])
def test_short_chunks_and_no_broadcasts(spark, monkeypatch, limit):
    """Texts cut into tiny pieces, blocks of few documents, and every join shuffled."""
    rows = corpus(11, 70)
    got = {}
    if limit == 64:
        monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(substrings, "BLOCK_DOCS", 5)
    data = [(t or "").encode() for _, t in rows]
    off = np.cumsum([0, *map(len, data)])
    raw = np.frombuffer(b"".join(data), np.uint8)
    found = set()
    for lo, hi, a, z in textcore.pieces(off, 49, limit):
        doc, first, last, anchor = substrings.anchor_runs(raw[a:z], np.clip(off[lo : hi + 1], a, z) - a)
        for d, f, e, h in zip(doc, first, last, anchor):
            found |= {(lo + int(d), int(a + p), int(h)) for p in range(f, e + 1)}
    assert {(d, p) for d, p, _ in found} == {(d, p) for d in range(len(data)) for p in range(off[d], off[d + 1] - 49)}
    if limit == 64:
        got = substrings.remove_repeats(frame(spark, rows)).collect()
        assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == cut(rows)
        near = shingles.near_duplicates(frame(spark, rows)).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near) == groups(rows)
        assert {r["doc_id"]: r["kept"] for r in lines.dedup_lines(frame(spark, rows)).collect()} == kept_lines(rows)


def test_one_row_of_each_group_stays(spark):
    t = "one two three four five six seven"
    rows = [(2, t), (2, t), (2, t.upper()), (1, t + " "), (None, "all alone here"), (None, "all alone here"), (None, None), (None, None)]
    got = shingles.drop_near_duplicates(frame(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted([(1, t + " "), (None, "all alone here"), (None, None), (None, None)], key=str)


def test_held_out_labels_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} and other{i % 3} text") for i in range(80)], DDL)
    mark = lambda i, flip: int(i % 7 == 0) ^ (flip and zlib.crc32(str(i).encode()) % 5 == 0)
    models = [toxicity.fit(docs, spark.createDataFrame([(i, mark(i, flip)) for i in range(80)], "doc_id long, toxic int")) for flip in (False, True)]
    assert all(np.array_equal(models[0][k], models[1][k]) for k in models[0])


def test_nothing_to_learn_from(spark):
    m = toxicity.fit(spark.createDataFrame([], DDL), spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(spark.createDataFrame([(1, "x")], DDL), m).first()["predicted"] == 0


def test_long_texts_in_bounded_memory():
    """The windows of a long text are scored a few at a time, and score as the parts do."""
    m = toxicity.new_model()
    part = " ".join(f"w{i % 97}" for i in range(24 * 50)).encode()
    text = part * 40
    s = toxicity.score_texts(m, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert 0 <= s[0] <= 1 and F is not None
