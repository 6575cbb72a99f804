"""The streaming transducer and the decoder against the tokenizer's own library."""

import hashlib
import json
import random
import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomspan.llm import bpe
from loomspan.llm.registry import QUERIES

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = P.path("byte_bpe_50k.json")
LIBRARY, VOCABULARY = tokenizers.Tokenizer.from_file(PATH), bpe.Vocabulary.load(PATH)
DDL = "doc_id long, text string, ids string, block string"
TEXTS = [
    None, "", " ", "  \n", "It's  don't 'S 're''s 'll2 x'ved", "a<|endoftext|>b  <|endoftext|> <|endoftex <|endoftext|><|endoftext|>", "naïve café ١٢٣ Ⅷ 東京都 😀👍🏽   x", "\x1c\x1d tab\tend\r\n\r\n  x",
    "x" * 9000, " " * 9001 + "a", " " * 9001, "\n" * 5000 + "b " * 10, "東京" * 4000 + "a1" * 3000, "12" * 6000 + "...." * 3000, "the " * 3000, "Ᲊ\U00010940꟎՘",
]


@pytest.fixture
def library():
    return LIBRARY


@pytest.fixture
def vocabulary():
    return VOCABULARY


def fed(v, text, r):
    e, out = bpe.Encoder(v), []
    while text:
        n = r.choice((1, 2, 3, 7, 100, 5000))
        out += e.feed(text[:n]).tolist()
        text = text[n:]
    return out + e.finish().tolist()


@pytest.mark.parametrize("k", range(len(TEXTS)))
def test_any_chunks_give_the_library_ids(library, vocabulary, k):
    text, r = TEXTS[k] or "", random.Random(k)
    want = library.encode(text, add_special_tokens=False).ids
    for _ in range(4):
        assert fed(vocabulary, text, r) == want
    d = bpe.Decoder(vocabulary)
    assert "".join(d.feed([i]) for i in want) + d.finish() == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n'strel<|endoftext|>aeé1")), max_size=60), st.integers(0, 9))
def test_texts_of_all_characters(text, seed):
    assert fed(VOCABULARY, text, random.Random(seed)) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_every_character_has_the_library_class(library, vocabulary):
    asked, plain = bpe._patterns(*vocabulary.classes())[1], bpe._patterns(r"\p{L}", r"\p{N}")[1]
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for kind, before in (("letters", "a"), ("numbers", "1")):
        # one long text: each character behind one that its kind goes with
        text = "".join(f"{before}{c}\n" for c in every if c not in "\n\r" and not c.isspace())
        starts = {a for _, (a, _) in library.pre_tokenizer.pre_tokenize_str(text)}
        at = 0
        for c in (c for c in every if c not in "\n\r" and not c.isspace()):
            assert (asked[kind].match(c).end() == 1) == (at + 1 not in starts), hex(ord(c))
            at += 3
    written = bpe._settled()[1]
    for c in every:
        if c < bpe.SETTLED:
            assert all(len({bool(p[k].match(c).end()) for p in (plain, asked, written)}) == 1 for k in plain), hex(ord(c))


def small_vocabulary(r):
    """A random proper merge list over four letters."""
    chars = bpe.byte_characters()
    tokens, merges = list("abcd"), []
    while len(merges) < 25:
        a, b = r.choice(tokens), r.choice(tokens)
        if a + b not in tokens and len(a + b) < 12:
            tokens.append(a + b)
            merges.append([a, b])
    vocab = {c: i for i, c in enumerate(chars)} | {a + b: 256 + i for i, (a, b) in enumerate(merges)}
    return bpe.Vocabulary({"model": {"type": "BPE", "vocab": vocab, "merges": merges}, "pre_tokenizer": {"type": "ByteLevel"}})


def merged_by_phases(text, v):
    """Rule after rule, left to right."""
    ids = [v.byte_id[b] for b in text]
    for (a, b), (_, both) in sorted(v.rules.items(), key=lambda x: x[1][0]):
        out, i = [], 0
        while i < len(ids):
            hit = ids[i : i + 2] == [a, b]
            out.append(both if hit else ids[i])
            i += 2 if hit else 1
        ids = out
    return ids


def test_lookahead_suffices_and_merging_is_by_phases(vocabulary):
    assert vocabulary.lookahead == 320
    r = random.Random(3)
    for _ in range(60):
        v = small_vocabulary(r)
        for _ in range(20):
            text = bytes(r.choices(b"abcd", k=r.randrange(1, 90)))
            more = text + bytes(r.choices(b"abcd", k=r.randrange(1, 30)))
            one, two = bpe.merge(text, v), bpe.merge(more, v)
            assert one == merged_by_phases(text, v)
            end, fixed = 0, 0
            for t in one:
                end += len(v.bytes[t])
                fixed += end <= len(text) - v.lookahead
            assert one[:fixed] == two[:fixed]
            t = bpe.Transducer(v)
            t.window = v.lookahead + 12
            assert [x for b in more for x in t.feed(bytes([b]))] + t.finish() == two


def test_memory_does_not_grow_with_the_text(vocabulary):
    def peak(n):
        e = bpe.Encoder(vocabulary)
        tracemalloc.start()
        for _ in range(n):
            e.feed("abcdefghij" * 100)
        e.finish()
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return top

    assert peak(400) < 1.5 * peak(60)


def test_decoder_equals_library_on_broken_text(library, vocabulary):
    r = random.Random(5)
    for _ in range(300):
        ids = [r.randrange(50257) if r.random() < 0.3 else r.randrange(256) for _ in range(r.randrange(20))]
        d = bpe.Decoder(vocabulary)
        assert "".join(d.feed([i]) for i in ids) + d.finish() == library.decode(ids, skip_special_tokens=False)


def test_other_tokenizers_are_refused():
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(bpe.UnsupportedTokenizer):
        bpe.Vocabulary(json.load(f))


def test_rows_of_any_kind(spark, library, monkeypatch):
    rows = [(i % 5 if i % 4 else None, t, "x", None) for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, DDL)
    out = bpe.digests(bpe.decode(bpe.encode(df, PATH), PATH)).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
    blocks = bpe.encode(df, PATH).where("doc_id is not null").collect()
    assert max(len(b["ids"]) for b in blocks) == bpe.BLOCK and {b["last"] for b in blocks} == {True, False}
    assert bpe.digests(bpe.decode(bpe.encode(df.limit(0), PATH), PATH)).count() == 0


def test_query_equals_library(spark, library):
    from helpers import DATA

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, QUERIES["op12_bpe"](spark, DATA).collect())) == sorted(want)
