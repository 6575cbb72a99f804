"""Byte-level BPE as a streaming transducer, and decoding as a state machine.

A merge list has a *sufficient lookahead*: a number of bytes such that what follows a
text can change none of its tokens that end so many bytes before its end.  So a token
is written out as soon as it ends that far back, and memory is bounded by the merge list
and not by the text, however long the text or a word in it.

Why there is such a number: let merging go by phases, one rule after the other, over a
text and over the same text with more behind it.  Both are cut alike up to some place,
at first the shorter one's end.  A phase moves that place only by merging across it, in
one of the two, a left part that ends there and a right part that begins there; then the
place moves to the left part's beginning.  The next rule to move it is a later one, and
its right part begins with the former's left part, as the first of the parts it was made
of.  So moves follow a chain of rules in rising order, in which each one's left part is
among the leading parts of the next one's right part, and the place moves no further
than the lengths of the chain's left parts.  ``lookahead`` takes the longest chain, in
one pass over the list.  (For the vocabulary of the query it is 320 bytes.)

Before merging, text is cut in pieces by a pattern.  It is cut as text arrives as well:
a match that ends three characters before the end of what is there is final, and of an
open run of letters, digits, other characters or white space, which can have any length,
all but the last character is passed on to the transducer.

Decoding keeps at most three bytes: those of a character that isn't complete.  Invalid
bytes become U+FFFD, one for each maximal part.

Defined results: null and empty texts have no tokens, and one empty block; bytes of a
text that are not UTF-8 read as U+FFFD; strings of special tokens in a text are those
tokens; rows are encoded one by one, so repeated rows and ids are kept; other columns
are ignored; an empty table gives an empty result; ids to decode that are not in the
vocabulary give nothing.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from loomspan.llm import common, textcore

#: Ids in a block.
BLOCK = 4096
#: Characters fed to the transducer at once.
CHUNK = 1 << 16
#: Characters of an open piece beyond which it is passed on as it comes.
OPEN_CHARS = 4096
#: Bytes that are merged together, as a multiple of the lookahead.
WINDOWS = 8
#: Pieces whose tokens are remembered, and tokens of all of them.
REMEMBERED, REMEMBERED_IDS = 1 << 17, 1 << 20
#: Bytes of a piece up to which pieces are merged together.
SHORT = 64
#: Ids whose bytes or digits are put together at once.
TOGETHER = 1 << 17
#: Up to here all versions of Unicode agree on letters and numbers.
SETTLED = "԰"

#: Characters on which a match of the pattern may depend behind its end.
_BEHIND = 3


def ragged(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat``, one after the other."""
    upto = np.cumsum(size)
    shift = np.repeat(start - upto + size, size)
    return flat[np.arange(len(shift)) + shift]


class Strings:
    """Byte strings by number, in one array."""

    def __init__(self, of: dict[int, bytes]):
        self.size = np.zeros(max(of, default=-1) + 2, np.int64)
        for i, b in of.items():
            self.size[i] = len(b)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(of[i] for i in sorted(of)), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The strings of ``ids`` and each one's length; others than known ones are empty."""
        known = np.where((ids >= 0) & (ids < len(self.size)), ids, len(self.size) - 1)
        return ragged(self.flat, self.start[known], self.size[known]), self.size[known]


class UnsupportedTokenizer(ValueError):
    """A vocabulary file that isn't plain byte-level BPE."""


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    ones of Latin-1 for themselves, the others in order from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Merge rules, ids and bytes of tokens, special tokens and the lookahead."""

    def __init__(self, spec: dict):
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise UnsupportedTokenizer("not plain byte-level BPE with the usual pattern")
        of_char = {c: bytes([b]) for b, c in enumerate(byte_characters())}
        raw = lambda token: b"".join(map(of_char.__getitem__, token))
        ids = model["vocab"]
        self.bytes: dict[int, bytes] = {i: raw(t) for t, i in ids.items()}
        self.byte_id = [ids[c] for c in byte_characters()]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        #: (left, right) -> (rank, id of both)
        self.rules = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.lookahead = lookahead(self.rules, self.byte_id, self.bytes)
        self.longest = max(map(len, self.bytes.values()))
        self.special: dict[str, int] = {}
        for t in spec.get("added_tokens", []):
            if any(t.get(k) for k in ("single_word", "lstrip", "rstrip")):
                raise UnsupportedTokenizer(f"added token {t['content']!r} takes its surroundings")
            self.special[t["content"]] = t["id"]
            self.bytes[t["id"]] = t["content"].encode()
        self.strings = Strings(self.bytes)
        self.no_rank = len(self.rules)
        self._width = max(self.bytes) + 1
        pairs = sorted((a * self._width + b, rank, both) for (a, b), (rank, both) in self.rules.items())
        self._pairs, self._ranks, self._both = (np.array(x, np.int64) for x in (zip(*pairs) if pairs else ((), (), ())))
        names = sorted(self.special)
        if any(b.startswith(a) for a, b in zip(names, names[1:])):
            raise UnsupportedTokenizer("one added token begins another")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs, ``no_rank`` where no rule merges them, and what they merge to."""
        if not len(self._pairs):
            return np.full(len(left), self.no_rank), np.zeros(len(left), np.int64)
        key = left * self._width + right
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        found = self._pairs[at] == key
        return np.where(found, self._ranks[at], self.no_rank), self._both[at]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            out = cls(json.load(f))
        out.classes = lambda: _classes(path)
        return out

    def classes(self) -> tuple[str, str]:
        """What letters and numbers are, as a set of the pattern's syntax."""
        return r"\p{L}", r"\p{N}"


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary.load(path)


def lookahead(rules: dict[tuple[int, int], tuple[int, int]], byte_ids: Iterable[int], of: dict[int, bytes]) -> int:
    """The sufficient lookahead of a merge list, in bytes."""
    leading: dict[int, int] = {}
    made, longest, most = set(byte_ids), {}, 0
    for (left, right), (_, both) in sorted(rules.items(), key=lambda r: r[1][0]):
        if left not in made or right not in made or both in made:
            raise UnsupportedTokenizer("a rule merges what no earlier one makes, or makes a token again")
        made.add(both)
        part, before = right, 0
        while part is not None:
            before, part = max(before, longest.get(part, 0)), leading.get(part)
        leading[both] = left
        longest[left] = max(longest.get(left, 0), len(of[left]) + before)
        most = max(most, longest[left])
    return most


def merge(data: bytes, v: Vocabulary) -> list[int]:
    """The tokens of a whole string: the pair of the lowest rank first, leftmost first."""
    ids = [v.byte_id[b] for b in data]
    n, rules = len(ids), v.rules
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(rules[p][0], i) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in rules]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if ids[i] >= 0 else n
        rule = rules.get((ids[i], ids[j])) if j < n else None
        if rule is None or rule[0] != rank:
            continue
        ids[i], ids[j] = rule[1], -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (p := rules.get((ids[i], ids[k]))) is not None:
                heapq.heappush(heap, (p[0], i))
        h = before[i]
        if h >= 0 and (p := rules.get((ids[h], ids[i]))) is not None:
            heapq.heappush(heap, (p[0], h))
    return [x for x in ids if x >= 0]


def merge_many(pieces: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of many short strings, one after the other, and how many each has.  In
    each round every string merges its pair of the lowest rank, the first of equal ones."""
    size = np.array([len(p) for p in pieces], np.int64)
    if not size.sum():
        return _array([]), np.zeros(len(pieces), np.int64)
    ids = np.array(v.byte_id, np.int64)[np.frombuffer(b"".join(pieces), np.uint8)]
    of = np.repeat(np.arange(len(pieces)), size)
    rank, both = v.ranks(ids[:-1], ids[1:])
    none = v.no_rank
    rank, both = np.append(np.where(of[:-1] == of[1:], rank, none), none), np.append(both, 0)
    done_of, done_ids = [], []
    while len(ids):
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(of))))
        open_ = least < none
        done_of.append(of[~open_])
        done_ids.append(ids[~open_])
        ids, of, rank, both, least = (x[open_] for x in (ids, of, rank, both, least))
        at = np.flatnonzero(rank == least)
        at = at[np.append(True, of[at[1:]] != of[at[:-1]])] if len(at) else at
        ids[at] = both[at]
        kept = np.ones(len(ids), bool)
        kept[at + 1] = False
        place = np.cumsum(kept) - 1
        ids, of, rank, both, at = ids[kept], of[kept], rank[kept], both[kept], place[at]
        # pairs that the merged token is part of
        change = np.concatenate([at[at > 0] - 1, at])
        change = change[change < len(ids) - 1]
        rank[at[at == len(ids) - 1]] = none
        if len(change):
            new_rank, both[change] = v.ranks(ids[change], ids[change + 1])
            rank[change] = np.where(of[change] == of[change + 1], new_rank, none)
    of, ids = np.concatenate(done_of), np.concatenate(done_ids)
    return ids[np.argsort(of, kind="stable")].astype(np.int32), np.bincount(of, minlength=len(pieces))


class Transducer:
    """Bytes of one piece in, stable tokens out."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.held = b""
        self.window = WINDOWS * v.lookahead + v.longest

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        for i in range(0, len(data), self.window):
            self.held += data[i : i + self.window]
            if len(self.held) > self.window:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        last, end, out = len(self.held) - self.v.lookahead, 0, []
        for t in merge(self.held, self.v):
            n = len(self.v.bytes[t])
            if end + n > last:
                break
            end += n
            out.append(t)
        self.held = self.held[end:]
        return out

    def finish(self) -> list[int]:
        out = merge(self.held, self.v)
        self.held = b""
        return out


@lru_cache(maxsize=4)
def _classes(path: str) -> tuple[str, str]:
    """Letters and numbers as the tokenizer's library has them.  Versions of Unicode
    differ in what they assign; for characters on which two differ it is asked."""
    from tokenizers import Tokenizer

    cutter, out = Tokenizer.from_file(path).pre_tokenizer, []
    for kind, before in (("L", "a"), ("N", "1")):
        pattern = regex.compile(rf"\p{{{kind}}}")
        other = [c for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff" and bool(pattern.match(c)) != (unicodedata.category(c)[0] == kind)]
        apart = {False: "", True: ""}
        for c in other:
            one = len(cutter.pre_tokenize_str(before + c)) == 1
            if one != bool(pattern.match(c)):
                apart[one] += f"\\U{ord(c):08x}"
        without = rf"[\p{{{kind}}}--[{apart[False]}]]" if apart[False] else rf"\p{{{kind}}}"
        out.append(rf"[{without}{apart[True]}]")
    return out[0], out[1]


@lru_cache(maxsize=8)
def _patterns(letters: str, numbers: str) -> tuple[regex.Pattern, dict[str, regex.Pattern]]:
    """The pattern of pieces, and of each kind of run."""
    # Fixed value: the pattern by which byte-level BPE cuts text.
    pieces = rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letters}+| ?{numbers}+| ?[^\s{letters}{numbers}]+|\s+(?!\S)|\s+"
    runs = {"letters": f"{letters}*", "numbers": f"{numbers}*", "space": r"\s*", "others": rf"[^\s{letters}{numbers}]*"}
    return regex.compile("(?V1)" + pieces), {k: regex.compile("(?V1)" + p) for k, p in runs.items()}


@lru_cache(maxsize=1)
def _settled() -> tuple[re.Pattern, dict[str, re.Pattern]]:
    """The same for text of characters below ``SETTLED``, whose sets are written out:
    alternatives that no text matches both of may stand in any order."""
    low = list(map(chr, range(ord(SETTLED))))
    letters, numbers = ("".join(re.escape(c) for c in low if unicodedata.category(c)[0] == k) for k in "LN")
    space = r"\t-\r \x85\xa0"
    pieces = rf" ?[{letters}]+|'(?:[stmd]|re|ve|ll)| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"
    runs = {"letters": f"[{letters}]*", "numbers": f"[{numbers}]*", "space": f"[{space}]*", "others": f"[^{space}{letters}{numbers}]*"}
    return re.compile(pieces), {k: re.compile(p) for k, p in runs.items()}


class Known:
    """Pieces met so far, numbered, with their tokens in one array; emptied when full."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.empty()

    def empty(self) -> None:
        self.number: dict[str, int] = {}
        self.size, self.flat = np.zeros(0, np.int64), _array([])
        self.start = self.size

    def add(self, pieces: list[str]) -> None:
        raw = [p.encode() for p in pieces]
        short = [k for k, p in enumerate(raw) if len(p) <= SHORT]
        flat, size = merge_many([raw[k] for k in short], self.v)
        parts, sizes, order = [self.flat, flat], [self.size, size], [pieces[k] for k in short]
        for k, p in enumerate(raw):
            if len(p) > SHORT:
                t = Transducer(self.v)
                ids = t.feed(p) + t.finish()
                parts.append(_array(ids))
                sizes.append(np.array([len(ids)]))
                order.append(pieces[k])
        self.number.update(zip(order, range(len(self.number), len(self.number) + len(order))))
        self.flat, self.size = np.concatenate(parts), np.concatenate(sizes)
        self.start = np.cumsum(self.size) - self.size

    def tokens(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all pieces, one after the other, and how many each has."""
        new = [p for p in set(pieces) if p not in self.number]
        if new and len(self.number) + len(new) > REMEMBERED or len(self.flat) > REMEMBERED_IDS:
            self.empty()
            new = list(set(pieces))
        if new:
            self.add(new)
        n = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        return ragged(self.flat, self.start[n], self.size[n]), self.size[n]


#: Where white space begins, pieces end.
_BREAK = re.compile(r"[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000](?=[\t-\r ])")


class Encoder:
    """Text in, in chunks of any size, tokens out as soon as they are stable."""

    def __init__(self, v: Vocabulary, known: Known | None = None):
        self.v, self.known = v, Known(v) if known is None else known
        self.special = re.compile("|".join(map(re.escape, v.special))) if v.special else None
        self.names = tuple(v.special)
        self.transducer = Transducer(v)
        self.text = self.open = ""
        self.run: str | None = None

    def feed(self, chunk: str) -> np.ndarray:
        out: list[np.ndarray] = []
        self.text += chunk
        keep = 0
        if self.special:
            while found := self.special.search(self.text):
                self._segment(self.text[: found.start()], True, out)
                out.append(np.array([self.v.special[found[0]]], np.int32))
                self.text = self.text[found.end() :]
            # the beginning of a special token may stand at the end
            longest = min(len(self.text), max(map(len, self.names)) - 1)
            keep = next((k for k in range(longest, 0, -1) if any(s.startswith(self.text[-k:]) for s in self.names)), 0)
        at = len(self.text) - keep
        body, self.text = self.text[:at], self.text[at:]
        self._segment(body, False, out)
        return _together(out)

    def finish(self) -> np.ndarray:
        out: list[np.ndarray] = []
        body, self.text = self.text, ""
        self._segment(body, True, out)
        return _together(out)

    def patterns(self, text: str) -> tuple[re.Pattern | regex.Pattern, dict]:
        return _settled() if text.isascii() or max(text) < SETTLED else _patterns(*self.v.classes())

    def _segment(self, body: str, end: bool, out: list[np.ndarray]) -> None:
        """Goes on with text between special tokens; ``end``: no more of it comes."""
        text = self.open + body
        self.open = ""
        if not text and not end:
            return
        pieces, runs = self.patterns(text)
        if self.run is not None:
            text = self._go_on(text, runs, end, out)
            if self.run is not None:
                return
        if end:
            out.append(self.known.tokens(pieces.findall(text))[0])
            return
        # up to the last break within the last characters all is final, whatever follows
        near = max(0, len(text) - OPEN_CHARS)
        at = max((m.end() for m in _BREAK.finditer(text, near)), default=0)
        final = pieces.findall(text[:at]) if at else []
        for m in pieces.finditer(text, at):
            if m.end() > len(text) - _BEHIND:
                break
            final.append(m[0])
            at = m.end()
        out.append(self.known.tokens(final)[0])
        text = text[at:]
        if len(text) > OPEN_CHARS:
            # the second character tells the kind: the first may be a blank before a run
            self.run = next(k for k in ("letters", "numbers", "space", "others") if runs[k].match(text, 1).end() > 1)
            head, text = text[:1], text[1:]
            out.append(_array(self.transducer.feed(head.encode())))
            rest = self._go_on(text, runs, False, out)
            if self.run is None:
                self.open = rest
        else:
            self.open = text

    def _go_on(self, text: str, runs: dict, end: bool, out: list[np.ndarray]) -> str:
        """Feeds what ``text`` has of the open run; returns the rest once it has ended."""
        to = runs[self.run].match(text).end()
        over = to < len(text) or end
        if self.run == "space" and to and not (end and to == len(text)):
            # the last one goes with what follows, if anything does
            to -= 1
        out.append(_array(self.transducer.feed(text[:to].encode())))
        if over:
            out.append(_array(self.transducer.finish()))
            self.run = None
            return text[to:]
        self.open = text[to:]
        return ""


def _array(ids: list[int]) -> np.ndarray:
    return np.array(ids, np.int32)


def _together(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else _array([])


class Decoder:
    """Tokens in, text out as soon as its characters are complete."""

    def __init__(self, v: Vocabulary):
        self.strings = v.strings
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.text(self.strings.joined(np.asarray(ids, np.int64))[0])

    def text(self, raw: np.ndarray) -> str:
        """The same from bytes of tokens."""
        return self.state.decode(raw.tobytes())

    def finish(self) -> str:
        return self.state.decode(b"", True)


def _blocks(ids: Iterable[np.ndarray]) -> Iterator[tuple[int, np.ndarray, bool]]:
    """Number, ids and whether it is the last, of blocks of ``BLOCK`` ids; one at least."""
    held, number = _array([]), 0
    for more in ids:
        held, at = np.concatenate([held, more]) if len(held) else more, 0
        while len(held) - at > BLOCK:
            yield number, held[at : at + BLOCK], False
            number, at = number + 1, at + BLOCK
        held = held[at:]
    yield number, held, True


def _stream(e: Encoder, text: str) -> Iterator[np.ndarray]:
    for i in range(0, len(text), CHUNK):
        yield e.feed(text[i : i + CHUNK])
    yield e.finish()


def _texts(column: pa.Array) -> Iterator[tuple[int, str]]:
    raw = column.cast(pa.large_binary())
    for k in range(len(raw)):
        yield k, (raw[k].as_py() or b"").decode("utf-8", "replace")


def _tokens_of(e: Encoder, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, bool]]:
    """Blocks by row.  Short texts are cut into pieces one by one and looked up together;
    longer ones, and such with a special token, go through the encoder in chunks."""
    held: list[tuple[int, list[str]]] = []
    chars = 0

    def looked_up() -> Iterator[tuple[int, int, np.ndarray, bool]]:
        ids, size = e.known.tokens([p for _, pieces in held for p in pieces])
        edge = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *(len(p) for _, p in held)])]
        for (k, _), a, z in zip(held, edge, edge[1:]):
            for block in _blocks([ids[a:z]]):
                yield k, *block
        held.clear()

    for k, text in _texts(column):
        if len(text) <= CHUNK and not any(s in text for s in e.names):
            held.append((k, e.patterns(text)[0].findall(text)))
            chars += len(text)
            if chars > 8 * CHUNK:
                yield from looked_up()
                chars = 0
            continue
        yield from looked_up()
        chars = 0
        for block in _blocks(_stream(e, text)):
            yield k, *block
    yield from looked_up()


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = Encoder(_vocabulary(path))
        for b in batches:
            rows: list[tuple] = []
            held = 0
            for row in _tokens_of(e, b.column(1)):
                rows.append(row)
                held += len(row[2])
                if held > TOGETHER:
                    yield _batch(b, rows)
                    rows, held = [], 0
            if rows:
                yield _batch(b, rows)

    return run


def _batch(b: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    at, numbers, ids, last = zip(*rows)
    edge = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(edge), pa.array(np.concatenate(ids)))
    return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(numbers, pa.int64()), lists, pa.array(last, pa.bool_())], ["id", "block", "ids", "last"])


def encode(df: DataFrame, tokenizer: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Blocks of each row's ids: id, ``block``, ``ids``, ``last``.  ``tokenizer`` is a
    vocabulary file present on every machine.  Blocks of a row follow each other."""
    common.bound_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(df[id_col].alias("id"), df[text_col].cast("binary").alias("text"))
    return source.mapInArrow(_encode(tokenizer), f"id {kind}, block long, ids array<int>, last boolean").withColumnRenamed("id", id_col)


def _written_out(lists: pa.ListArray, strings: Strings) -> Iterator[tuple[int, np.ndarray]]:
    """Each list's number and the strings of its ids, joined."""
    ids, off = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy().astype(np.int64)
    for lo, hi in textcore.chunks(off - off[0], TOGETHER):
        raw, size = strings.joined(ids[off[lo] : off[hi]])
        edge = np.concatenate([[0], np.cumsum(size)])[off[lo : hi + 1] - off[lo]]
        for k in range(lo, hi):
            yield k, raw[edge[k - lo] : edge[k - lo + 1]]


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(path)
        d = Decoder(v)
        for b in batches:
            texts, last = [], b.column(3).to_pylist()
            for k, raw in _written_out(b.column(2), v.strings):
                text = d.text(raw)
                texts.append(text + d.finish() if last[k] else text)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "text"])

    return run


def decode(blocks: DataFrame, tokenizer: str, id_col: str = "doc_id") -> DataFrame:
    """Adds the ``text`` that each block completes.  Blocks of a row must follow each
    other, as ``encode`` gives them."""
    rows = blocks.select(id_col, "block", "ids", "last")
    kind = blocks.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_decode(tokenizer), f"`{id_col}` {kind}, block long, ids array<int>, last boolean, text string")


@lru_cache(maxsize=1)
def _decimals(n: int) -> Strings:
    return Strings({i: f",{i}".encode() for i in range(n)})


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
    for b in batches:
        rows: list[tuple] = []
        ids, last = b.column(2), b.column(3).to_pylist()
        sizes = ids.value_lengths().to_pylist()
        data, off = textcore.utf8(b.column(4))
        most = int(ids.values.to_numpy(zero_copy_only=False).max(initial=0)) + 1
        for k, digits in _written_out(ids, _decimals(1 << (most - 1).bit_length())):
            # the first number has no comma before it
            of_ids.update(digits if n else digits[1:])
            n += sizes[k]
            of_text.update(data[off[k] : off[k + 1]])
            if last[k]:
                rows.append((k, n, of_ids.hexdigest(), of_text.hexdigest()))
                n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
        if rows:
            at, counts, one, two = zip(*rows)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(counts, pa.int64()), pa.array(one), pa.array(two)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row its number of tokens and the SHA-256 of its ids, joined by commas, and of
    its decoded text, from blocks that follow each other."""
    kind = decoded.schema[id_col].dataType.simpleString()
    rows = decoded.select(id_col, "block", "ids", "last", "text")
    return rows.mapInArrow(_digest, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
