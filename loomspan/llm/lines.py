"""Line dedup with deletion neighbourhoods over words.

A line is removed if an earlier line (smaller document id, then line number) has the
same words, or is within the edit bound of it: one word inserted, left out or replaced
for each ``WORDS_PER_EDIT`` words of the longer line, and one at most.  The bound grows
with the line, as one word of a line of two is half of what it says; so lines of fewer
words than that are near only if equal.  Lines are judged on the input, not on what is
left.  Lines without a word always stay.

1. *Classes.*  Lines with equal words are one class, with its first place.
2. *Halves.*  Of two lines within the bound one half is untouched, so a class goes
   on only if it shares a half of equal length with another class.
3. *Deletion neighbourhood.*  A class that goes on emits all variants within the
   bound as hashed keys: each word left out, with the place of the gap (two lines
   with one such key differ by a replacement), each word left out without it, and
   the whole line (a line that equals another's variant differs by an insertion).
   Rows are dealt by key, sorted by key and place, and read as a stream, so a
   key of any number of lines needs no memory and makes a row per line, not per pair.
4. *Verification.*  Each removed line and its earliest partner are compared word by
   word.
5. Of every class the first line stays, unless verification removed it.

Defined results: a null or empty text has no lines with words and is kept as it
is; a null id counts as larger than every other; of rows equal in id and text any
one comes first, and the others lose all their lines with words; rows of one id and
different texts are ordered by a hash of the text; other columns are ignored by the
digest and kept by ``drop_lines``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm import common, textcore

#: Words of the longer of two lines that allow one edited word.
WORDS_PER_EDIT = 4
#: Words whose variants are made together.
VARIANT_WORDS = 200_000
_PLACE = np.uint64(0xD6E8FEB86659FD93)


class Lines:
    """The lines with words of some texts, as ranges of words."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        starts, ends, first = textcore.word_spans(data, off)
        words = textcore.hash_spans(data, starts, ends)
        feeds = np.flatnonzero(data == 10)
        doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
        # a word's line is the number of line feeds before it in its text
        line = np.searchsorted(feeds, starts) - np.searchsorted(feeds, off[:-1])[doc]
        new = np.append(True, (doc[1:] != doc[:-1]) | (line[1:] != line[:-1]))[: len(doc)]
        self.a = np.flatnonzero(new)
        self.b = np.append(self.a[1:], len(doc))[: len(self.a)]
        self.doc, self.line = doc[self.a], line[self.a]
        self.sums = textcore.Sums(words, np.arange(len(words)) - np.repeat(self.a, self.b - self.a))

    def hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.sums.packed(self.sums.raw(a, b), b - a)

    def halves(self, pick: np.ndarray, longer: int) -> np.ndarray:
        """Keys of the left and right halves, as of a line ``longer`` words longer."""
        a, b = self.a[pick], self.b[pick]
        size = b - a + longer
        left, right = size // 2, size - size // 2
        tag = size.astype(np.uint64) * _PLACE
        return np.stack([textcore.mix(self.hashes(a, a + left) + tag), textcore.mix(self.hashes(b - right, b) + tag + np.uint64(1))], 1)

    def variants(self, pick: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Of the picked lines: line, key, kind (0 gap with place, 1 gap, 2 whole)."""
        size = (self.b - self.a)[pick]
        for part in np.array_split(pick, -(-len(pick) // VARIANT_WORDS) or 1):
            yield part, self.hashes(self.a[part], self.b[part]), 2
        # shorter ones are only met by what a longer line is without a word
        pick = pick[size >= WORDS_PER_EDIT]
        n = (self.b - self.a)[pick]
        before = np.append(0, np.cumsum(n))
        for lo in range(0, int(before[-1]), VARIANT_WORDS):
            at = np.arange(lo, min(lo + VARIANT_WORDS, int(before[-1])))
            k = np.searchsorted(before, at, "right") - 1
            row, j = pick[k], at - before[k]
            a, b = self.a[row], self.b[row]
            gap = self.sums.packed(self.sums.then(self.sums.raw(a, a + j), self.sums.raw(a + j + 1, b), j), b - a - 1)
            yield row, textcore.mix(gap + (j.astype(np.uint64) + np.uint64(1)) * _PLACE), 0
            yield row, gap, 1


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _chunks(b: pa.RecordBatch, text: int) -> Iterator[tuple[int, int, Lines]]:
    data, off = textcore.utf8(b.column(text))
    for lo, hi in textcore.chunks(off):
        yield lo, hi, Lines(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])


def _list_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, rids = b.column(0).to_numpy(), b.column(1).to_numpy()
        for lo, hi, x in _chunks(b, 2):
            yield pa.RecordBatch.from_arrays(
                [_signed(x.hashes(x.a, x.b)), pa.array(ids[lo:hi][x.doc]), pa.array(rids[lo:hi][x.doc]), pa.array(x.line.astype(np.int32)), _half_keys(x)], ["cls", "id", "rid", "line", "halves"]
            )


def _half_keys(x: Lines) -> pa.Array:
    """The keys of each line that may have near copies: as of its own length, and of
    one word more."""
    size = x.b - x.a
    count = np.where(size >= WORDS_PER_EDIT, 4, np.where(size >= WORDS_PER_EDIT - 1, 2, 0))
    off = np.append(0, np.cumsum(count))
    keys = np.zeros(off[-1], np.uint64)
    long, some = np.flatnonzero(count == 4), np.flatnonzero(count)
    keys[off[1:][some, None] + np.array([-2, -1])] = x.halves(some, 1)
    keys[off[long, None] + np.array([0, 1])] = x.halves(long, 0)
    return pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), _signed(keys))


def _emit_variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, rids, wanted = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(3)
        for lo, hi, x in _chunks(b, 2):
            want = [np.array(wanted[k].as_py(), np.int64) + ((k - lo) << 32) for k in range(lo, hi)]
            pick = np.flatnonzero(np.isin((x.doc.astype(np.int64) << 32) + x.line, np.concatenate(want)))
            for row, key, kind in x.variants(pick):
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [_signed(key), pa.array(ids[lo:hi][x.doc[row]]), pa.array(rids[lo:hi][x.doc[row]]), pa.array(x.line[row].astype(np.int32)), pa.array(np.full(len(row), kind, np.int8))], ["key", "id", "rid", "line", "kind"]
                    )


def _earlier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and place: each with the first row of its key that it
    is within the bound of, if that is earlier."""
    key, first = None, {}
    for b in batches:
        keys = b.column(0).to_numpy()
        if not len(keys):
            continue
        lone = np.ones(len(keys), bool)
        lone[1:] &= keys[1:] != keys[:-1]
        lone[:-1] &= keys[1:] != keys[:-1]
        lone[-1] = False
        lone[0] &= keys[0] != key
        pick = np.flatnonzero(~lone)
        cols = [b.column(i).to_numpy()[pick].tolist() for i in range(5)]
        out = []
        for k, i, r, ln, kind in zip(*cols):
            if k != key:
                key, first = k, {}
            place = (i, r, ln)
            other = first.get((0, 2, 1)[kind])
            if other is not None and other != place:
                out.append((*place, *other))
            first.setdefault(kind, place)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i % 3 == 2 else pa.int64()) for i, c in enumerate(zip(*out))], ["id", "rid", "line", "id0", "rid0", "line0"])


def within_bound(x: list[str], y: list[str]) -> bool:
    """Whether word lists are equal, or one edited word apart and long enough for it."""
    return x == y or (max(len(x), len(y)) >= WORDS_PER_EDIT and within_one_word(x, y))


def within_one_word(x: list[str], y: list[str]) -> bool:
    """Whether word lists are equal or one insertion, deletion or replacement apart."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    i = 0
    while i < len(x) and x[i] == y[i]:
        i += 1
    return x[i + (len(x) == len(y)) :] == y[i + 1 :]


def split_words(line: str) -> list[str]:
    return [w for w in line.translate(_SPACES).split(" ") if w]


_SPACES = {c: " " for c in (9, 10, 11, 12, 13)}


def _wanted_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for i, r, t, want in zip(*(b.column(k).to_pylist() for k in range(4))):
            parts = t.split("\n")
            rows += [(i, r, w, parts[w]) for w in set(want)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.string()))], ["id", "rid", "line", "words"])


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ok = [within_bound(split_words(x), split_words(y)) for x, y in zip(b.column(3).to_pylist(), b.column(4).to_pylist())]
        yield b.select([0, 1, 2]).filter(pa.array(ok, pa.bool_()))


def _with_lines(source: DataFrame, places: DataFrame) -> DataFrame:
    """The texts that hold the given places, with their line numbers."""
    lists = common.written(places.groupBy("id", "rid").agg(F.collect_set("line").alias("lines")).select(F.col("id").alias("i"), F.col("rid").alias("r"), "lines"), "line-lists")
    return source.join(common.small(lists), (F.col("id") == F.col("i")) & (F.col("rid") == F.col("r"))).select("id", "rid", "text", "lines")


def removed_lines(source: DataFrame) -> DataFrame:
    """``id, rid, lines``: the numbers of the lines to remove, for texts that lose any.

    ``source`` has ``id, rid, text``; ``rid`` tells texts of one id apart."""
    listed = common.written(source.mapInArrow(_list_lines, "cls long, id long, rid long, line int, halves array<long>"), "line-places")
    place = F.struct("id", "rid", "line")
    classes = common.written(listed.groupBy("cls").agg(F.min(F.struct("id", "rid", "line", "halves")).alias("at")).select("cls", "at.*"), "line-classes")
    keys = classes.where(F.size("halves") > 0).select("id", "rid", "line", F.explode("halves").alias("key"))
    # a class has up to four keys, so a key seen twice by one class counts once
    shared = keys.groupBy("key").agg(F.min(place).alias("p"), F.max(place).alias("q")).where("p != q").select(F.col("key").alias("k"))
    going = keys.join(shared, F.col("key") == F.col("k"), "left_semi").select("id", "rid", "line").distinct()
    variants = _with_lines(source, going).mapInArrow(_emit_variants, "key long, id long, rid long, line int, kind byte")
    ordered = variants.repartition("key").sortWithinPartitions("key", "id", "rid", "line")
    near = ordered.mapInArrow(_earlier, "id long, rid long, line int, id0 long, rid0 long, line0 int")
    first = near.groupBy("id", "rid", "line").agg(F.min(F.struct("id0", "rid0", "line0")).alias("e")).select("id", "rid", "line", "e.*")
    pairs = common.written(first, "line-pairs")
    ends = pairs.select("id", "rid", "line").unionByName(pairs.select(F.col("id0").alias("id"), F.col("rid0").alias("rid"), F.col("line0").alias("line")))
    texts = common.written(_with_lines(source, ends).mapInArrow(_wanted_lines, "id long, rid long, line int, words string").dropDuplicates(["id", "rid", "line"]), "line-texts")
    other = texts.select(F.col("id").alias("id0"), F.col("rid").alias("rid0"), F.col("line").alias("line0"), F.col("words").alias("words0"))
    both = pairs.join(texts, ["id", "rid", "line"]).join(other, ["id0", "rid0", "line0"]).select("id", "rid", "line", "words", "words0")
    gone = both.mapInArrow(_check, "id long, rid long, line int").withColumn("gone", F.lit(True))
    fate = classes.select("cls", "id", "rid", "line").join(gone, ["id", "rid", "line"], "left").select(F.col("cls").alias("c"), F.when(F.col("gone").isNull(), place).alias("stays"))
    lost = listed.join(fate, F.col("cls") == F.col("c")).where(F.col("stays").isNull() | (F.col("stays") != place))
    return common.written(lost.groupBy("id", "rid").agg(F.collect_set("line").alias("lost")).select(F.col("id").alias("i"), F.col("rid").alias("r"), "lost"), "line-lost")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for t, lost, again in zip(*(b.column(k).to_pylist() for k in (1, 2, 3))):
            parts = t.split("\n")
            drop = {i for i, p in enumerate(parts) if split_words(p)} if again else set(lost or ())
            out = "\n".join(p for i, p in enumerate(parts) if i not in drop) if drop else t
            rows.append((out, len(parts), len(drop), hashlib.sha256(out.encode()).hexdigest()))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 4, kinds))], ["id", "kept", "n_lines", "n_removed", "kept_sha256"])


def _with_fate(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``id, text, row, again`` and the numbers of the lines that go as ``lost``."""
    source = common.keyed_rows(df, text_col, id_col)
    lost = common.small(removed_lines(source.drop("row")))
    return common.with_copies(source).join(lost, (F.col("id") == F.col("i")) & (F.col("rid") == F.col("r")), "left")


def dedup_lines(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, ``kept`` (the text without removed lines), ``n_lines``,
    ``n_removed``, ``kept_sha256``."""
    out = _with_fate(df.select(id_col, text_col), text_col, id_col).select("id", "text", "lost", "again").mapInArrow(_cut, "id long, kept string, n_lines long, n_removed long, kept_sha256 string")
    return out.withColumn("id", F.when(F.col("id") != common.NULL_ID, F.col("id"))).withColumnRenamed("id", id_col)


def drop_lines(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The table with removed lines cut out of its texts and all other columns as
    they are.  A null text stays null."""
    stays = lambda x, i: F.when(F.col("again"), ~common.has_word(x)).otherwise(~F.array_contains("lost", i))
    kept = F.array_join(F.filter(F.split("text", "\n"), stays), "\n")
    old = F.col("row")[text_col]
    text = F.when(old.isNotNull() & (F.col("again") | F.col("lost").isNotNull()), kept).otherwise(old)
    return _with_fate(df, text_col, id_col).select(*((text if c == text_col else F.col("row")[c]).alias(c) for c in df.columns))
