"""Exact substring dedup over suffix arrays of shards.

A byte is removed if a 50-byte string that covers it also starts in a document
with a smaller id; strings are judged on the input and never cross documents.

1. *Whole copies.*  Documents with equal bytes are known by SHA-256; all but those
   with the smallest id are removed whole and take no further part.
2. *Anchors.*  Each 50-byte string is assigned the smallest hash among its 16-byte
   strings.  Equal strings have equal anchors, so a string whose anchor occurs in
   one document only is kept.  Neighbouring strings with one anchor form a run.
   Anchors are counted from compact blocks, not from rows; an anchor that several
   documents of a block have is sent on once, so that one that all documents have
   gathers no more than a row per block.
3. *Shards.*  Runs whose anchor occurs in several documents are dealt to shards by
   anchor, so equal strings meet.  Equal runs are first folded, in the task that
   reads them and again in the shard; each shard's different runs are concatenated
   and suffix-sorted by induced sorting, permuted common prefixes of 50 bytes mark
   equal strings, and the smallest document id of each such class keeps it.
   Anchors with more runs, or more of their bytes, than a shard may hold go another
   way: their strings are hashed and grouped by Spark, with partial aggregation.
4. *Removal.*  Removed ranges are united per document and cut out of its bytes.

Texts are looked at in pieces that overlap by 49 bytes, so a text's length bounds no
memory but that of its own bytes.  Documents are known by id and the first eight
bytes of their SHA-256.  Equality of runs (and of crowded anchors' strings) is
equality of 64-bit hashes; suffix sorting compares bytes.

Defined results: null and empty texts have no bytes and nothing removed; a null
id counts as larger than every other; rows that share an id are documents of their
own that never remove each other's strings; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.llm import common, suffixes, textcore

LENGTH = 50
GRAM = 16
#: Documents per block of anchors, and bytes of runs that a shard should hold.
DOCS_PER_PART = 4000
SHARD_BYTES = 2 << 20
#: Runs of one anchor, and their bytes, beyond which its strings are grouped by Spark.
MAX_RUNS = 20_000
MAX_RUN_BYTES = 8 << 20
#: Documents of a block of anchors, and its (document, anchor) pairs.
BLOCK_DOCS = 60_000
BLOCK_PAIRS = 1_000_000
NULL_ID = (1 << 63) - 1
_NO_DOC = np.uint32(0xFFFFFFFF)


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours (van Herk); len(h) - width + 1 values."""
    n = len(h)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = h
    blocks = padded.reshape(rows, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(right[:m], left[width - 1 : width - 1 + m])


def anchor_runs(data: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of 50-byte strings with one anchor: text index, first and last
    start (absolute), anchor hash.  ``off`` starts at 0."""
    if len(data) < length:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    word, n = textcore.octets(data), len(data) - GRAM + 1
    grams = textcore.mix(word[:n] ^ textcore.mix(word[8 : n + 8]))
    anchors = _sliding_min(grams, length - GRAM + 1)
    ok = np.zeros(len(data) + 1, np.int8)
    wide = off[1:] - off[:-1] >= length
    np.add.at(ok, off[:-1][wide], 1)
    np.add.at(ok, off[1:][wide] - length + 1, -1)
    valid = np.cumsum(ok[: len(anchors)]) > 0
    change = np.ones(len(anchors), bool)
    change[1:] = (anchors[1:] != anchors[:-1]) | ~valid[:-1]
    starts_doc = off[:-1][wide]
    change[starts_doc] = True
    first = np.flatnonzero(change & valid)
    ends = np.ones(len(anchors), bool)
    ends[:-1] = change[1:] | ~valid[1:]
    last = np.flatnonzero(ends & valid)
    doc = np.searchsorted(off, first, "right") - 1
    return doc, first, last, anchors[first]


def _union(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal ranges of sorted or unsorted half-open ranges."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.append(True, lo[1:] > hi[:-1])
    return lo[new], hi[np.append(np.flatnonzero(new)[1:] - 1, len(lo) - 1)]


def _mark(anchor: np.ndarray, parts: int) -> np.ndarray:
    """What is remembered of an anchor: its part and 32 bits more."""
    return (anchor // np.uint64(parts) << np.uint64(32)) | anchor % np.uint64(parts)


def _blocks(mark: np.ndarray, doc: np.ndarray, docs: np.ndarray) -> Iterator[tuple]:
    """Rows of (part, docs, places, marks) of one block: those of anchors that only one
    of its documents has and one without a document for each other anchor, by part; and
    with a negative part, the documents of those others."""
    order = np.lexsort((doc, mark))
    mark, doc = mark[order], doc[order]
    new = np.append(True, (mark[1:] != mark[:-1]) | (doc[1:] != doc[:-1]))
    mark, doc = mark[new], doc[new]
    same = mark[1:] == mark[:-1]
    several = np.append(False, same) | np.append(same, False)
    if several.any():
        used, local = np.unique(doc[several], return_inverse=True)
        yield -1 - int(mark[several][0] % np.uint64(1 << 16)), docs[used], local, mark[several]
    first = np.append(True, ~same)
    mark, place = mark[first], np.where(several, -1, doc)[first]
    part = (mark & np.uint64(0xFFFFFFFF)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, mark, place = part[order], mark[order], place[order]
    cuts = np.append(np.append(0, np.flatnonzero(np.diff(part)) + 1), len(part))
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        known = place[a:z] >= 0
        used, local = np.unique(place[a:z][known], return_inverse=True)
        out = np.full(z - a, _NO_DOC)
        out[known] = local
        yield int(part[a]), docs[used], out, mark[a:z] >> np.uint64(32)


def _count_anchors(parts: int):
    """Blocks of anchors: ``part``, ``block``, documents (id and key), for each anchor the
    place of its document, and marks (the upper half, where the part is not negative)."""

    def batch(block: int, marks: list, docs: list, table: list) -> Iterator[pa.RecordBatch]:
        if marks:
            rows = _blocks(np.concatenate(marks), np.concatenate(docs), np.concatenate(table))
            p, d, at, m = zip(*((p, d.tobytes(), at.astype(np.uint32).tobytes(), (m if p < 0 else m.astype(np.uint32)).tobytes()) for p, d, at, m in rows))
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array([block] * len(p), pa.int64()), *(pa.array(x, pa.binary()) for x in (d, at, m))], ["part", "block", "docs", "places", "marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        marks, docs, table, n, n_docs = [], [], [], 0, 0
        for b in batches:
            data, off = textcore.utf8(b.column(2))
            names = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1)
            for lo, hi, a, z in textcore.pieces(off, LENGTH - 1):
                doc, _, _, anchor = anchor_runs(data[a:z], np.clip(off[lo : hi + 1], a, z) - a)
                if len(doc):
                    marks.append(_mark(anchor, parts))
                    docs.append(doc + n_docs)
                    n += len(doc)
                table.append(names[lo:hi])
                n_docs += hi - lo
                if n > BLOCK_PAIRS or n_docs > BLOCK_DOCS:
                    yield from batch(block, marks, docs, table)
                    block += 1
                    marks, docs, table, n, n_docs = [], [], [], 0, 0
        yield from batch(block, marks, docs, table)

    return run


def _by_doc(docs: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The different documents (id and key), and the marks of each."""
    order = np.lexsort((docs[:, 1], docs[:, 0]))
    docs, mark = docs[order], mark[order]
    cuts = np.flatnonzero(np.append(True, (docs[1:] != docs[:-1]).any(1))) if len(docs) else np.zeros(0, np.int64)
    return docs[cuts], [mark[a:z].tobytes() for a, z in zip(cuts, np.append(cuts[1:], len(docs)))]


SHARED_SCHEMA = "block long, docs binary, places binary, marks binary"


def _shared_anchors(table: pa.Table) -> pa.Table:
    """Of one part: per block, the marks of anchors that other documents have too, with
    the places of those of its documents that have them."""
    part = table.column("part")[0].as_py()
    if part < 0:
        # what a block knew to be shared
        return table.select(["block", "docs", "places", "marks"])
    places = [np.frombuffer(x, np.uint32) for x in table.column("places").to_pylist()]
    marks = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("marks").to_pylist()])
    order = np.argsort(marks, kind="stable")
    same = marks[order][1:] == marks[order][:-1]
    shared = np.zeros(len(marks), bool)
    shared[order] = np.append(False, same) | np.append(same, False)
    shared &= np.concatenate(places) != _NO_DOC
    out, a = [], 0
    for block, docs, place in zip(table.column("block").to_pylist(), table.column("docs").to_pylist(), places):
        pick, mark = shared[a : a + len(place)], marks[a : a + len(place)]
        a += len(place)
        if pick.any():
            used, local = np.unique(place[pick], return_inverse=True)
            whole = (mark[pick].astype(np.uint64) << np.uint64(32)) | np.uint64(part)
            out.append((block, np.frombuffer(docs, np.int64).reshape(-1, 2)[used].tobytes(), local.astype(np.uint32).tobytes(), whole.tobytes()))
    kinds = [pa.int64(), *[pa.binary()] * 3]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 4, kinds)], ["block", "docs", "places", "marks"])


def _of_block(table: pa.Table) -> pa.Table:
    """Of one block: per document, the marks of anchors that other documents have too."""
    docs, marks = [], []
    for d, at, m in zip(*(table.column(c).to_pylist() for c in ("docs", "places", "marks"))):
        docs.append(np.frombuffer(d, np.int64).reshape(-1, 2)[np.frombuffer(at, np.uint32)])
        marks.append(np.frombuffer(m, np.uint64))
    keys, blobs = _by_doc(np.concatenate(docs), np.concatenate(marks))
    return pa.table({"id": pa.array(keys[:, 0], pa.int64()), "key": pa.array(keys[:, 1], pa.int64()), "marks": pa.array(blobs, pa.binary())})


def _runs(parts: int):
    """Runs with a shared anchor as rows; those equal to one of a smaller document
    in the same chunk leave at once, as removed ranges (with a null anchor)."""

    def of(texts: list[bytes], names: np.ndarray, listed: list) -> Iterator[pa.RecordBatch]:
        data, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        for lo, hi, a, z in textcore.pieces(off, LENGTH - 1):
            seg = data[a:z]
            starts = np.clip(off[lo : hi + 1], a, z) - a
            doc, first, last, anchor = anchor_runs(seg, starts)
            # which of the runs' anchors are listed for their document
            tag = lambda d: textcore.mix(d.astype(np.uint64) + np.uint64(1))
            wanted = np.concatenate([np.frombuffer(b"".join(listed[k]), np.uint64) ^ tag(np.array([k - lo])) for k in range(lo, hi)])
            hit = np.isin(_mark(anchor, parts) ^ tag(doc), wanted)
            doc, first, last, anchor = doc[hit], first[hit], last[hit], anchor[hit]
            if not len(doc):
                continue
            content = textcore.hash_spans(seg, first, last + LENGTH)
            ids, keys = names[lo:hi][doc].T
            order = np.lexsort((ids, content, anchor))
            same = np.append(False, (anchor[order][1:] == anchor[order][:-1]) & (content[order][1:] == content[order][:-1]))
            lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
            copies = order[same]
            gone = ids[copies] > ids[lead[same]]
            begin = off[lo:hi][doc] - a
            yield _run_batch(anchor, content, ids, keys, first - begin, last - begin + LENGTH, copies[gone], None, None)
            keep = np.sort(np.concatenate([order[~same], copies[~gone]]))
            yield _run_batch(anchor, content, ids, keys, first - begin, last - begin + LENGTH, keep, seg, first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            names = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1)
            texts, lo, size = [], 0, 0
            for i in range(b.num_rows):
                texts.append(unpack(b.column(2)[i].as_py()))
                size += len(texts[-1])
                if size > textcore.CHUNK_BYTES or i == b.num_rows - 1:
                    yield from of(texts, names[lo : i + 1], [b.column(3)[k].as_py() for k in range(lo, i + 1)])
                    texts, lo, size = [], i + 1, 0

    return run


RUN_SCHEMA = "anchor long, content long, id long, key long, from int, to int, bytes binary"


def _run_batch(anchor, content, ids, keys, lo, hi, pick, seg, first) -> pa.RecordBatch:
    n = len(pick)
    if seg is None:
        a, blob = pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())
    else:
        a = pa.array(anchor[pick].view(np.int64), pa.int64())
        size = hi[pick] - lo[pick]
        off = np.append(0, np.cumsum(size))
        where = np.repeat(first[pick] - off[:-1], size) + np.arange(off[-1])
        blob = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(seg[where].tobytes())])
    return pa.RecordBatch.from_arrays(
        [a, pa.array(content[pick].view(np.int64), pa.int64()), pa.array(ids[pick], pa.int64()), pa.array(keys[pick], pa.int64()), pa.array(lo[pick], pa.int32()), pa.array(hi[pick], pa.int32()), blob],
        ["anchor", "content", "id", "key", "from", "to", "bytes"],
    )


RANGE_SCHEMA = "id long, key long, from int, to int"


def _ranges(ids: np.ndarray, keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.Table:
    return pa.table({"id": pa.array(ids, pa.int64()), "key": pa.array(keys, pa.int64()), "from": pa.array(lo, pa.int32()), "to": pa.array(hi, pa.int32())})


def _shard(table: pa.Table) -> pa.Table:
    """Removed ranges of one shard."""
    anchor, content, ids, keys, lo, hi = (table.column(c).to_numpy() for c in ("anchor", "content", "id", "key", "from", "to"))
    order = np.lexsort((ids, content, anchor))
    anchor, content, ids, keys, lo, hi = (x[order] for x in (anchor, content, ids, keys, lo, hi))
    head = np.append(True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]))
    lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    gone = ids > ids[lead]
    out = [(ids[gone], keys[gone], lo[gone], hi[gone])]
    # one of each content goes on, with the smallest id; the same document may hold it twice
    left = np.flatnonzero(~gone)
    first = np.flatnonzero(head)
    # a content that is alone with its anchor has no other string to equal, unless it repeats itself
    new_anchor = np.append(True, anchor[first][1:] != anchor[first][:-1])
    per = np.diff(np.append(np.flatnonzero(new_anchor), len(first)))
    several = np.repeat(per > 1, per)
    use = first[several]
    if len(use):
        blobs = table.column("bytes").combine_chunks() if isinstance(table.column("bytes"), pa.ChunkedArray) else table.column("bytes")
        data, boff = textcore.utf8(blobs)
        src = order[use]
        size = boff[src + 1] - boff[src]
        start = np.append(0, np.cumsum(size))
        text = data[np.repeat(boff[src] - start[:-1], size) + np.arange(start[-1])]
        owner = np.repeat(np.arange(len(use)), size)
        inside = np.arange(start[-1]) - start[:-1][owner] <= (size - LENGTH)[owner]
        sa = suffixes.suffix_array(text, LENGTH)
        sa = sa[inside[sa]]
        equal = suffixes.permuted_common_prefixes(text, sa, LENGTH)[sa] >= LENGTH
        cls = np.cumsum(~equal) - 1
        doc = ids[use][owner[sa]]
        least = np.minimum.reduceat(doc, np.flatnonzero(~equal))
        dup = np.sort(sa[doc > least[cls]])
        if len(dup):
            k = owner[dup]
            at = dup - start[:-1][k]
            # consecutive strings of one run make one range
            cut = np.append(True, (k[1:] != k[:-1]) | (at[1:] != at[:-1] + 1))
            a = np.flatnonzero(cut)
            z = np.append(a[1:], len(dup)) - 1
            run, rel_lo, rel_hi = k[a], at[a], at[z] + LENGTH
            # every row left with that content has the range, at its own place
            row_of = np.searchsorted(use, lead[left])
            ok = (row_of < len(use)) & (use[np.minimum(row_of, len(use) - 1)] == lead[left])
            rows, owner_run = left[ok], row_of[ok]
            by_run = np.searchsorted(run, np.arange(len(use) + 1))
            count = (by_run[1:] - by_run[:-1])[owner_run]
            rep = np.repeat(np.arange(len(rows)), count)
            pos = np.repeat(by_run[owner_run] - np.append(0, np.cumsum(count))[:-1], count) + np.arange(count.sum())
            out.append((ids[rows][rep], keys[rows][rep], lo[rows][rep] + rel_lo[pos], lo[rows][rep] + rel_hi[pos]))
    return _ranges(*(np.concatenate(x) for x in zip(*out)))


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of crowded anchors as one row per 50-byte string."""
    for b in batches:
        data, off = textcore.utf8(b.column(4))
        ids, keys, base = (b.column(i).to_numpy() for i in range(1, 4))
        for lo, hi, a, z in textcore.pieces(off, LENGTH - 1, 1 << 18):
            begin = np.clip(off[lo : hi + 1], a, z)
            count = begin[1:] - begin[:-1] - LENGTH + 1
            row = np.repeat(np.arange(hi - lo), count)
            at = begin[:-1][row] + np.arange(count.sum()) - np.repeat(np.append(0, np.cumsum(count))[:-1], count)
            h = textcore.hash_spans(data[a:z], at - a, at - a + LENGTH)
            place = base[lo:hi][row] + at - off[lo:hi][row]
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[lo:hi][row]), pa.array(keys[lo:hi][row]), pa.array(place.astype(np.int32))], ["h", "id", "key", "at"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        data, off = textcore.utf8(b.column(2))
        raw = memoryview(np.ascontiguousarray(data))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([pack(raw[off[i] : off[i + 1]]) for i in range(len(off) - 1)], pa.binary())], ["id", "key", "packed"])


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = textcore.utf8(b.column(1))
            raw = data.tobytes()
            rows = []
            for i in range(b.num_rows):
                text = raw[off[i] : off[i + 1]]
                if b.column(2)[i].as_py():
                    spans = [(0, len(text))] if len(text) >= LENGTH else []
                elif (packed := b.column(3)[i].as_py()) is not None:
                    pairs = np.frombuffer(packed, np.int32).reshape(-1, 2)
                    spans = list(zip(*(x.tolist() for x in _union(pairs[:, 0], pairs[:, 1]))))
                else:
                    spans = []
                kept, at = [], 0
                for a, z in spans:
                    kept.append(text[at:a])
                    at = z
                kept = b"".join([*kept, text[at:]])
                rows.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), *([kept] if with_text else [])))
            kinds = [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * with_text
            cols = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text])

    return run


def _merge_ranges(table: pa.Table) -> pa.Table:
    ids, keys, lo, hi = (table.column(c).to_numpy() for c in ("id", "key", "from", "to"))
    order = np.lexsort((keys, ids))
    ids, keys, lo, hi = ids[order], keys[order], lo[order], hi[order]
    cuts = np.append(0, np.flatnonzero((np.diff(ids) != 0) | (np.diff(keys) != 0)) + 1)
    blobs = []
    for a, z in zip(cuts, np.append(cuts[1:], len(ids))):
        blobs.append(np.stack(_union(lo[a:z], hi[a:z]), 1).astype(np.int32).tobytes())
    return pa.table({"i": pa.array(ids[cuts], pa.int64()), "k": pa.array(keys[cuts], pa.int64()), "ranges": pa.array(blobs, pa.binary())})


def remove_repeats(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", with_text: bool = False) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, if
    asked for, the bytes that are left as ``kept``."""
    sha = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    source = df.select(F.coalesce(df[id_col], F.lit(NULL_ID)).cast("long").alias("id"), F.coalesce(df[text_col], F.lit("")).alias("text"))
    hashed = source.withColumn("sha", sha).withColumn("key", F.conv(F.hex(F.substring("sha", 1, 8)), 16, -10).cast("long"))
    keys = hashed.select("id", "sha", F.octet_length("text").alias("size"))
    firsts = common.written(keys.groupBy("sha").agg(F.min("id").alias("first"), F.max("size").alias("size"), F.count(F.lit(1)).alias("n")), "substring-firsts")
    n_docs = firsts.count()
    parts = max(16, -(-n_docs // DOCS_PER_PART))
    long_firsts = common.small(firsts.where(F.col("size") >= LENGTH).select(F.col("sha").alias("s"), "first"))
    lead = hashed.join(long_firsts, (F.col("sha") == F.col("s")) & (F.col("id") == F.col("first")), "left_semi").select("id", "key", "text")
    blocks = lead.mapInArrow(_count_anchors(parts), f"part int, {SHARED_SCHEMA}").groupBy("part").applyInArrow(_shared_anchors, SHARED_SCHEMA)
    shared = blocks.groupBy("block").applyInArrow(_of_block, "id long, key long, marks binary")
    lists = common.written(shared.groupBy("id", "key").agg(F.collect_list("marks").alias("marks")).select(F.col("id").alias("i"), F.col("key").alias("k"), "marks"), "substring-lists")
    here = (F.col("id") == F.col("i")) & (F.col("key") == F.col("k"))
    packed = lead.mapInArrow(_pack, "id long, key long, packed binary").join(lists, here).select("id", "key", "packed", "marks")
    runs = common.written(packed.mapInArrow(_runs(parts), RUN_SCHEMA), "substring-runs")
    local = runs.where("anchor is null").select("id", "key", "from", "to")
    rest = runs.where("anchor is not null")
    size = F.coalesce(F.octet_length("bytes"), F.lit(0)).cast("long")
    per = rest.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("size"))
    crowded = common.written(per.where((F.col("n") > MAX_RUNS) | (F.col("size") > MAX_RUN_BYTES)).select(F.col("anchor").alias("a")), "substring-crowded")
    crowd = common.small(crowded)
    total = rest.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    shards = max(8, -(-total // SHARD_BYTES))
    sharded = rest.join(crowd, F.col("anchor") == F.col("a"), "left_anti").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int"))
    ranges = sharded.groupBy("shard").applyInArrow(_shard, RANGE_SCHEMA)
    strings = rest.join(crowd, F.col("anchor") == F.col("a"), "left_semi").select("anchor", "id", "key", "from", "bytes").mapInArrow(_strings, "h long, id long, key long, at int")
    least = strings.groupBy("h").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select(F.col("h").alias("g"), "least")
    many = strings.join(least, (F.col("h") == F.col("g")) & (F.col("id") > F.col("least"))).select("id", "key", F.col("at").alias("from"), (F.col("at") + LENGTH).cast("int").alias("to"))
    every = local.unionByName(ranges).unionByName(many)
    bucketed = every.withColumn("bucket", F.pmod(F.xxhash64("id", "key"), F.lit(max(8, n_docs // DOCS_PER_PART))).cast("int"))
    merged = common.written(bucketed.groupBy("bucket").applyInArrow(_merge_ranges, "i long, k long, ranges binary"), "substring-ranges")
    # only contents that several rows have can lose whole rows
    copies = common.written(firsts.where("n > 1").select(F.col("sha").alias("s"), "first"), "substring-copies")
    flagged = hashed.join(common.small(copies), F.col("sha") == F.col("s"), "left").select("id", "key", "text", F.coalesce(F.col("id") > F.col("first"), F.lit(False)).alias("copy"))
    full = flagged.join(common.small(merged), here, "left").select("id", "text", "copy", "ranges")
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    out = full.mapInArrow(_cut(with_text), schema)
    return out.withColumn("id", F.when(F.col("id") != NULL_ID, F.col("id"))).withColumnRenamed("id", id_col)
