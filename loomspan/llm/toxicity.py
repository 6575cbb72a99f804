"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Inputs of a word are a trained vector of its hash bucket and the mean of trained
vectors of the character strings that it begins with.  Windows of ``WINDOW`` words that overlap by half or more
cover the whole text; two GRUs of ``HIDDEN`` units read each window from either
side, attention pools their states, and a logit is made of the pool.  A text's
score is the largest of its windows' probabilities.

Training (numpy, in one task, from which only the weights reach the driver) sees
labelled rows only, at most ``MAX_TRAIN`` of either class, those with the smallest hash
of the id.  Where that leaves the classes in another proportion than the labels have,
losses are weighted to make up for it.  Only documents have labels, so each epoch
takes of each text the windows that score highest now and learns from them.  The
first coordinate of a word's vector starts at the log-odds of the label given that
the word occurs, and the first epoch takes the windows with the largest of them.

Defined results: an empty or null text is one window without words, and scores
what the output bias gives; repeated rows score alike and are learnt from once; a
null id is held out; rows without a label are not learnt from; an id labelled with both
classes is learnt from as either; with labels of one class only, every
score is that class's; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.llm import textcore

WINDOW = 24
STRIDE = 12
HIDDEN = 8
WORD_DIM = 6
CHAR_DIM = 6
#: Byte lengths of the leading character strings that stand for a word's characters.
PREFIXES = (3, 4, 5, 6, 7, 8, 9, 10)
#: Words and strings in fewer training texts have no vector: they can't be learnt by heart.
LEAST_TEXTS = 3
#: Share of word inputs that are blanked in training.
DROPOUT = 0.15
BUCKETS = 1 << 16
#: Most texts of a class that are learnt from.
MAX_TRAIN = 3000
EPOCHS = 5
#: Small training sets are seen more often, until this many steps are taken.
LEAST_STEPS = 400
BATCH = 96
FOLDS = 5
CHUNK = 1 << 20
#: Windows that are read together.
WINDOWS_AT_ONCE = 4000

_BETWEEN = np.ones(256, bool)
_BETWEEN[48:58] = _BETWEEN[65:91] = _BETWEEN[97:123] = _BETWEEN[128:] = False


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Windows:
    """Words and windows of some texts.  ``bucket`` has each word's hash bucket; the
    leading strings of word i are ``gram[at[i]:at[i + 1]]``."""

    def __init__(self, sizes: np.ndarray):
        self.first = np.append(0, np.cumsum(sizes))
        self.n = int(self.first[-1])
        # the last window ends at or after the last word
        per = np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1)
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), per)
        self.window_of_doc = np.append(0, np.cumsum(per))

    def index(self, rows: np.ndarray) -> np.ndarray:
        """The words of some windows; ``n`` (one past the words) is padding."""
        doc = self.doc[rows]
        at = (self.first[:-1][doc] + (rows - self.window_of_doc[:-1][doc]) * STRIDE)[:, None] + np.arange(WINDOW)
        return np.where(at < self.first[1:][doc][:, None], at, self.n)

    def parts(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Windows a few at a time: the range of their words, and their word indexes
        within it (padding comes last)."""
        for i in range(0, len(self.doc), WINDOWS_AT_ONCE):
            index = self.index(np.arange(i, min(i + WINDOWS_AT_ONCE, len(self.doc))))
            real = index < self.n
            lo, hi = (int(index[real].min()), int(index[real].max()) + 1) if real.any() else (0, 0)
            yield lo, hi, np.where(real, index - lo, hi - lo)

    def strings(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the leading strings of words lo to hi, and for each word the
        first one's place (length + 1)."""
        return self.gram[self.at[lo] : self.at[hi]], self.at[lo : hi + 1] - self.at[lo]

    def inputs(self, m: dict, lo: int, hi: int) -> np.ndarray:
        """Inputs of the words lo to hi: each word's own vector and the mean of its
        leading strings'; the last row is the padding's."""
        gram, at = self.strings(lo, hi)
        out = np.zeros((hi - lo + 1, WORD_DIM + CHAR_DIM), np.float32)
        out[:-1, :WORD_DIM] = m["E"][self.bucket[lo:hi]]
        some = np.flatnonzero(np.diff(at))
        if len(some):
            out[some, WORD_DIM:] = np.add.reduceat(m["C"][gram], at[some], axis=0) / np.diff(at)[some][:, None]
        return out


def _buckets(h: np.ndarray) -> np.ndarray:
    return (h % np.uint64(BUCKETS)).astype(np.int32)


class Words(Windows):
    """The windows of texts whose bytes are at hand."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data = textcore.LOWER[data]
        self.starts, self.ends, first = textcore.word_spans(self.data, off, _BETWEEN)
        self.bucket = _buckets(textcore.hash_spans(self.data, self.starts, self.ends))
        super().__init__(np.diff(first))

    def strings(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        starts, size = self.starts[lo:hi], (self.ends - self.starts)[lo:hi]
        count = (size[:, None] >= np.array(PREFIXES)).sum(1)
        at = np.append(0, np.cumsum(count))
        word = np.repeat(np.arange(len(size)), count)
        # lengths are in bytes
        length = np.array(PREFIXES)[np.arange(at[-1]) - at[:-1][word]]
        base = int(starts[0]) if len(starts) else 0
        end = int(starts[-1]) + PREFIXES[-1] if len(starts) else 0
        return _buckets(textcore.hash_spans(self.data[base:end], starts[word] - base, starts[word] - base + length)), at


class Training(Windows):
    """What training needs of many texts, without their bytes: buckets of words and
    of leading strings.  Built a megabyte at a time from a stream of texts."""

    def __init__(self, texts: Iterator[bytes]):
        bucket, gram, count, sizes, held = [], [], [], [np.zeros(0, np.int64)], []

        def take() -> None:
            w = Words(np.frombuffer(b"".join(held), np.uint8), np.cumsum([0, *map(len, held)]))
            sizes.append(np.diff(w.first))
            bucket.append(w.bucket)
            for lo in range(0, w.n, 100_000):
                g, at = w.strings(lo, min(lo + 100_000, w.n))
                gram.append(g)
                count.append(np.diff(at).astype(np.int8))
            held.clear()

        for t in texts:
            held.append(t)
            if sum(map(len, held)) > CHUNK:
                take()
        if held:
            take()
        self.bucket, self.gram = (np.concatenate([np.zeros(0, np.int32), *x]) for x in (bucket, gram))
        self.at = np.append(0, np.cumsum(np.concatenate([np.zeros(0, np.int8), *count]), dtype=np.int64))
        super().__init__(np.concatenate([np.zeros(0, np.int64), *sizes]))


def new_model(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    d, h = WORD_DIM + CHAR_DIM, HIDDEN
    m = {"E": 0.1 * r.standard_normal((BUCKETS, WORD_DIM)), "C": 0.1 * r.standard_normal((BUCKETS, CHAR_DIM))}
    for k in "fb":
        m |= {f"W{k}": r.standard_normal((d, 3 * h)) / np.sqrt(d), f"U{k}": r.standard_normal((h, 3 * h)) / np.sqrt(h), f"B{k}": np.zeros(3 * h)}
    m |= {"A": r.standard_normal((2 * h, h)) / np.sqrt(2 * h), "a": np.zeros(h), "v": r.standard_normal(h) / np.sqrt(h), "o": r.standard_normal(2 * h) / np.sqrt(2 * h), "c": np.array([-1.0])}
    return {k: v.astype(np.float32) for k, v in m.items()}


def _gru(x: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None) -> np.ndarray:
    """States (time, window, unit) for projected inputs (time, window, 3 * unit)."""
    t, n, _ = x.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.empty((t, n, HIDDEN), np.float32)
    for i in range(t):
        g = h @ u
        zr = _sigmoid(x[i, :, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(x[i, :, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
        new = c + z * (h - c)
        if keep is not None:
            keep.append((h, z, r, c, g[:, 2 * HIDDEN :]))
        h = h + mask[i][:, None] * (new - h)
        out[i] = h
    return out


def _gru_back(d_out: np.ndarray, mask: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of ``u``."""
    t, n, _ = d_out.shape
    dx, du, dh = np.zeros((t, n, 3 * HIDDEN), np.float32), np.zeros_like(u), np.zeros((n, HIDDEN), np.float32)
    for i in reversed(range(t)):
        h, z, r, c, gc = kept[i]
        dh = dh + d_out[i]
        new = mask[i][:, None] * dh
        stay = dh - new
        dz, dc = new * (h - c) * z * (1 - z), new * (1 - z) * (1 - c * c)
        dr = dc * gc * r * (1 - r)
        dx[i] = np.concatenate([dz, dr, dc], 1)
        dg = np.concatenate([dz, dr, dc * r], 1)
        du += h.T @ dg
        dh = stay + new * z + dg @ u.T
    return dx, du


def _states(m: dict, x: np.ndarray, index: np.ndarray, n_words: int, keep: dict | None = None):
    """(window, time, 2 * unit) states for word inputs ``x``; padding comes last."""
    mask = (index < n_words).T.astype(np.float32)
    both = []
    for k, step in (("f", 1), ("b", -1)):
        order = index.T[::step]
        proj = (x @ m[f"W{k}"] + m[f"B{k}"])[order]
        kept = None if keep is None else keep.setdefault(k, [])
        both.append(_gru(proj, mask[::step], m[f"U{k}"], kept)[::step])
    return np.concatenate(both, 2), mask


def _pool(m: dict, states: np.ndarray, mask: np.ndarray):
    """Attention over time: logits, and what the gradient needs."""
    hid = np.tanh(states @ m["A"] + m["a"])
    e = hid @ m["v"] + np.where(mask > 0, 0, -1e9).astype(np.float32)
    e = np.exp(e - e.max(0))
    w = e * mask
    w = w / np.maximum(w.sum(0), 1e-9)
    ctx = np.einsum("tn,tnh->nh", w, states)
    return ctx @ m["o"] + m["c"][0], (hid, w, ctx)


def window_logits(m: dict, words: Windows) -> np.ndarray:
    out = [np.zeros(0, np.float32)]
    for lo, hi, index in words.parts():
        states, mask = _states(m, words.inputs(m, lo, hi), index, hi - lo)
        out.append(_pool(m, states, mask)[0])
    return np.concatenate(out)


def score_texts(m: dict, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The largest window probability of each text."""
    out = np.empty(len(off) - 1)
    for lo, hi in textcore.chunks(off, CHUNK):
        words = Words(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        best = np.maximum.reduceat(window_logits(m, words), words.window_of_doc[:-1])
        out[lo:hi] = _sigmoid(best.astype(np.float64))
    return out


def _step(m: dict, words: Training, rows: np.ndarray, y: np.ndarray, weight: np.ndarray, grads: dict, blank: np.ndarray | None = None) -> None:
    """Adds the gradient of the weighted mean loss of some windows to ``grads``;
    ``blank`` has a chance in [0, 1) per window and place."""
    index = words.index(rows)
    n = words.n
    used, local = np.unique(index, return_inverse=True)
    # words of this batch only, with padding last
    table = np.append(used[used < n], n)
    local = local.reshape(index.shape)
    gram, at = words.gram, words.at
    size = np.diff(at)[table[:-1]]
    owner = np.repeat(np.arange(len(size)), size)
    which = gram[np.arange(size.sum()) - np.repeat(np.append(0, np.cumsum(size))[:-1] - at[table[:-1]], size)]
    share = (1 / np.maximum(size, 1)).astype(np.float32)[owner]
    x = np.zeros((len(table), WORD_DIM + CHAR_DIM), np.float32)
    x[:-1, :WORD_DIM] = m["E"][words.bucket[table[:-1]]]
    np.add.at(x[:, WORD_DIM:], owner, m["C"][which] * share[:, None])
    if blank is not None:
        # a blanked word reads as one that has no vectors
        x = np.concatenate([x[:-1], np.zeros((1, x.shape[1]), np.float32), x[-1:]])
        local = np.where((blank < DROPOUT) & (index < n), len(table) - 1, np.where(index < n, local, len(table)))
    last = len(x) - 1
    keep: dict = {}
    states, mask = _states(m, x, local, last, keep)
    logit, (hid, w, ctx) = _pool(m, states, mask)
    d = ((_sigmoid(logit) - y) * weight / len(rows)).astype(np.float32)
    grads["o"] += ctx.T @ d
    grads["c"] += d.sum()
    dctx = d[:, None] * m["o"]
    dw = np.einsum("tnh,nh->tn", states, dctx)
    de = w * (dw - (w * dw).sum(0))
    dhid = de[:, :, None] * m["v"] * (1 - hid * hid)
    grads["v"] += np.einsum("tn,tnh->h", de, hid)
    grads["A"] += np.einsum("tni,tnj->ij", states, dhid)
    grads["a"] += dhid.sum((0, 1))
    ds = w[:, :, None] * dctx + dhid @ m["A"].T
    dxs = np.zeros_like(x)
    for i, (k, step) in enumerate((("f", 1), ("b", -1))):
        dp, du = _gru_back(ds[::step, :, i * HIDDEN : (i + 1) * HIDDEN], mask[::step], m[f"U{k}"], keep[k])
        order = local.T[::step].ravel()
        flat = dp.reshape(-1, 3 * HIDDEN)
        grads[f"U{k}"] += du
        grads[f"B{k}"] += flat.sum(0)
        grads[f"W{k}"] += x[order].T @ flat
        np.add.at(dxs, order, flat @ m[f"W{k}"].T)
    np.add.at(grads["E"], words.bucket[table[:-1]], dxs[: len(table) - 1, :WORD_DIM])
    np.add.at(grads["C"], which, dxs[owner, WORD_DIM:] * share[:, None])


def _log_odds(doc: np.ndarray, bucket: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per bucket, shrunken log-odds of the label given that the text has it, and
    the number of texts that do."""
    pos, every = np.zeros(BUCKETS), np.zeros(BUCKETS, np.int64)
    # a few texts at a time
    cuts = np.searchsorted(doc, np.arange(0, len(y) + 64, 64))
    for a, z in zip(cuts[:-1], cuts[1:]):
        pairs = np.unique(doc[a:z].astype(np.int64) * BUCKETS + bucket[a:z])
        pos += np.bincount(pairs % BUCKETS, y[pairs // BUCKETS], BUCKETS)
        every += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
    p, n = y.sum(), len(y) - y.sum()
    odds = np.log((pos + 0.5) / (p + 1)) - np.log((every - pos + 0.5) / (n + 1))
    return odds * every / (every + 4), every


def train(words: Training, y: np.ndarray, share: float | None = None, epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray]:
    """A model of labelled texts; ``share`` is that of class 1 in all labels, if the
    texts have another."""
    m = new_model(seed)
    y = y.astype(np.float32)
    if len(y) == 0 or y.min() == y.max():
        m["o"][:], m["c"][:] = 0, -9.0 if len(y) == 0 or y[0] == 0 else 9.0
        return m
    own = float(y.mean())
    share = own if share is None else share
    weight = np.where(y == 1, share / own, (1 - share) / (1 - own)).astype(np.float32)
    doc = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(words.first))
    odds, count = _log_odds(doc, words.bucket, y)
    gram_odds, gram_count = _log_odds(np.repeat(doc, np.diff(words.at)), words.gram, y)
    del doc
    # in training, only buckets of enough texts have rows; row 0 is all others', and zero
    known = {"E": np.flatnonzero(count >= LEAST_TEXTS), "C": np.flatnonzero(gram_count >= LEAST_TEXTS)}
    row = {}
    for k, init in (("E", odds), ("C", gram_odds)):
        m[k][:, 0] = init / 1.5
        m[k] = np.concatenate([np.zeros((1, m[k].shape[1]), np.float32), m[k][known[k]]])
        row[k] = np.zeros(BUCKETS, np.int32)
        row[k][known[k]] = np.arange(1, len(known[k]) + 1)
    words.bucket, words.gram = row["E"][words.bucket], row["C"][words.gram]
    r = np.random.default_rng(seed)
    scores = _first_scores(m, words)
    mean, var, t = {k: np.zeros_like(v) for k, v in m.items()}, {k: np.zeros_like(v) for k, v in m.items()}, 0
    per_epoch = max(1, (len(y) + int((y == 0).sum())) // BATCH)
    for epoch in range(max(epochs, -(-LEAST_STEPS // per_epoch))):
        if epoch:
            scores = window_logits(m, words)
        order = np.lexsort((-scores, words.doc))
        place = np.arange(len(order)) - words.window_of_doc[words.doc[order]]
        # the highest window of each text, and of clean ones the second too
        pick = order[(place == 0) | ((place < 2) & (y[words.doc[order]] == 0))]
        r.shuffle(pick)
        for batch in np.array_split(pick, max(1, len(pick) // BATCH)):
            grads = {k: np.zeros_like(v) for k, v in m.items()}
            of = words.doc[batch]
            _step(m, words, batch, y[of], weight[of], grads, r.random((len(batch), WINDOW)))
            grads["E"][0] = grads["C"][0] = 0
            t += 1
            for k, g in grads.items():
                mean[k] += 0.1 * (g - mean[k])
                var[k] += 0.01 * (g * g - var[k])
                m[k] -= 0.01 * (mean[k] / (1 - 0.9**t)) / (np.sqrt(var[k] / (1 - 0.99**t)) + 1e-6)
    for k in ("E", "C"):
        full = np.zeros((BUCKETS, m[k].shape[1]), np.float32)
        full[known[k]] = m[k][1:]
        m[k] = full
    return m


def _first_scores(m: dict, words: Training) -> np.ndarray:
    out = []
    for lo, hi, index in words.parts():
        x = words.inputs(m, lo, hi)
        out.append(np.append(x[:-1, 0] + x[:-1, WORD_DIM], -99.0)[index].max(1))
    return np.concatenate(out)


def held_out(id_col: Column) -> Column:
    """Whether a document's label must not be learnt from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, text_col: str = "text", id_col: str = "doc_id") -> dict[str, np.ndarray]:
    """A model of the labelled documents that are not held out, at most
    ``max_train`` of each class.  One task reads their texts and trains."""
    marks = labels.select(labels[id_col].alias("k"), labels["toxic"].cast("int").alias("y")).where("y in (0, 1)").where(~held_out(F.col("k"))).distinct()
    total = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = total.get(1, 0) / max(1, sum(total.values()))
    # the ids with the smallest hash; ids first, so that few texts are moved
    by_hash = lambda y: marks.where(F.col("y") == y).orderBy(F.md5(F.col("k").cast("string")), "k").limit(max_train)
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text")).join(F.broadcast(by_hash(0).unionByName(by_hash(1))), F.col("id") == F.col("k"))
    # an id of many rows gives no more texts than there are ids
    rows = rows.select(F.md5(F.col("id").cast("string")).alias("m"), "text", "y").dropDuplicates(["text", "y"]).orderBy("m", "text", "y").limit(2 * max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y: list[int] = []

        def texts() -> Iterator[bytes]:
            for b in batches:
                data, off = textcore.utf8(b.column(0))
                y.extend(b.column(1).to_pylist())
                for i in range(b.num_rows):
                    yield data[off[i] : off[i + 1]].tobytes()

        m = train(Training(texts()), np.array(y), share)
        yield pa.RecordBatch.from_arrays([pa.array(m), pa.array([v.tobytes() for v in m.values()], pa.binary()), pa.array([list(v.shape) for v in m.values()], pa.list_(pa.int64()))], ["name", "data", "shape"])

    found = rows.select("text", "y").repartition(1).sortWithinPartitions(F.xxhash64("text"), "text", "y").mapInArrow(run, "name string, data binary, shape array<long>")
    # nothing to learn from may leave no task at all
    return {r["name"]: np.frombuffer(r["data"], np.float32).reshape(r["shape"]) for r in found.collect()} or train(Training(iter(())), np.zeros(0))


def score(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, ``held_out``, ``score``, ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score_texts(shared.value, *textcore.utf8(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["id", "score"])

    scored = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, f"id {id_type}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(df: DataFrame, model: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """The rows whose text scores less than 0.5, with all their columns."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(score_texts(shared.value, *textcore.utf8(b.column(at))) < 0.5))

    return df.mapInArrow(run, df.schema)
