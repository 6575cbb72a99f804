"""Repair of conversation structure by the cheapest edits, least audit first.

A conversation's turns should have roles of the form ``(system? (user assistant)+)?``.
Turns may be kept, given another role, deleted, and empty turns inserted, each at a cost;
of all cheapest edits the ones whose initials, in order, are the ASCII-least are made.
Costs to the end are a Viterbi recurrence over four states of that form, from the last
turn to the first; tracing then takes, from the first turn on, the least letter that
stays on a cheapest path.

Turns are sorted into ranges of (conversation, turn).  A conversation within one range is
repaired there.  One that crosses ranges, or is large, becomes chunks, which are solved in
parallel by rank convergence.  Each chunk starts at its right end from speculative cost
vectors: what it would be at the end of a conversation, and one for each state such that
any true vector is a (min, +) combination of the four.  Where the four results at the left
end differ only by constants, the chunk's vector is known, whatever follows; the others
take it over from their right neighbours, whose matrices are combined by doubling, so that
a conversation in which nothing converges takes a logarithm of its chunks in passes.  With
true vectors at right ends, chunks rerun until vectors differ only by constants from the
speculative ones, which then stand.  Tracing maps each state at a chunk's left end to one
at its right end; these maps are stitched in the same way.  Constants don't matter to the
trace, and costs are counted from the edits made.

Turns equal in role and text to an earlier one of a conversation in chunks are found by
aggregation over digests, never in a window over a conversation.  The digest of a repaired
conversation is of all of it, in order, so one task reads its chunks one after the other.

Defined results: null roles and texts read as one blank, and so do null ids and turns in
the damage's key; a null id is one conversation; turns come in order, nulls first, ties by
role and then by the text's SHA-256; repeated rows are repeated turns; other columns are
ignored; an empty table gives an empty result; a conversation without turns left has zeros,
an empty audit and the digest of nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspan.llm import common
from loomspan.operators import ranking

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing yet, after a system turn, after a user's, after an assistant's.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or rerolled turn, and that turn's role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: What a kept turn's initial leads to.
KEPT = {(BEGIN, "s"): SYSTEM, (BEGIN, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = {"su", "ua", "au"}
#: Cost to the end where no turn is left.
END = (0, 2 * INSERT, INSERT, 0)
#: For each state k the most by which other states' costs exceed its own, in any true
#: vector: another state can insert its way to k's plan, or delete a system turn of it.
#: Any true vector v is the least, over k, of v[k] + GENERATORS[k].
GENERATORS = (
    (0, DELETE + 2 * INSERT, DELETE + INSERT, DELETE),
    (0, 0, INSERT, 0),
    (INSERT, INSERT, 0, INSERT),
    (0, 2 * INSERT, INSERT, 0),
)
FAR = 1 << 40

SPACES = " \t\n\x0b\x0c\r"
NONE, BLANK, DUPLICATE, CUT_OFF = range(4)

SUMMED = ("blank", "duplicate", "truncated", "illegal", "cost")

#: Turns and bytes of a chunk, and from how many of them a conversation is in chunks.
CHUNK_TURNS, CHUNK_BYTES = 1024, 1 << 20
LARGE_TURNS, LARGE_BYTES = 4096, 4 << 20

PIECE = (
    "piece long, alone boolean, first_role string, last_role string, first_turn long, last_turn long, n_turns long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired string"
)
CHUNK = "part long, chunk long, turns array<long>, roles array<string>, texts array<string>, digests array<binary>"


def damage(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Damages turns by a checksum of ``id:turn`` modulo 20: 0 drops one, 1 empties its
    text, 2 takes its sentence ends away, 3 repeats it (``copies``), 4 makes it a user's."""
    blank = lambda c: F.coalesce(df[c].cast("string"), F.lit(" "))
    m = F.crc32(F.concat(blank(id_col), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(m == 1, "").when(m == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    turns = df.select(df[id_col].alias(id_col), df["turn"].cast("long").alias("turn"), F.when(m == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), F.when(m == 3, 2).otherwise(1).alias("copies"), m.alias("_m"))
    return turns.where("_m <> 0").drop("_m")


# --- the recurrence over a list of turns: (initial, fault) ---


def _before(turn: tuple[str, int], v: tuple[int, ...]) -> tuple[int, ...]:
    """The cost vector before a turn from that behind it."""
    initial, fault = turn
    if fault in (BLANK, DUPLICATE):
        return (v[0] + DELETE, v[1] + DELETE, v[2] + DELETE, v[3] + DELETE)
    extra = TRUNCATED if fault == CUT_OFF else 0
    b = []
    for s in range(4):
        c = min(v[s] + DELETE, v[NEXT[s]] + REROLE + extra)
        to = KEPT.get((s, initial))
        b.append(c if to is None else min(c, v[to] + KEEP + extra))
    user, assistant = min(b[USER], b[ASSISTANT] + INSERT), min(b[ASSISTANT], b[USER] + INSERT)
    return (min(b[BEGIN], user + INSERT), min(b[SYSTEM], user + INSERT), user, assistant)


def backward(turns: list[tuple[str, int]], v: tuple[int, ...]) -> list[tuple[int, ...]]:
    """The vectors before each turn, and ``v`` behind the last."""
    out = [v]
    for t in reversed(turns):
        v = _before(t, v)
        out.append(v)
    return out[::-1]


def parallel(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether two vectors differ only by a constant."""
    return len({x - y for x, y in zip(a, b)}) == 1


def rerun(turns: list[tuple[str, int]], stored: list[tuple[int, ...]], v: tuple[int, ...]) -> list[tuple[int, ...]]:
    """``stored`` put right for ``v`` behind the last turn, up to a constant: vectors are
    made anew from the right until one differs from the stored one only by a constant."""
    fresh, i = [v], len(turns)
    while not parallel(v, stored[i]) and i:
        i -= 1
        v = _before(turns[i], v)
        fresh.append(v)
    off = v[0] - stored[i][0] if parallel(v, stored[i]) else 0
    kept = stored[: i + 1] if parallel(v, stored[i]) else [v]
    return kept + [tuple(x - off for x in w) for w in reversed(fresh[:-1])]


def trace(turns: list[tuple[str, int]], vectors: list[tuple[int, ...]], state: int, last: bool) -> tuple[str, list[int], int]:
    """From ``state`` on: the least audit, the state after each edit, and the last state.
    Turns are inserted behind the last one only where nothing follows."""
    audit, states, i = [], [], 0
    while i < len(turns) or (last and state in (SYSTEM, USER)):
        here = vectors[i][state]
        initial, fault = turns[i] if i < len(turns) else ("", NONE)
        extra = TRUNCATED if fault == CUT_OFF else 0
        to = KEPT.get((state, initial))
        if i < len(turns) and vectors[i + 1][state] + DELETE == here:
            edit = "D"
        elif vectors[i][NEXT[state]] + INSERT == here:
            edit, state = "I", NEXT[state]
        elif to is not None and vectors[i + 1][to] + KEEP + extra == here:
            edit, state = "K", to
        else:
            edit, state = "R", NEXT[state]
        i += edit != "I"
        audit.append(edit)
        states.append(state)
    return "".join(audit), states, state


def fault_of(text: str, again: bool) -> int:
    ink = text.rstrip(SPACES)
    return BLANK if not ink else DUPLICATE if again else CUT_OFF if ink[-1] not in ".!?" else NONE


def _made(number: int, alone: bool, turns: list[int | None], roles: list[str], texts: list[str], faults: list[int], audit: str, states: list[int]) -> dict:
    """A piece of a repaired conversation: counts, audit and text."""
    lines, cost, i = [], 0, 0
    for edit, state in zip(audit, states):
        if edit == "D":
            cost += DELETE
        elif edit == "I":
            cost += INSERT
            lines.append(f"{ROLE[state]}:")
        else:
            cost += (REROLE if edit == "R" else KEEP) + (TRUNCATED if faults[i] == CUT_OFF else 0)
            lines.append(f"{ROLE[state] if edit == 'R' else roles[i]}:{texts[i]}")
        i += edit != "I"
    known = [t for t in turns if t is not None]
    initials = [r[:1] for r in roles]
    return {
        "piece": number, "alone": alone, "first_role": initials[0] if initials else None, "last_role": initials[-1] if initials else None, "first_turn": min(known, default=None), "last_turn": max(known, default=None),
        "n_turns": len(set(known)), "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT_OFF), "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired": "\n".join(lines),
    }


def _whole(turns: list[int | None], roles: list[str], texts: list[str]) -> dict:
    """A conversation repaired at once."""
    seen: set[tuple[str, str]] = set()
    faults = []
    for said in zip(roles, texts):
        faults.append(fault_of(said[1], said in seen))
        seen.add(said)
    steps = list(zip((r[:1] for r in roles), faults))
    audit, states, _ = trace(steps, backward(steps, END), BEGIN, True)
    return _made(0, True, turns, roles, texts, faults, audit, states)


def _digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()


class _Open:
    """Turns of the conversation that a task is reading."""

    def __init__(self, conv, chunked: bool):
        self.conv, self.chunked = conv, chunked
        self.empty()

    def empty(self) -> None:
        self.turns, self.roles, self.texts, self.bytes = [], [], [], 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(role) + len(text)


def _in_ranges(schema: T.StructType) -> Callable:
    """Reads sorted turns; writes pieces of conversations within the range, and chunks of
    the first and the last one, which may go on in the ranges beside it, and of large ones."""
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n_chunks, rows, held = TaskContext.get().partitionId(), 0, [], 0
        now: _Open | None = None

        def chunk(o: _Open) -> None:
            nonlocal n_chunks, held
            digests = [_digest(r, t) for r, t in zip(o.roles, o.texts)]
            rows.append({"conv": o.conv, "part": part, "chunk": n_chunks, "turns": o.turns, "roles": o.roles, "texts": o.texts, "digests": digests})
            n_chunks += 1
            held += o.bytes
            o.empty()

        def chunks(o: _Open) -> None:
            """A large conversation's first turns, cut as those that follow will be."""
            parts, o2 = list(zip(o.turns, o.roles, o.texts)), _Open(o.conv, True)
            o.empty()
            for p in parts:
                o2.add(*p)
                if len(o2.turns) >= CHUNK_TURNS or o2.bytes >= CHUNK_BYTES:
                    chunk(o2)
            o.turns, o.roles, o.texts, o.bytes = o2.turns, o2.roles, o2.texts, o2.bytes
            o.chunked = True

        def done() -> pa.RecordBatch:
            nonlocal held
            out = pa.RecordBatch.from_pylist(rows, fields)
            rows.clear()
            held = 0
            return out

        for b in batches:
            for conv, turn, role, text, copies in zip(*(b.column(i).to_pylist() for i in range(5))):
                if now is None or conv != now.conv:
                    if now is not None and now.turns:
                        if now.chunked:
                            chunk(now)
                        else:
                            rows.append({"conv": now.conv, **_whole(now.turns, now.roles, now.texts)})
                            held += now.bytes
                    now = _Open(conv, now is None)
                for _ in range(copies):
                    now.add(turn, role, text)
                if now.chunked and (len(now.turns) >= CHUNK_TURNS or now.bytes >= CHUNK_BYTES):
                    chunk(now)
                elif not now.chunked and (len(now.turns) >= LARGE_TURNS or now.bytes >= LARGE_BYTES):
                    chunks(now)
                if held > CHUNK_BYTES or len(rows) >= 2000:
                    yield done()
        if now is not None and now.turns:
            chunks(now) if not now.chunked else None
            if now.turns:
                chunk(now)
        if rows:
            yield done()

    return run


# --- chunks: matrices of sixteen numbers, row by row, and vectors of four ---


def _times(m: Column, v: Column) -> Column:
    """A matrix on a vector: per row the least sum."""
    row = lambda i: F.least(F.lit(FAR), *(m[i * 4 + k] + v[k] for k in range(4)))
    return F.array(*(row(i) for i in range(4)))


def _product(a: Column, b: Column) -> Column:
    entry = lambda i, j: F.least(F.lit(FAR), *(a[i * 4 + k] + b[k * 4 + j] for k in range(4)))
    return F.array(*(entry(i, j) for i in range(4) for j in range(4)))


def stitch(links: DataFrame) -> DataFrame:
    """``at`` and its vector, from rows ``at, next, vector, matrix``: a row without a
    vector has its matrix on that of ``next``.  Each pass halves the way to a known one."""
    links = common.written(links, "repair-links")
    while not links.where("vector is null").isEmpty():
        n = links.select(*(F.col(c).alias(f"n_{c}") for c in links.columns))
        joined = links.join(n, F.col("next") == F.col("n_at"), "left")
        vector = F.coalesce("vector", F.when(F.col("n_vector").isNotNull(), _times(F.col("matrix"), F.col("n_vector"))))
        matrix = F.when(F.col("vector").isNull() & F.col("n_vector").isNull(), _product(F.col("matrix"), F.col("n_matrix")))
        later = common.written(joined.select("at", F.col("n_next").alias("next"), vector.alias("vector"), matrix.alias("matrix")), "repair-links")
        common.discard(links)
        links = later
    return links.select("at", "vector")


def _speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        faults, initials, stored, matrices, vectors = [], [], [], [], []
        for roles, texts, firsts, last in zip(*(b.column(i).to_pylist() for i in range(1, 5))):
            first = set(firsts or ())
            faults.append([fault_of(t, i not in first) for i, t in enumerate(texts)])
            initials.append([r[:1] for r in roles])
            steps = list(zip(initials[-1], faults[-1]))
            spec = backward(steps, END)
            left = [backward(steps, g)[0] for g in GENERATORS]
            stored.append([x for v in spec for x in v])
            matrices.append([left[k][s] for s in range(4) for k in range(4)])
            known = last or all(parallel(left[0], v) for v in left)
            vectors.append(list(spec[0]) if known else None)
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        arrays = [b.column(0), pa.array(initials, pa.list_(pa.string())), pa.array(faults, ints), pa.array(stored, longs), pa.array(matrices, longs), pa.array(vectors, longs)]
        yield pa.RecordBatch.from_arrays(arrays, ["at", "initials", "faults", "stored", "matrix", "vector"])


def _ready(row: dict) -> tuple[list, list]:
    """A chunk's turns and its true vectors, up to a constant."""
    steps, flat = list(zip(row["initials"], row["faults"])), row["stored"]
    stored = [tuple(flat[i : i + 4]) for i in range(0, len(flat), 4)]
    return steps, rerun(steps, stored, tuple(row["behind"]))


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk the state at its right end for each at its left end, as a matrix that
    takes costs of states at the left end to those at the right one."""
    for b in batches:
        at, matrices, vectors = [], [], []
        for row in b.to_pylist():
            steps, v = _ready(row)
            to = [trace(steps, v, s, row["last"])[2] for s in range(4)]
            at.append(row["at"])
            matrices.append([0 if to[k] == s else FAR for s in range(4) for k in range(4)])
            known = to[BEGIN] if row["first"] else to[0] if len(set(to)) == 1 else None
            vectors.append(None if known is None else [0 if s == known else FAR for s in range(4)])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(matrices, pa.list_(pa.int64())), pa.array(vectors, pa.list_(pa.int64()))], ["at", "matrix", "vector"])


def _traced(schema: T.StructType) -> Callable:
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                steps, v = _ready(row)
                audit, states, _ = trace(steps, v, row["entry"], row["last"])
                piece = _made(row["at"], False, row["turns"], row["roles"], row["texts"], row["faults"], audit, states)
                yield pa.RecordBatch.from_pylist([{"conv": row["conv"], **piece}], fields)

    return run


def _schema(spark: SparkSession, kind: str, rest: str) -> T.StructType:
    return T.StructType([T.StructField("conv", T._parse_datatype_string(kind)), *T._parse_datatype_string(rest).fields])


def _chunk_pieces(chunks: DataFrame, schema: T.StructType) -> DataFrame:
    """Repaired pieces of conversations in chunks."""
    named = common.written(ranking.numbered(chunks, F.asc("part"), F.asc("chunk"), name="at"), "repair-chunks")
    # of each text of a conversation the first place, then by chunk the turns that are first
    said = named.select("conv", "at", F.posexplode("digests").alias("i", "digest"))
    first = said.groupBy("conv", "digest").agg(F.min(F.struct("at", "i")).alias("f")).groupBy(F.col("f.at").alias("f_at")).agg(F.collect_list("f.i").alias("firsts"))
    beside = lambda d, name: named.select((F.col("at") + d).alias(f"{name}_at"), F.col("conv").alias(f"{name}_conv"))
    same = lambda name: (F.col("at") == F.col(f"{name}_at")) & F.col("conv").eqNullSafe(F.col(f"{name}_conv"))
    placed = named.join(first, F.col("at") == F.col("f_at"), "left").join(beside(1, "left"), same("left"), "left").join(beside(-1, "right"), same("right"), "left")
    placed = placed.withColumn("first", F.col("left_at").isNull()).withColumn("last", F.col("right_at").isNull())
    placed = common.written(placed.select("conv", "at", "turns", "roles", "texts", "firsts", "first", "last"), "repair-placed")
    spec = placed.select("at", "roles", "texts", "firsts", "last").mapInArrow(_speculate, "at long, initials array<string>, faults array<int>, stored array<long>, matrix array<long>, vector array<long>")
    spec = common.written(spec, "repair-spec")
    links = spec.join(placed.select("at", "first", "last"), "at")
    left = stitch(links.select("at", F.when(~F.col("last"), F.col("at") + 1).alias("next"), "vector", "matrix"))
    behind = left.select((F.col("at") - 1).alias("b_at"), F.col("vector").alias("b"))
    end = F.array(*map(F.lit, END)).cast("array<long>")
    solved = links.join(behind, F.col("at") == F.col("b_at"), "left").withColumn("behind", F.when(F.col("last"), end).otherwise(F.col("b")))
    solved = common.written(solved.select("at", "initials", "faults", "stored", "behind", "first", "last"), "repair-solved")
    maps = solved.mapInArrow(_maps, "at long, matrix array<long>, vector array<long>")
    firsts = solved.select(F.col("at").alias("s_at"), "first")
    right = stitch(maps.join(firsts, F.col("at") == F.col("s_at")).select("at", F.when(~F.col("first"), F.col("at") - 1).alias("next"), "vector", "matrix"))
    come = right.select((F.col("at") + 1).alias("e_at"), (F.array_position("vector", F.lit(0).cast("long")) - 1).cast("int").alias("e"))
    texts = placed.select(F.col("at").alias("t_at"), "conv", "turns", "roles", "texts")
    entry = solved.join(come, F.col("at") == F.col("e_at"), "left").withColumn("entry", F.when(F.col("first"), BEGIN).otherwise(F.col("e")))
    rows = entry.join(texts, F.col("at") == F.col("t_at")).select("conv", "at", "turns", "roles", "texts", "initials", "faults", "stored", "behind", "entry", "last")
    return rows.mapInArrow(_traced(schema), schema)


def repair(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Pieces of repaired conversations: ``conv``, ``piece``, which gives their order,
    ``audit`` and ``repaired``, the turns as ``role:text`` lines, with counts; most
    conversations are one piece.  ``turns`` has ``turn, role, text, copies``."""
    spark = turns.sparkSession
    common.bound_batches(spark)
    kind = turns.schema[id_col].dataType.simpleString()
    schema, piece = _schema(spark, kind, f"{PIECE}, {CHUNK}"), _schema(spark, kind, PIECE)
    keyed = turns.select(turns[id_col].alias("conv"), "turn", "role", "text", "copies", F.sha2(F.col("text").cast("binary"), 256).alias("_d"), F.monotonically_increasing_id().alias("_row"))
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", "role", "_d", "_row")]
    sorted_turns = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text", "copies")
    out = common.written(sorted_turns.mapInArrow(_in_ranges(schema), schema), "repair-ranges")
    whole = out.where("piece is not null").select(*piece.fieldNames())
    cut = out.where("chunk is not null").select("conv", "part", "chunk", "turns", "roles", "texts", "digests")
    return whole.unionByName(_chunk_pieces(cut, piece))


class _Sum:
    """Pieces of one conversation, put together in order."""

    def __init__(self, conv):
        self.conv, self.n = conv, dict.fromkeys(SUMMED, 0)
        self.audits, self.sha, self.some = [], hashlib.sha256(), False
        self.least = self.most = self.role = None
        self.distinct = 0

    def add(self, row: dict) -> None:
        for k in SUMMED:
            self.n[k] += row[k]
        # what stands on both sides of a cut: two roles, and perhaps one turn
        self.n["illegal"] += self.role is not None and self.role + row["first_role"] not in LEGAL
        self.role = row["last_role"]
        if row["first_turn"] is not None:
            self.distinct += row["n_turns"] - (self.most == row["first_turn"])
            self.least = row["first_turn"] if self.least is None else self.least
            self.most = row["last_turn"]
        self.audits.append(row["audit"])
        if row["repaired"]:
            self.sha.update((("\n" if self.some else "") + row["repaired"]).encode())
            self.some = True

    def result(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        return (self.conv, gaps, *self.n.values(), "".join(self.audits), self.sha.hexdigest())


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds pieces that follow each other into one row per conversation."""
    now, kind = None, None

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["conv", "gaps", *SUMMED, "audit", "repaired_sha256"])

    for b in batches:
        kind, rows = b.schema.field(0).type, []
        for row in b.to_pylist():
            if now is None or now.conv != row["conv"]:
                if now is not None:
                    rows.append(now.result())
                now = _Sum(row["conv"])
            now.add(row)
        if rows:
            yield batch(rows)
    if now is not None:
        yield batch([now.result()])


def digests(pieces: DataFrame, ids: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation of ``ids``: ``gaps``, counts of faults, ``cost``,
    ``audit`` and ``repaired_sha256``."""
    kind = pieces.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    columns = ["conv", "piece", "first_role", "last_role", "first_turn", "last_turn", "n_turns", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"]
    # of a conversation in pieces all are read in order, by one task, as their digest is one
    several = pieces.where("not alone").select(columns).repartition("conv").sortWithinPartitions("conv", "piece")
    found = pieces.where("alone").select(columns).mapInArrow(_joined, schema).unionByName(several.mapInArrow(_joined, schema))
    every = ids.select(ids[id_col].alias("_id")).distinct()
    out = every.join(found, F.col("_id").eqNullSafe(F.col("conv")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return out.select(F.col("_id").alias(id_col), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
