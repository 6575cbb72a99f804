"""Repair of conversations against a plain version."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

from helpers import DATA, duck, rows_of, rows_of_sql

from loomspan.llm import repair
from loomspan.llm.registry import QUERIES
from loomspan.llm.sql import ORACLES

DDL = "conv_id long, turn long, role string, text string, audit string, piece long"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, m = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        if m == 0:
            continue
        text = "" if m == 1 else re.sub("[.!?]", "", text) if m == 2 else text
        out += [(conv, turn, "user" if m == 4 else role, text)] * (2 if m == 3 else 1)
    return out


def cheapest(turns):
    """(cost, audit) by recursion over all edits; ``turns`` of (initial, fault)."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @cache
    def best(i, s, inserts):
        found = [(0, "")] if i == len(turns) and s in (0, 3) else []
        add = lambda cost, letter, rest: found.append((cost + rest[0], letter + rest[1]))
        if inserts < 2:
            add(3, "I", best(i, 3 if s == 2 else 2, inserts + 1))
        if i < len(turns):
            initial, fault = turns[i]
            add(4, "D", best(i + 1, s, 0))
            if fault not in (repair.BLANK, repair.DUPLICATE):
                extra = 3 if fault == repair.CUT_OFF else 0
                add(3 + extra, "R", best(i + 1, 3 if s == 2 else 2, 0))
                if (s, initial) in step:
                    add(extra, "K", best(i + 1, step[s, initial], 0))
        return min(found, default=(10**9, ""))

    for i in range(len(turns), -1, -1):
        for s, k in itertools.product(range(4), (2, 1, 0)):
            best(i, s, k)
    return best(0, 0, 0)


def brute(rows):
    out, sha = [], lambda x: hashlib.sha256(x.encode()).hexdigest()
    kept = damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha(r[3])))
        faults, seen = [], set()
        for _, _, role, text in mine:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append(repair.BLANK if not ink else repair.DUPLICATE if (role, text) in seen else repair.CUT_OFF if ink[-1] not in ".!?" else repair.NONE)
            seen.add((role, text))
        initials = [r[2][:1] for r in mine]
        cost, audit = cheapest(tuple(zip(initials, faults)))
        lines, i, state = [], 0, 0
        for e in audit:
            if e == "K":
                lines.append(f"{mine[i][2]}:{mine[i][3]}")
                state = {"s": 1, "u": 2, "a": 3}[initials[i]]
            elif e in "RI":
                state = 3 if state == 2 else 2
                lines.append(("user" if state == 2 else "assistant") + ":" + (mine[i][3] if e == "R" else ""))
            i += e != "I"
        known = [r[1] for r in mine if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, gaps, *(faults.count(k) for k in (repair.BLANK, repair.DUPLICATE, repair.CUT_OFF)), illegal, cost, audit, sha("\n".join(lines))))
    return sorted(out, key=repr)


def conversations(r, n_convs, longest, roles=("user", "assistant", "system", "tool", "", None)):
    rows = []
    for c in [None, *range(n_convs)]:
        kind = r.randrange(4)
        for t in range(r.randrange(longest)):
            role = ("user", "assistant")[t % 2] if kind < 2 and r.random() < 0.8 else r.choice(roles)
            text = r.choice(["Yes.", "no", " \t", "", None, f"text {t}.", f"other {t}! ", f"cut {t},", "é?\x0b"])
            rows.append((c, None if r.random() < 0.05 else t if kind else r.randrange(longest), role, text))
            if r.random() < 0.05:
                rows.append(rows[-1])
    r.shuffle(rows)
    return rows


def got(spark, rows):
    df = spark.createDataFrame([(*x, "x", 1) for x in rows], DDL).repartition(5)
    out = repair.digests(repair.repair(repair.damage(df)), df)
    return sorted((tuple(r[c] for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in out.collect()), key=repr)


def test_small_conversations(spark):
    rows = conversations(random.Random(1), 60, 14)
    assert got(spark, rows) == brute(rows)


def test_chunks_of_large_conversations(spark):
    """Three conversations hold most rows: a mixed one, one of a single kind of turn, in
    which no chunk's vectors converge, and one of equal turns.  Ranges cut them."""
    r = random.Random(2)
    rows = conversations(r, 8, 9)
    rows += [(100, t, r.choice(("user", "assistant", "system")), f"text {t % 90}.") for t in range(9000)]
    rows += [(101, t, "tool", f"text {t}.") for t in range(9000)]
    rows += [(102, t, "user", "the same") for t in range(6000)]
    assert got(spark, rows) == brute(rows)


def test_empty_and_all_dropped(spark):
    assert got(spark, []) == []
    dropped = [(c, t, "user", "Hi.") for c in range(40) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert got(spark, dropped) == brute(dropped) and all(x[7] == "" for x in got(spark, dropped))
    one = [(1, None, None, None)] * 3 + [(2, 1, "", "x" * 100000 + ".")]
    assert got(spark, one) == brute(one)


def steps_of(r, n):
    return [(r.choice(["s", "u", "a", "t", ""]), r.choices(range(4), (5, 1, 1, 2))[0]) for _ in range(n)]


def test_vectors_are_combinations_of_the_generators():
    r = random.Random(4)
    for _ in range(400):
        v = repair.backward(steps_of(r, r.randrange(9)), repair.END)[0]
        assert all(v[j] <= v[k] + repair.GENERATORS[k][j] for k in range(4) for j in range(4))
        steps = steps_of(r, r.randrange(12))
        left = [repair.backward(steps, g)[0] for g in repair.GENERATORS]
        true = repair.backward(steps, v)
        assert true[0] == tuple(min(v[k] + left[k][s] for k in range(4)) for s in range(4))
        mended = repair.rerun(steps, repair.backward(steps, repair.END), v)
        assert len(mended) == len(true) and all(repair.parallel(a, b) for a, b in zip(mended, true))
        assert len({b[0] - a[0] for a, b in zip(mended, true)}) == 1


def test_trace_equals_recursion():
    r = random.Random(5)
    for _ in range(300):
        steps = steps_of(r, r.randrange(10))
        vectors = repair.backward(steps, repair.END)
        cost, audit = cheapest(tuple(steps))
        assert (vectors[0][0], repair.trace(steps, vectors, repair.BEGIN, True)[0]) == (cost, audit)


def test_stitching_by_doubling(spark):
    r = random.Random(6)
    chunks = [[("t", 0)] * r.choice((1, 2, 3)) for _ in range(40)]
    want, rows, v = {}, [], repair.END
    for i in range(39, -1, -1):
        left = [repair.backward(chunks[i], g)[0] for g in repair.GENERATORS]
        v = repair.backward(chunks[i], v)[0]
        want[i] = list(v)
        rows.append((i, None if i == 39 else i + 1, list(v) if i == 39 else None, [left[k][s] for s in range(4) for k in range(4)]))
    out = repair.stitch(spark.createDataFrame(rows, "at long, next long, vector array<long>, matrix array<long>"))
    assert {x["at"]: x["vector"] for x in out.collect()} == want


def test_query_equals_sql(spark):
    assert rows_of(QUERIES["op13_repair"](spark, DATA)) == rows_of_sql(duck(), ORACLES["op13_repair"])


def test_query_equals_plain_version(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_repair"](spark, DATA).collect()), key=repr) == brute(rows)
