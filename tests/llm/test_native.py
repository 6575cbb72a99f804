"""Quality rules, mixing and preference formatting."""

import json
import random
from collections import Counter

import duckdb
from helpers import rows_of, rows_of_sql
from pyspark.sql import functions as F

from loomspan.llm import mixing, preference, quality
from loomspan.llm.sql import ORACLES

TEXTS = [None, "", "  \t", "a b c a b c x", "a b c d", "a a a a a", "x\nx\n\n \nx y\nx y", "é $ü# <b>|&% w\x0bq", "one two three " * 30, " ".join(map(str, range(200)))]


def brute(text):
    import re

    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    tri = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if tri[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in quality.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark):
    r = random.Random(1)
    texts = TEXTS + [" ".join(r.choice("ab cd e".split() + ["\n", "f"]) for _ in range(r.randrange(40))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("n_words", F.lit("z"))
    got = {r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in quality.judge(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    assert quality.judge(df.limit(0)).count() == 0


def test_verdict_and_rules(spark):
    good = "the cat and a dog went to the river of " + " ".join(f"word{i} the" for i in range(40))
    bad = " ".join(f"thing{i}$$$" for i in range(80))
    df = spark.createDataFrame([(1, good), (2, bad), (3, "the short one")], "doc_id long, text string")
    got = {r["doc_id"]: (r["base_failed"], r["kept"], set(r["failed_rules"])) for r in quality.judge(df).collect()}
    assert got[1][:2] == (False, True) and got[2] == (False, False, {"symbols_per_word", "stop_word_ratio"}) and got[3][:2] == (True, False)


def targets(sizes):
    """Targets by repeated sharing."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > 3 * sizes[s] + 1e-9]
        if not over:
            return fixed | {s: left * weight[s] / w for s in free}
        fixed |= {s: 3.0 * sizes[s] for s in over}


def test_mix(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["a", "b", "b", "b", "c", None, "d"]), "w " * r.choice([0, 1, 5, 30, 400]) if i % 9 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("target", F.lit(1)).withColumn("start", F.lit(2))
    mixed, schedule = mixing.mix_sources(df)
    got = mixed.collect()
    assert len(got) == 300 and all(0 <= x["taken"] <= 3 * x["size"] for x in got)
    sizes = Counter()
    for x in got:
        sizes[x["source"]] += x["size"]
    want = targets(dict(sizes))
    for s in sizes:
        assert abs(next(x["target"] for x in got if x["source"] == s) - want[s]) < 1e-6
        assert sum(x["taken"] for x in got if x["source"] == s) == round(want[s])
    again = sorted(map(str, mixing.mix_sources(df.repartition(7))[0].collect()))
    assert again == sorted(map(str, got))
    slots = schedule.where("slot is not null").orderBy("slot").collect()
    half = Counter(x["source"] for x in slots[: len(slots) // 2])
    every = Counter(x["source"] for x in slots)
    assert all(abs(half[s] - every[s] / 2) < 8 for s in every)  # the schedule is even all the way
    assert mixing.mix_sources(df.limit(0))[0].count() == 0


def test_mix_keeps_null_ids(spark, tmp_path):
    """Null ids stay, as many as the SQL has, and each source meets its target."""
    r = random.Random(6)
    rows = [(None if i % 3 == 0 else i, r.choice(["a", "b", "b", None]), "w " * r.choice([0, 1, 5, 5, 30, 400])) for i in range(240)]
    rows += [(None, "only nulls", "w " * n) for n in (3, 3, 7)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    df.write.parquet(str(tmp_path / "documents"))
    got = mixing.mix_sources(df)[0].select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots", "slot_sum")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert rows_of(got) == rows_of_sql(con, ORACLES["op9_mixing"])
    assert sum(x["doc_id"] is None for x in got.collect()) == sum(x[0] is None for x in rows)


def test_one_source_and_no_words(spark):
    df = spark.createDataFrame([(1, "a", ""), (2, "a", None)], "doc_id long, source string, text string")
    assert [x["taken"] for x in mixing.mix_sources(df)[0].collect()] == [0, 0]


def test_preference_pairs(spark):
    ddl = "id int, chosen array<struct<turn:bigint,role:string,text:string>>, rejected array<struct<turn:bigint,role:string,text:string>>"
    t = lambda *x: [(i, r, s) for i, (r, s) in enumerate(x)]
    same = (("user", "q"), ("assistant", "r"))
    rows = [(1, t(*same, ("user", "x"), ("assistant", "yes")), t(*same, ("user", "x"), ("assistant", "no"))), (2, t(*same), t(*same)), (3, t(("user", "a")), t(("user", "b"))), (4, t(*same), None), (5, [], [])]
    got = {r["id"]: r for r in preference.format_pairs(spark.createDataFrame(rows, ddl)).collect()}
    assert [got[i]["prompt_turns"] for i in range(1, 6)] == [3, 2, 0, 1, 0]
    a = got[1]
    assert a["prompt"] == "<|user|>\nq\n<|end|>\n<|assistant|>\nr\n<|end|>\n<|user|>\nx\n<|end|>\n"
    m = a["chosen_mask"][0]
    assert a["chosen_completion"][m["start"] : m["end"]] == "yes\n<|end|>\n" and a["rejected_completion"] == "<|assistant|>\nno\n<|end|>\n"
    assert got[2]["chosen_completion"] == got[2]["rejected_completion"] == "" and got[4]["rejected_completion"] is None
    assert got[3]["chosen_mask"] == []


def test_turns_with_nulls(spark):
    df = spark.createDataFrame([(1, 0, None, None), (1, 1, "assistant", "é"), (None, 0, "user", "x")], "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    got = preference.format_pairs(preference.pair_conversations(df)).collect()
    assert len(got) == 2 and json.dumps([r["prompt"] for r in got])
    assert preference.format_pairs(preference.pair_conversations(df.limit(0))).count() == 0
