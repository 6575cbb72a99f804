"""Monitors of a whole run and ranks over a whole table, against plain versions."""

import random
from functools import reduce

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomspan.operators import calibration, metrics, monitoring, ranking
from loomspan.operators.monitoring import Run, Summary, fraction, of_rows


def plain(rows, limit, least, in_a_row):
    """(longest, first, last), first place of ``in_a_row`` failures, first breach."""
    best, now, start, reached, breach, hits = (0, None, None), 0, None, None, None, 0
    for n, (seq, failed, hit) in enumerate(rows, 1):
        now, start = (now + 1, start if now else seq) if failed else (0, None)
        best = (now, start, seq) if now > best[0] else best
        reached = seq if reached is None and now >= in_a_row else reached
        hits += hit
        if breach is None and n >= least and hits / n > limit:
            breach = {"seq": seq, "seen": n, "hits": hits, "rate": hits / n}
    return best, reached, breach


ROWS = st.lists(st.tuples(st.booleans(), st.booleans()), max_size=60)


@settings(max_examples=200, deadline=None)
@given(ROWS, st.lists(st.integers(0, 60), max_size=6), st.sampled_from([0.3, 0.5, 0.25, 1.0, 0.0]))
def test_summaries_merge_in_any_cuts(rows, cuts, limit):
    seq = np.arange(len(rows)) * 3 + 5
    failed, hit = (np.array([r[k] for r in rows], bool) for k in (0, 1))
    edges = sorted({0, len(rows), *(c for c in cuts if c < len(rows))})
    parts = [of_rows(seq[a:b], failed[a:b], hit[a:b], fraction(limit)) for a, b in zip(edges, edges[1:])]
    whole = of_rows(seq, failed, hit, fraction(limit))
    assert reduce(Summary.merge, parts, Summary()) == whole
    want = plain(list(zip(seq.tolist(), failed.tolist(), hit.tolist())), limit, 1, 1)
    assert (whole.longest, whole.longest_lo, whole.longest_hi) == want[0]
    assert (whole.n > 0 and whole.best > 0) == (want[2] is not None)


@pytest.mark.parametrize("kind", ["mixed", "all", "none", "late", "empty"])
def test_run_over_many_ranges(spark, kind):
    r = random.Random(kind)
    p = {"mixed": 0.5, "all": 1, "none": 0, "late": 0.1, "empty": 0}[kind]
    rows = [(i * 2, r.random() < p, r.random() < (0.2 if i < 700 else 0.6)) for i in range(0 if kind == "empty" else 1200)]
    df = spark.createDataFrame(r.sample(rows, len(rows)), "seq long, bad boolean, hit boolean")
    run = Run(df, "seq", F.col("bad"), F.col("hit"), 0.3)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        longest = tuple(run.longest_failure().first())
        for least, in_a_row in ((1, 1), (100, 3), (1100, 7), (5000, 5000)):
            assert (longest, run.first_failures(in_a_row), run.first_breach(least)) == plain(rows, 0.3, least, in_a_row)
        assert len(run.blocks()) == (0 if kind == "empty" else 9)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_places_sums_and_medians(spark):
    r = random.Random(4)
    rows = [(i, r.choice(["a", "b", None]), r.choice([None, *range(9)]), r.random()) for i in range(600)]
    df = spark.createDataFrame(rows, "i long, g string, v long, x double")
    placed = ranking.numbered(df, F.desc("v"), F.asc("i"))
    want = {x[0]: k for k, x in enumerate(sorted(rows, key=lambda x: (-1 if x[2] is None else x[2]) * -1000 + x[0]), 1)}
    assert {x["i"]: x["place"] for x in placed.collect()} == want
    sums = ranking.running_sums(df.where("v is not null"), ["v", "i"], "v")
    total, expect = 0, {}
    for i, _, v, _ in sorted((x for x in rows if x[2] is not None), key=lambda x: (x[2], x[0])):
        total += v
        expect[i] = total
    assert {x["i"]: x["upto"] for x in sums.collect()} == expect
    for g in ("a", "b", None):
        values = sorted(x[3] for x in rows if x[1] == g)
        assert {x["g"]: x["median"] for x in metrics.upper_median(df, "x", "g").collect()}[g] == values[len(values) // 2]
    assert metrics.upper_median(df.limit(0), "x").collect() == []
    ranks = {x["v"]: x["v_rank"] for x in ranking.average_ranks(df.where("v is not null"), "v").collect()}
    ordered = sorted(x[2] for x in rows if x[2] is not None)
    assert all(rank == 1 + np.mean([k for k, y in enumerate(ordered) if y == v]) for v, rank in ranks.items())
    assert calibration.spearman(df.select(F.col("x").alias("judge"), (-F.col("x")).alias("human"))).first()["rho"] == pytest.approx(-1)


def test_no_window_over_one_key(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"), F.rand(3).alias("w"))
    for out in (ranking.average_ranks(df, "v"), metrics.upper_median(df, "w")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan.split("Window")[-1] or "Window" not in plan


def test_why_a_run_stops():
    limit = fraction(0.005)
    rows = lambda failed, hit: of_rows(np.arange(len(failed)), np.array(failed, bool), np.array(hit, bool), limit)
    assert monitoring.stop_reason(rows([1] * 5, [0] * 5), 5, 1000) == "consecutive_failures"
    assert monitoring.stop_reason(rows([0] * 1000, [1] * 6 + [0] * 994), 5, 1000) == "discard_rate"
    assert monitoring.stop_reason(rows([0] * 1000, [1] * 5 + [0] * 995), 5, 1000) is None
    assert monitoring.stop_reason(rows([0] * 999, [1] * 999), 5, 1000) is None
