"""Slices that hold a burst are cut between events of one instant; matches stay the same."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tradewind.operators import patterns
from tradewind.plans.queries import QUERIES


def as_frame(spark, events):
    return spark.createDataFrame(events, "k int, s bigint, n int, t string").withColumn("ts", F.timestamp_seconds("s"))


def test_one_instant_of_one_key_is_many_tasks(spark):
    n, burst = 100_000, 5_000
    # One key, one second; another key has few rows, a third has no time.
    df = spark.range(n).select(F.lit(1).alias("k"), F.timestamp_seconds(F.lit(50)).alias("ts"), F.col("id").cast("int").alias("n"),
                               F.when(F.xxhash64("id") % 3 == 0, "a").otherwise("b").alias("t"))
    df = df.unionByName(spark.createDataFrame([(2, 50, -1, "a"), (2, 51, -2, "b"), (3, None, -3, "a")],
                                              "k int, s bigint, n int, t string").select("k", F.timestamp_seconds("s").alias("ts"), "n", "t"))
    cuts = patterns.burst_cuts(df, "k", "ts", "n", burst=burst)
    assert [r.k for r in cuts.collect()] == [1]
    parts = patterns._cut(patterns._in_slices(df, "k", "ts", patterns.SLICE_SECONDS), "k", "n", cuts)
    sizes = [r["count"] for r in parts.where("k = 1").groupBy("_slice").count().collect()]
    assert sum(sizes) == n and len(sizes) >= n // burst // 2 and max(sizes) < 3 * burst

    flags = [r.t for r in df.where("k = 1").orderBy("n").collect()]
    pair = patterns.sequence_match(df, "k", "ts", "n", [patterns.Step(F.col("t") == "a"), patterns.Step(F.col("t") == "b", patterns.NEXT)],
                                   7, keep=["n"], cuts=cuts)
    want = [(i, i + 1) for i in range(n - 1) if flags[i] == "a" and flags[i + 1] == "b"] + [(-1, -2)]
    assert sorted((r.s0.n, r.s1.n) for r in pair.collect()) == sorted(want)
    run = patterns.repeat_match(df, "k", "ts", "n", F.lit(True), 4, 20, same="t", keep=["n"], cuts=cuts)
    assert sorted(r.n for r in run.collect()) == [i for i in range(n - 3) if len(set(flags[i:i + 4])) == 1]


@pytest.mark.parametrize("slice_seconds, burst", [(50, 10), (1000, 3), (1000, 100)])
def test_cuts_change_no_match(spark, slice_seconds, burst):
    rnd = random.Random(burst)
    df = as_frame(spark, [(rnd.choice([0, 0, 0, 1, 2]), rnd.choice([7, 7, rnd.randrange(-200, 300)]), i, rnd.choice("abc")) for i in range(700)])
    cuts = patterns.burst_cuts(df, "k", "ts", "n", slice_seconds=slice_seconds, burst=burst)
    assert cuts is not None
    is_ = lambda x: F.col("t") == x
    for how in ([patterns.Step(is_("a")), patterns.Step(is_("b"))],
                [patterns.Step(is_("a")), patterns.Step(is_("b"), patterns.NEXT), patterns.Step(is_("c"))]):
        got = [sorted(map(str, patterns.sequence_match(df, "k", "ts", "n", how, 30, keep=["n"], timeouts=True, slice_seconds=slice_seconds,
                                                       cuts=c).collect())) for c in (None, cuts)]
        assert got[0] == got[1]
    got = [sorted(map(str, patterns.repeat_match(df, "k", "ts", "n", F.col("t") != "c", 3, 40, keep=["n"], slice_seconds=slice_seconds,
                                                 cuts=c).collect())) for c in (None, cuts)]
    assert got[0] == got[1]


def test_nothing_to_cut(spark):
    df = as_frame(spark, [(1, i, i, "a") for i in range(20)])
    assert patterns.burst_cuts(df, "k", "ts", "n") is None
    assert patterns.burst_cuts(df.where("false"), "k", "ts", "n", burst=1) is None


def test_queries_with_bursts_really_cut(spark, root):
    for name in ("c1_fail_then_success_bursts", "c2b_repeated_same_bursts", "c3_paid_or_timeout_bursts"):
        with_cuts, plain = QUERIES[name](spark, root), QUERIES[name.replace("_bursts", "")](spark, root)
        assert "_cuts" in with_cuts._jdf.queryExecution().toString()
        assert sorted(map(str, with_cuts.collect())) == sorted(map(str, plain.collect()))
