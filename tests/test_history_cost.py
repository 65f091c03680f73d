"""Streams over a long history: what a micro-batch costs besides its rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tradewind import session
from tradewind.plans.queries import QUERIES
from tradewind.streaming import staging


@pytest.mark.parametrize("name", ["j1_lines_await_goods", "t8_once_each", "c4_unpaid_orders_job"])
def test_state_has_two_partitions_a_core(spark, root, monkeypatch, name):
    seen, feed = set(), staging.Staged.feed

    def noted(self, query, *more):
        feed(self, query, *more)
        seen.update(o.numShufflePartitions for p in query.recentProgress for o in p.stateOperators)

    monkeypatch.setattr(staging.Staged, "feed", noted)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "40")
    try:
        QUERIES[name](session.ensure(spark), root)
        assert seen == {2 * spark.sparkContext.defaultParallelism} and spark.conf.get(key) == "40"
    finally:
        spark.conf.set(key, before)


def test_ranges_are_found_by_halving(spark):
    for cuts in ([], [5], [1, 4, 9, 16, 25, 36]):
        got = spark.range(-3, 40).select("id", staging._range_of(F.col("id"), cuts)).collect()
        assert all(n == sum(c <= i for c in cuts) for i, n in got)
