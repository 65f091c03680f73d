"""Streams of neighbouring events against their batch forms, with late and tied events; history in ranges bounds the state."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from test_streaming import to_folder, values
from tradewind.functions import times
from tradewind.operators import changefeed, metrics, patterns
from tradewind.sources import streams, tables
from tradewind.streaming import jobs, sequences, sinks, staging, timeouts

BASE = 1_600_000_000
DELAY = 40


@pytest.fixture(scope="module")
def events(spark):
    """Half of all events belong to one key; many share an instant; times end and begin at slice borders."""
    r = random.Random(3)
    rows, at = [], 0
    for i in range(600):
        at += r.choice([0, 0, 0, 1, 3, 10, 19])
        rows.append((r.choice(["hot", "hot", "a", "b", "c"]), i, at, r.choice("xxyyz") if r.random() < 0.95 else None, float(r.randint(0, 100))))
    rows += [(None, 9001, 50, "x", 1.0)]
    df = spark.createDataFrame(rows, "k string, id long, s long, v string, value double")
    return df.withColumn("ts", F.timestamp_seconds(F.col("s") + BASE)).drop("s")


@pytest.fixture
def live(spark, events, tmp_path):
    """The events in three micro-batches, each up to `DELAY` out of order, and one that closes them."""
    held = sorted(events.collect(), key=lambda e: (e.ts.timestamp() + random.Random(e.id).uniform(0, DELAY), e.id))
    size = -(-len(held) // 3)
    for i in range(4):
        part = held[i * size:(i + 1) * size] or [(None, None, None, None, None)]
        frame = spark.createDataFrame(part, events.schema)
        if i == 3:
            frame = frame.withColumn("ts", F.lit(jobs.END_OF_TIME).cast("timestamp"))
        frame.coalesce(1).write.parquet(f"{tmp_path}/files/{i:02d}")

    def run(make):
        folder = f"{tmp_path}/live"
        out = None
        for i in range(4):  # a new run for each file: every one starts from the checkpoint of the one before
            spark.read.parquet(f"{tmp_path}/files/{i:02d}").coalesce(1).write.mode("append").parquet(folder)
            out = to_folder(make(streams.file_stream(spark, folder, events.schema)), tmp_path)
        return out

    return run


@pytest.mark.parametrize("slice_seconds", [None, 21.0])
def test_strict_pairs(spark, events, live, slice_seconds):
    v = F.col("v")
    how = dict(keep=["id", "ts", "v"])
    got = live(lambda s: sequences.strict_pairs(s, "k", "ts", "id", v == "x", v == "y", 20, delay=f"{DELAY} seconds",
                                                slice_seconds=slice_seconds, **how).select("k", "s1.id", "s1.ts", "s1.v"))
    want = patterns.strict_pair(events, "k", "ts", "id", v == "x", v == "y", 20, **how)
    assert values(got) == values(want) and want.count() > 20


@pytest.mark.parametrize("same", [None, "v"])
def test_repeats(events, live, same):
    where = F.col("v").isNotNull() if same else F.col("v") == "x"
    got = live(lambda s: sequences.repeats(s, "k", "ts", "id", where, 3, 30, same=same, keep=["id", "v"],
                                           delay=f"{DELAY} seconds", slice_seconds=31.0).drop(sequences.CLOCK))
    want = patterns.repeat_match(events, "k", "ts", "id", where, 3, 30, same=same, keep=["id", "v"])
    assert values(got) == values(want.select(got.columns)) and want.count() > 20


def test_warnings_feed_alerts_in_one_query(events, live):
    readings = lambda df: df.select(F.col("k").alias("rack"), "ts", F.col("id").alias("event_id"), "value",
                                    F.when(F.col("v") == "z", "power").otherwise("temperature").alias("kind"))
    got = live(lambda s: sequences.heat_alerts(readings(s), 30.0, 20, 60, slice_seconds=25.0, alert_slice_seconds=70.0,
                                               delay=f"{DELAY} seconds"))
    warnings = patterns.heat_warnings(readings(events.where("k IS NOT NULL")), 30.0, 20)
    want = patterns.heat_alerts(warnings, 60)
    assert values(got) == values(want.select(got.columns)) and want.count() > 20


def test_late_events_are_dropped_not_misplaced(spark, tmp_path):
    rows = [[("a", 1, 10, "x"), ("a", 2, 500, "q")], [("a", 3, 11, "y"), ("a", 4, 900, "q")], [("a", 5, 2000, "q")]]
    folder = f"{tmp_path}/live"
    for part in rows:
        df = spark.createDataFrame(part, "k string, id long, s long, v string").withColumn("ts", F.timestamp_seconds(F.col("s") + BASE))
        df.coalesce(1).write.mode("append").parquet(folder)
        got = to_folder(sequences.strict_pairs(
            streams.file_stream(spark, folder, df.schema), "k", "ts", "id", F.col("v") == "x", F.col("v").isin("y", "q"), 600,
            keep=["id"], delay="5 seconds", slice_seconds=600.0).select("k", F.col("s0.id").alias("a"), F.col("s1.id").alias("b")), tmp_path)
    # The third event comes when its slice is still open by the window's end, so it still takes its place.
    assert {tuple(r) for r in got.collect()} <= {("a", 1, 2), ("a", 1, 3)} and got.count() == 1


def most_state(query):
    return max((s.numRowsTotal for p in query.recentProgress for s in p.stateOperators), default=0)


def staged(history, at, folder, rows, **closing):
    return staging.Staged(history, at, str(folder), rows=rows, closing=staging.closing_row(history.sparkSession, history.schema, **closing))


def test_state_of_history_is_bounded(spark, root, tmp_path):
    feed = changefeed.orders(changefeed.inserts(tables.order_changes(spark, root)))
    created = times.micros(F.try_to_timestamp("createTime", F.lit(times.DATETIME)))
    n = feed.count()
    history = staged(feed, created, tmp_path / "a0", n // 20, createTime=jobs.END_OF_TIME)
    rows = jobs.order_rollup(history.stream())
    query = history.feed(sinks.write_rows(rows, f"{tmp_path}/a0/out", f"{tmp_path}/a0/c", once=staging.AT_ONCE))
    made = spark.read.parquet(f"{tmp_path}/a0/out").withColumn("__time", F.col("__time").cast("timestamp_ntz"))
    assert values(made) == values(metrics.order_rollup(feed).select(made.columns))
    assert 0 < most_state(query) < n / 10

    events = tables.load(spark, root, "events")
    n = events.count()
    t = F.col("event_type")
    history = staged(events, times.micros(F.col("ts")), tmp_path / "t4", n // 16, ts=jobs.END_OF_TIME)
    rows = timeouts.followed_by_or_timeout(history.stream(), "user_id", "ts", "event_id", t == "click", t == "purchase", 43200, buckets=8)
    query = history.feed(sinks.write_rows(rows, f"{tmp_path}/t4/out", f"{tmp_path}/t4/c", once=staging.AT_ONCE))
    want = patterns.followed_by_or_timeout(events, "user_id", "ts", "event_id", t == "click", t == "purchase", 43200, keep=["event_id", "ts"])
    assert spark.read.parquet(f"{tmp_path}/t4/out").count() == want.count() and 0 < most_state(query) < n / 10


def test_history_goes_on_where_it_stopped(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, 7, id) AS at")  # a third of all rows at one instant
    made = staging.Staged(rows, F.col("at"), str(tmp_path / "h"), rows=100)
    out, check = f"{tmp_path}/out", f"{tmp_path}/c"

    class Lost(Exception):
        pass

    def lost(number):
        if number == 2:
            raise Lost

    with pytest.raises(Lost):
        made.feed(sinks.write_rows(made.stream(), out, check, once=staging.AT_ONCE), lost)
    assert 0 < spark.read.parquet(out).count() < 1000
    again = staging.Staged(rows, F.col("at"), str(tmp_path / "h"), rows=100)
    again.feed(sinks.write_rows(again.stream(), out, check, once=staging.AT_ONCE))
    assert values(spark.read.parquet(out)) == values(rows) and not again.waiting()
