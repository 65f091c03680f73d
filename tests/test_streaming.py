"""Streams fed file by file give what the batch operators give on all rows at once."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.functions import text
from tradewind.operators import changefeed, dims, metrics, patterns, widen
from tradewind.sources import streams, tables
from tradewind.streaming import jobs, sinks, timeouts

ORDER = list(changefeed.CHANGE_ORDER)


def in_files(df, folder, n, by):
    """Write rows as n files in the order of `by`, so that a stream takes them one at a time."""
    rows = df.orderBy(by).collect()
    size = -(-len(rows) // n)
    for i in range(n):
        part = df.sparkSession.createDataFrame(rows[i * size:(i + 1) * size], df.schema).coalesce(1)
        tmp = f"{folder}/tmp{i}"
        part.write.parquet(tmp)
        made = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
        os.makedirs(f"{folder}/in", exist_ok=True)
        target = f"{folder}/in/{i:03d}.parquet"
        os.link(f"{tmp}/{made}", target)
        os.utime(target, (1_600_000_000 + 10 * i,) * 2)
    return f"{folder}/in"


def stream_of(spark, df, folder, n, by):
    path = in_files(df, str(folder), n, by)
    return streams.file_stream(spark, path, df.schema, maxFilesPerTrigger=1)


def values(df):
    return sorted(map(str, df.collect()))


def to_folder(df, folder, mode="append"):
    q = (df.writeStream.format("parquet").outputMode(mode).option("path", f"{folder}/out")
         .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out")


def test_dimension_sync(spark, root, tmp_path):
    feed = tables.dimension_changes(spark, root).filter(F.col("tableName") != "orders")
    # Changes of one row come in different micro-batches, and not in order.
    live = stream_of(spark, feed.withColumn("_mix", F.xxhash64("tableName", "logfileOffset", F.to_json("columns"))),
                     tmp_path, 4, "_mix").drop("_mix")
    path = f"{tmp_path}/dims"
    sinks.sync_dimensions(live, path, f"{tmp_path}/c", once=True).awaitTermination()
    for table in schemas.DIMENSIONS:
        want = values(changefeed.dimension_state(feed, table))
        assert values(sinks.read_dimension(spark, path, table)) == want
    key, fields = schemas.DIMENSIONS["goods"]
    sinks.reduce_changes(spark, f"{path}/goods", [key], ORDER)
    want = values(changefeed.dimension_state(feed, "goods"))
    assert values(sinks.read_dimension(spark, path, "goods")) == want
    # A change older than the newest delete arrives late: the row stays deleted.
    late = feed.filter((F.col("tableName") == "goods") & (F.col("logfileOffset") == 1)).select(
        "eventType", *ORDER, *changefeed.typed(fields))
    sinks.append_changes(late, 99, f"{path}/goods", [key], ORDER)
    assert values(sinks.read_dimension(spark, path, "goods")) == want
    # The same batch once more, as after a restart, changes nothing.
    sinks.append_changes(late, 99, f"{path}/goods", [key], ORDER)
    assert values(sinks.read_dimension(spark, path, "goods")) == want


def test_order_line_job(spark, root, tmp_path):
    feed = tables.line_changes(spark, root)
    d = dims.Dimensions(**{n: v(spark, root) for n, v in tables.DIMENSION_VIEWS.items()})
    live = stream_of(spark, feed, tmp_path, 3, "executeTime")
    calls = []
    jobs.order_lines_job(live, lambda: calls.append(1) or d, f"{tmp_path}/json", f"{tmp_path}/t",
                         f"{tmp_path}/c", fmt="json", once=True).awaitTermination()
    assert len(calls) == 3
    wide = widen.order_lines(feed, d, keep=ORDER)
    got = sinks.read_latest(spark, f"{tmp_path}/t", ["ogId"], ORDER)
    assert values(got) == values(changefeed.line_state(wide, ORDER).select(got.columns))
    made = spark.read.schema("value string").json(f"{tmp_path}/json")
    ids = made.select(F.get_json_object("value", "$.ogId").cast("bigint").alias("ogId"))
    assert values(ids) == values(changefeed.inserts(wide).select("ogId"))
    assert "eventType" not in json.loads(made.first()[0])


def test_paid_or_timeout_stream(spark, root, tmp_path):
    events = tables.load(spark, root, "events")
    t = F.col("event_type")
    args = ("user_id", "ts", "event_id", t == "click", t == "purchase", 12 * 3600)
    live = timeouts.followed_by_or_timeout(stream_of(spark, events, tmp_path, 5, "ts"), *args, buckets=3)
    got = to_folder(live, tmp_path)
    batch = patterns.followed_by_or_timeout(events, *args, keep=["event_id", "ts"])
    cast = lambda df: df.select("user_id", "event_id", "outcome", F.col("paid_ts").cast("timestamp_ntz").alias("p"))
    seen, all_ = cast(got), cast(batch)
    assert got.select("event_id").distinct().count() == got.count()
    assert seen.join(all_, seen.columns[:3], "left_anti").count() == 0
    # What is missing was still open: its time was not up when the data ended.
    open_ = batch.join(got.select("event_id"), "event_id", "left_anti").agg(F.min("ts")).first()[0]
    last = events.agg(F.max("ts")).first()[0]
    assert (last - open_).total_seconds() <= 12 * 3600


def test_timeout_is_raised_by_other_keys(spark, tmp_path):
    """An order without a payment times out when later events of other orders pass its time."""
    rows = [(1, "create", 1558430842), (2, "create", 1558430843), (2, "other", 1558430845), (2, "pay", 1558430850),
            (3, "create", 1558430900), (1, "pay", 1558431920), (9, "other", 1558440000), (9, "other", 1558440001)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "order_id bigint, status string, s bigint, n bigint")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    live = timeouts.followed_by_or_timeout(
        stream_of(spark, df, tmp_path, len(rows), "n"), "order_id", "ts", "n",
        F.col("status") == "create", F.col("status") == "pay", 900)
    got = {r["order_id"]: r["outcome"] for r in to_folder(live, tmp_path).collect()}
    assert got == {1: "timeout", 2: "paid", 3: "timeout"}


def test_late_payment_within_delay_counts(spark, tmp_path):
    """With a delay, an earlier payment that arrives after a later one still wins."""
    rows = [("a", "create", 0), ("a", "pay", 60), ("a", "pay", 30), ("b", "x", 5000), ("b", "x", 5001)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "k string, status string, s bigint, n bigint")
    df = df.withColumn("ts", F.timestamp_seconds(F.col("s") + 1_000_000))
    live = timeouts.followed_by_or_timeout(
        stream_of(spark, df, tmp_path, len(rows), "n"), "k", "ts", "n",
        F.col("status") == "create", F.col("status") == "pay", 900, delay="10 minutes")
    got = to_folder(live, tmp_path).select("k", "outcome", F.unix_seconds("paid_ts")).collect()
    assert [tuple(r) for r in got] == [("a", "paid", 1_000_030)]


def test_redelivered_changes_are_dropped(spark, root, tmp_path):
    feed = tables.order_changes(spark, root)
    twice = feed.unionByName(feed)
    got = to_folder(jobs.once_each(stream_of(spark, twice, tmp_path, 2, "executeTime"), "30 days"), tmp_path)
    assert got.count() == feed.count()


def test_rollup_and_visitors_streams(spark, root, tmp_path):
    feed = changefeed.inserts(tables.order_changes(spark, root))
    live = jobs.order_rollup(changefeed.orders(stream_of(spark, feed, tmp_path / "o", 3, "executeTime")), "0 seconds")
    got = to_folder(live, tmp_path / "o").withColumn("__time", F.col("__time").cast("timestamp_ntz"))
    want = metrics.order_rollup(changefeed.orders(feed)).select(got.columns)
    newest = want.agg(F.max("__time")).first()[0]
    assert values(got) == values(want.filter(F.col("__time") < newest))

    v = tables.visits(spark, root).select("ts", "guid", "ip")
    jobs.visitors_job(stream_of(spark, v, tmp_path / "v", 4, "ts"), f"{tmp_path}/v/days", f"{tmp_path}/v/c",
                      delay="0 seconds", once=True).awaitTermination()
    days = spark.read.parquet(f"{tmp_path}/v/days").select("day", "pv", "uv", "ip")
    assert values(days) == values(metrics.daily_visitors(v).filter("day < '2024-01-30'"))


def test_live_visitors_are_close(spark, root, tmp_path):
    v = tables.visits(spark, root).select("ts", "guid", "ip")
    live = jobs.live_visitors(stream_of(spark, v, tmp_path, 2, "ts"))
    q = (live.writeStream.format("memory").queryName("live_visitors").outputMode("complete")
         .option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start())
    q.awaitTermination()
    exact = {r["day"]: r for r in metrics.daily_visitors(v).collect()}
    got = spark.table("live_visitors").collect()
    assert len(got) == len(exact)
    for r in got:
        assert r["pv"] == exact[r["day"]]["pv"]
        assert abs(r["uv"] - exact[r["day"]]["uv"]) <= 2 and abs(r["ip"] - exact[r["day"]]["ip"]) <= 2


def test_enriching_jobs(spark, root, tmp_path):
    d = dims.Dimensions(**{n: v(spark, root) for n, v in tables.DIMENSION_VIEWS.items()})
    ranges = tables.ip_ranges(spark, root)
    cases = {
        "cart": (tables.cart_messages, lambda s, t, c, **k: jobs.carts_job(s, lambda: d, ranges, t, c, **k),
                 lambda r: widen.carts(r, d, ranges)),
        "comments": (tables.comment_messages, lambda s, t, c, **k: jobs.comments_job(s, lambda: d, t, c, **k),
                     lambda r: widen.comments(r, d)),
        "clicks": (tables.log_lines, lambda s, t, c, **k: jobs.clicks_job(s, ranges, t, c, **k),
                   lambda r: widen.clicks(r, ranges)),
        "goods": (tables.goods_changes, lambda s, t, c, **k: jobs.goods_job(s, lambda: d, t, c, **k),
                  lambda r: widen.goods(r, d)),
    }
    for name, (view, job, batch) in cases.items():
        rows = view(spark, root)
        folder = tmp_path / name
        job(stream_of(spark, rows, folder, 2, rows.columns[0]), f"{folder}/json", f"{folder}/c",
            fmt="parquet", once=True).awaitTermination()
        made = spark.read.schema("value string").parquet(f"{folder}/json").select("value")
        wide = batch(rows)
        assert values(made) == values(wide.select(text.entity_json(wide).alias("value"))), name


def test_text_stream_from_files(spark, root, tmp_path):
    rows = tables.log_lines(spark, root).select("value").limit(50)
    rows.write.text(f"{tmp_path}/in")
    got = to_folder(streams.text_stream(spark, "text", path=f"{tmp_path}/in"), tmp_path)
    assert got.columns == ["value", "ingestTime"] and got.count() == 50 and got.where("ingestTime IS NULL").count() == 0


def test_change_stream_from_files(spark, root, tmp_path):
    feed = tables.order_changes(spark, root)
    feed.write.parquet(f"{tmp_path}/in")
    got = to_folder(streams.change_stream(spark, "parquet", path=f"{tmp_path}/in"), tmp_path)
    assert got.count() == feed.count()


def test_tables_of_latest_rows_stay_few_folders(spark, tmp_path):
    path, want = f"{tmp_path}/t", {}
    for i in range(17):
        rows = [(i % 5, i, "insert" if i % 7 else "delete", f"v{i}"), (100 + i, i, "insert", "x")]
        want |= {k: v for k, _, e, v in rows}
        for k, _, e, _ in rows:
            if e == "delete":
                want.pop(k)
        frame = spark.createDataFrame(rows, "k int, at bigint, eventType string, v string").coalesce(1)
        sinks.append_changes(frame, i, path, ["k"], ["at"], reduce_every=4)
        got = {r.k: r.v for r in sinks.read_latest(spark, path, ["k"], ["at"]).collect()}
        assert got == want
    assert len(os.listdir(f"{path}/changes")) <= 2 * 4 and len(os.listdir(f"{path}/reduced")) <= 2


STREAMED = ["k1_order_json_job", "k4_line_job", "a0_rollup_stream", "a1_visitors_stream", "t4_paid_or_timeout_stream", "c4_unpaid_orders_job"]


@pytest.mark.parametrize("name", STREAMED)
def test_streams_read_folders_of_parts(spark, root, tmp_path, name):
    """A table is the same table as one file or as parts in any order, over several micro-batches."""
    from tradewind.plans.queries import QUERIES

    for table in os.listdir(root):
        source = f"{root}/{table}"
        if table in ("orders.parquet", "lineitem.parquet", "events.parquet"):
            spark.read.parquet(source).repartition(10).write.parquet(f"{tmp_path}/{table}")
        else:
            os.symlink(source, f"{tmp_path}/{table}")
    got = values(QUERIES[name](spark, str(tmp_path)))
    assert got and got == values(QUERIES[name](spark, root))


def test_streams_of_missing_tables_fail(spark, root):
    with pytest.raises(Exception, match="nowhere"):
        tables.stream(spark, root, "nowhere")
