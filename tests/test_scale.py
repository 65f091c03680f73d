"""The large-data paths give the same rows as the small-data ones, and plans stay as intended."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tradewind.functions import text, weblog
from tradewind.operators import backfill, changefeed, dims, ip_ranges, lookup, metrics, patterns, widen
from tradewind.plans.queries import QUERIES
from tradewind.sources import tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_shuffle_join_equals_broadcast_and_splits_hot_keys(spark):
    # A third of all rows share one key, a third have none.
    fact = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50).alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for how in ("left", "inner"):
            small = lookup.lookup_join(fact, dim, "k", how)
            large = lookup.lookup_join(fact, dim, "k", how, limit=0)
            assert small.columns == large.columns == ["k", "v", "w"]
            assert rows(small) == rows(large) == rows(fact.join(dim, "k", how).select("k", "v", "w"))
            large.collect()
            assert "skew=true" in plan_of(large)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # Keys of another type, and keys that do not fit the fact's type.
    texts = spark.createDataFrame([("7", "seven"), ("x", "none"), ("8", "eight")], "name string, w string")
    for limit in (None, 0):
        got = lookup.lookup_join(fact, texts, [("k", "name")], "inner", limit=limit)
        assert got.groupBy("w").count().count() == 2 and got.columns == ["k", "v", "name", "w"]
    with pytest.raises(ValueError):
        lookup.lookup_join(fact, dim, "k", "right")


def test_order_lines_scan_the_fact_once_without_broadcast(spark, root, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_LIMIT", 0)
    plan = plan_of(QUERIES["j1_order_lines"](spark, root)).split("== Physical Plan ==")[1]
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_", plan)) == 1


def test_repeated_and_broken_dimension_rows_change_no_fact(spark, root):
    views = {n: v(spark, root) for n, v in tables.DIMENSION_VIEWS.items()}
    changes = tables.line_changes(spark, root)
    want = rows(widen.order_lines(changes, dims.Dimensions(**views)))
    doubled = dict(views, shops=views["shops"].unionAll(views["shops"]), goods_cats=views["goods_cats"].unionAll(
        views["goods_cats"].limit(1).withColumn("catId", F.lit("no number")).withColumn("parentId", F.lit("none"))))
    assert rows(widen.order_lines(changes, dims.Dimensions(**doubled))) == want


def test_size_check(spark, root):
    assert lookup.fits_broadcast(tables.org(spark, root))
    assert not lookup.fits_broadcast(tables.org(spark, root), limit=10)


def test_widening_without_broadcast(spark, root, monkeypatch):
    d = dims.Dimensions(**{n: v(spark, root) for n, v in tables.DIMENSION_VIEWS.items()})
    carts, ranges = tables.cart_messages(spark, root), tables.ip_ranges(spark, root)
    small = rows(widen.carts(carts, d, ranges, keep=["event_id"]))
    monkeypatch.setattr(lookup, "BROADCAST_LIMIT", 0)
    assert rows(widen.carts(carts, d, ranges, keep=["event_id"])) == small


def test_range_join_against_brute_force(spark):
    rnd = random.Random(5)
    cuts = sorted(rnd.sample(range(1, 1 << 32), 400))
    spans = [(a, b - 1, f"c{i}") for i, (a, b) in enumerate(zip(cuts[::2], cuts[1::2]))]
    spans += [(b + 1, b + 3, "tiny") for _, b, _ in spans[:1]]
    numbers = [rnd.randrange(1 << 32) for _ in range(500)] + [x for a, b, _ in spans for x in (a, b)]
    ranges = spark.createDataFrame([(a, b, c, "x") for a, b, c in spans],
                                   "begin bigint, `end` bigint, country string, area string")
    dotted = lambda n: ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    fact = spark.createDataFrame([(dotted(n),) for n in numbers], "ip string")
    found = ip_ranges.locate(fact, ranges)
    want = sorted((dotted(n), next((c for a, b, c in spans if a <= n <= b), "未知国家")) for n in numbers)
    assert sorted((r["ip"], r["country"]) for r in found.collect()) == want
    assert "NestedLoop" not in plan_of(found)


def brute(events, firsts, seconds, within, strict):
    """(first id, second id or None) per first event, by definition."""
    out = []
    by_key = {}
    for e in sorted(events, key=lambda e: (e[1], e[2])):
        by_key.setdefault(e[0], []).append(e)
    for key, seq in by_key.items():
        for i, e in enumerate(seq):
            if e[3] not in firsts:
                continue
            later = seq[i + 1:i + 2] if strict else seq[i + 1:]
            hit = next((x for x in later if x[3] in seconds), None)
            out.append((e[2], hit[2] if hit and hit[1] - e[1] < within else None))
    return sorted(out)


@pytest.mark.parametrize("slice_seconds", [0.5, 7, 3600, 1000000])
@pytest.mark.parametrize("strict", [True, False])
def test_patterns_against_brute_force(spark, slice_seconds, strict):
    rnd = random.Random(11)
    # Half of all events belong to one key; times repeat, and some lie before 1970.
    events = [(rnd.choice([0, 0, 0, 1, 2, 3]), rnd.randrange(-200, 400), i, rnd.choice("abc"))
              for i in range(600)]
    df = spark.createDataFrame(events, "k int, s bigint, n int, t string").withColumn(
        "ts", F.timestamp_seconds("s"))
    step = patterns.NEXT if strict else patterns.LATER
    got = patterns.sequence_match(
        df, "k", "ts", "n", [patterns.Step(F.col("t") == "a"), patterns.Step(F.col("t") == "b", step)],
        7, keep=["n"], slice_seconds=slice_seconds, timeouts=True)
    found = sorted((r["s0"]["n"], r["s1"]["n"] if r["matched"] else None) for r in got.collect())
    key = lambda p: (p[0], p[1] or -1)
    assert sorted(found, key=key) == sorted(brute(events, "a", "b", 7, strict), key=key)


@pytest.mark.parametrize("slice_seconds", [2, 50, 1000000])
def test_longer_patterns_do_not_depend_on_slices(spark, slice_seconds):
    rnd = random.Random(3)
    events = [(rnd.choice([0, 0, 0, 1]), rnd.randrange(300), i, rnd.choice("abc")) for i in range(400)]
    df = spark.createDataFrame(events, "k int, s bigint, n int, t string").withColumn(
        "ts", F.timestamp_seconds("s"))
    is_ = lambda x: F.col("t") == x
    got = patterns.sequence_match(
        df, "k", "ts", "n", [patterns.Step(is_("a")), patterns.Step(is_("b")), patterns.Step(is_("c"), patterns.NEXT)],
        20, keep=["n"], slice_seconds=slice_seconds)
    want, runs = [], {True: [], False: []}
    for key in (0, 1):
        seq = sorted((e for e in events if e[0] == key), key=lambda e: (e[1], e[2]))
        for i, e in enumerate(seq):
            j = next((j for j in range(i + 1, len(seq)) if seq[j][3] == "b"), None)
            if e[3] == "a" and j is not None and j + 1 < len(seq) and seq[j + 1][3] == "c" and seq[j + 1][1] - e[1] < 20:
                want.append((e[2], seq[j][2], seq[j + 1][2]))
            four = seq[i:i + 4]
            if len(four) == 4 and four[-1][1] - e[1] < 20:
                runs[False].append((e[2], four[-1][1]))
                if len({x[3] for x in four}) == 1:
                    runs[True].append((e[2], four[-1][1]))
    assert sorted((r["s0"]["n"], r["s1"]["n"], r["s2"]["n"]) for r in got.collect()) == sorted(want)
    for same, expected in runs.items():
        rep = patterns.repeat_match(df, "k", "ts", "n", F.lit(True), 4, 20, same="t" if same else None,
                                    keep=["n"], slice_seconds=slice_seconds)
        found = rep.select("n", F.unix_seconds("last_ts")).collect()
        assert sorted(map(tuple, found)) == sorted(expected)


def test_pattern_moves_rows_once(spark, root):
    plan = plan_of(QUERIES["c3_paid_or_timeout"](spark, root)).split("== Physical Plan ==")[1]
    # One exchange of rows; the other two carry the summary, reduced before it is moved.
    assert plan.count("Exchange hashpartitioning") == 3
    assert "partial_min_by" in plan


def test_only_steps_of_a_pattern_leave_the_scan(spark, root):
    plan = plan_of(QUERIES["c3_paid_or_timeout"](spark, root)).split("== Physical Plan ==")[1]
    assert plan.count("Filter") and all("click" in f for f in re.findall(r"Filter (.*)", plan) if "event_type" in f)
    assert re.search(r"Filter .*event_type.*click", plan)


def test_refunds_and_updates_without_broadcast(spark, monkeypatch):
    lines = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (2, 10), (4, 9)], "orderId bigint, goodsId bigint")
    orders = spark.createDataFrame([(1, 10), (2, 3), (3, 11), (4, 11)], "orderId bigint, orderStatus int")
    want = rows(lines.join(orders, "orderId", "right").filter("orderStatus in (10, 11)").select("orderId", "goodsId"))
    news = spark.createDataFrame([(1, None), (2, 5)], "orderId bigint, goods bigint")
    for limit in (1 << 28, 0):
        monkeypatch.setattr(lookup, "BROADCAST_LIMIT", limit)
        assert rows(backfill.refund_lines(lines, orders)) == want
        got = backfill.update_from(lines, news, ["orderId"], {"goodsId": "goods"})
        assert sorted(map(tuple, got.collect()), key=str) == sorted(
            [(1, None), (1, None), (1, None), (2, 5), (4, 9)], key=str)


def test_range_width_does_not_show(spark, root):
    df = spark.createDataFrame([(k, v) for k in (1, 2, None) for v in [5, 5, 70, 1, 1000, None]], "k int, v bigint")
    got = [rows(backfill.values_per_key(df, "k", "v", width=w)) for w in (1, 64, 1 << 16)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 15
    one = backfill.values_per_key(df, "k", "v").where("k = 1").orderBy("position").collect()
    assert [tuple(r) for r in one] == [(1, i, v, 5) for i, v in enumerate([1, 5, 5, 70, 1000])]


def test_any_log_line_is_survived(spark):
    head = '10.1.1.1 1.2.3.4 - [05/Sep/2010:11:27:50 +0200] "GET /a HTTP/1.1" 200 10 "http://x/y" "'
    agents = ["a" * 100_000, "\\\\" * 100_000, '\\"' * 100_000]
    lines = spark.createDataFrame([(head + a + '"',) for a in agents] + [(head + "b" * 200_000,)], "value string")
    got = weblog.parse(lines).select(F.length("userAgent").alias("n")).collect()
    assert [r.n for r in got] == [100_000, 200_000, 200_000, None]


def test_money_out_of_range_is_null(spark):
    df = spark.createDataFrame([(1.25,), (float("nan"),), (1e40,), (1e20,)], "v double")
    assert df.agg(text.money_sum(F.col("v")).alias("s")).first().s == pytest.approx(1e20)


def test_latest_state_rules(spark):
    feed = [("a", "insert", 1, "x"), ("a", "update", 3, "y"), ("a", "update", 2, "z"), ("b", "insert", 1, "x"),
            ("b", "delete", 2, None), ("c", "delete", 1, None), ("c", "insert", 2, "back"), ("d", "truncate", 9, "?")]
    df = spark.createDataFrame(feed, "k string, eventType string, at int, v string")
    got = changefeed.latest(df, ["k"], ["at"], ["v"])
    assert sorted(map(tuple, got.collect())) == [("a", "y"), ("c", "back")]


def test_no_query_pairs_everything_with_everything(spark, root):
    streaming = {"k1_order_json_job", "k4_line_job", "a0_rollup_stream", "a1_visitors_stream",
                 "t4_paid_or_timeout_stream", "c4_unpaid_orders_job"}
    for name in set(QUERIES) - streaming:
        plan = plan_of(QUERIES[name](spark, root))
        assert not re.search("CartesianProduct|NestedLoop", plan), name


def test_filters_and_columns_reach_the_scan(spark, root):
    plan = plan_of(QUERIES["a11_top_areas"](spark, root))
    scan = next(l for l in plan.splitlines() if "FileScan" in l and "events.parquet" in l)
    assert "GreaterThanOrEqual(ts,2024-01-30T00:00)" in scan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in scan
    assert "TakeOrderedAndProject" in plan


def test_order_lines_join_the_fact_once_without_shuffle(spark, root):
    plan = plan_of(QUERIES["j1_order_lines"](spark, root)).split("== Physical Plan ==")[1]
    assert "hashpartitioning(ogId" not in plan and "SortMergeJoin" not in plan
    # From the fact's scan up to the root there is one join: the goods profile.
    fact_side = plan.split("FileScan")[0]
    assert fact_side.count("BroadcastHashJoin") == 1


def test_insert_filter_runs_below_the_join(spark, root):
    plan = plan_of(QUERIES["f3_inserted_lines"](spark, root)).split("== Physical Plan ==")[1]
    top, below = plan.split("BroadcastHashJoin", 1)
    assert "Filter" not in top and "Filter" in below


def test_week_sales_scan_the_fact_once(spark, root):
    plan = plan_of(metrics.week_sales(spark, tables.dws_events(spark, root), "2024-01-31"))
    assert plan.split("== Physical Plan ==")[1].count("events.parquet") == 1


def test_dashboard_scans_the_order_fact_once(spark, root):
    plan = plan_of(QUERIES["a25_dashboard"](spark, root)).split("== Physical Plan ==")[1]
    main = [l for l in plan.splitlines() if "events.parquet" in l and "value:double" in l]
    assert len(main) == 1
