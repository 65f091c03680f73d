"""The order fact stored by day, and visitor sketches."""

from __future__ import annotations

import os
import re

from pyspark.sql import functions as F

from tradewind.operators import metrics, rollup_table
from tradewind.sources import tables

ORDER = "orderId long, createTime string, areaId int, orderStatus int, totalMoney double"


def stamps(path):
    return {d: sorted((f, os.stat(f"{path}/{d}/{f}").st_mtime_ns) for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
            for d in os.listdir(path) if "=" in d}


def test_late_orders_rewrite_their_days_only(spark, tmp_path):
    path = str(tmp_path / "fact")
    early = [(i, f"2024-01-{1 + i % 5:02d} 10:00:{i % 60:02d}", i % 3, 0, 1.5) for i in range(50)]
    late = [(100, "2024-01-02 23:59:59", 1, 0, 7.0), (101, "2024-01-04 00:00:00", 1, 0, 7.0), (102, "no time", 1, 0, 7.0),
            (103, None, 1, 0, 7.0), (104, "2024-02-01 00:00:00", 2, 0, None)]
    rollup_table.write_days(metrics.order_rollup(spark.createDataFrame(early, ORDER)), path)
    before = stamps(path)
    everything = spark.createDataFrame(early + late[:2] + late[4:], ORDER)
    rollup_table.refresh_days(everything, spark.createDataFrame(late, ORDER), path)
    after = stamps(path)
    assert {d for d in after if after[d] != before.get(d)} == {f"fact_day=2024-{d}" for d in ("01-02", "01-04", "02-01")}
    got = rollup_table.read_days(spark, path).drop("fact_day")
    assert sorted(map(str, got.collect())) == sorted(map(str, metrics.order_rollup(everything).select(got.columns).collect()))
    # Nothing late, or nothing with a time: nothing changes.
    for none in (spark.createDataFrame([], ORDER), spark.createDataFrame(late[2:4], ORDER)):
        rollup_table.refresh_days(everything, none, path)
    assert stamps(path) == after


def test_orders_without_a_time_stay(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.createDataFrame([(1, None, 1, 0, 2.0), (2, "2024-01-01 00:00:00", 1, 0, 2.0)], ORDER)
    for _ in range(2):
        rollup_table.write_days(metrics.order_rollup(rows), path)
    assert rollup_table.read_days(spark, path).count() == 2


def test_metrics_open_the_days_they_need(spark, root, tmp_path):
    path, as_of = str(tmp_path / "fact"), "2024-01-20 12:00:00"
    fact = tables.dws_events(spark, root)
    rollup_table.write_days(fact, path)
    stored = rollup_table.read_days(spark, path).where(F.col("__time") <= F.lit(as_of).cast("timestamp_ntz"))
    upto = stored.where(F.col("fact_day") <= F.lit("2024-01-20").cast("date"))
    one = metrics.order_count(upto, as_of, "1 DAY")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*fact_day#\d+ >= 2024-01-19", plan)
    assert len({f.split("fact_day=")[1][:10] for f in _read(metrics._recent(upto, as_of, "1 DAY"))}) == 2
    flat = fact.where(F.col("__time") <= F.lit(as_of).cast("timestamp_ntz"))
    for report in (lambda d: metrics.order_count(d, as_of, "7 DAY"), lambda d: metrics.top_areas_by_sales(d, as_of),
                   lambda d: metrics.orders_by_day(spark, d, as_of), lambda d: metrics.week_sales(spark, d, as_of),
                   lambda d: metrics.finished_by_day_of_month(d, as_of), lambda d: metrics.sales_by_hour(spark, d, as_of)):
        assert sorted(map(str, report(upto).collect())) == sorted(map(str, report(flat).collect()))


def _read(rows):
    return [r.f for r in rows.select(F.input_file_name().alias("f")).distinct().collect()]


def test_sketches_of_days_unite(spark, tmp_path):
    path = str(tmp_path / "visitors")
    visits = spark.range(300_000).select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.pmod("id", F.lit(30)).cast("int"))).alias("ts"),
        F.sha1((F.col("id") % 70_000).cast("string")).alias("guid"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 20_011).cast("string")).alias("ip"))
    rollup_table.write_sketches(rollup_table.visitor_sketches(visits), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 30
    for as_of, days in (("2024-01-30 08:00:00", 1), ("2024-01-30 08:00:00", 7), ("2024-01-30 08:00:00", 30), ("2024-01-03 00:00:00", 7)):
        got = rollup_table.visitors_over(stored, as_of, days).first()
        last = F.lit(as_of).cast("date")
        part = visits.where((F.col("ts").cast("date") <= last) & (F.col("ts").cast("date") > F.date_sub(last, days)))
        pv, uv, ip = part.agg(F.count("*"), F.count_distinct("guid"), F.count_distinct("ip")).first()
        assert got.pv == pv and abs(got.uv - uv) <= 0.03 * uv and abs(got.ip - ip) <= 0.03 * ip
    # A day is replaced, not added to; a length without visits has zeros.
    rollup_table.write_sketches(rollup_table.visitor_sketches(visits.where(F.col("ts").cast("date") == F.lit("2024-01-02").cast("date"))), path)
    assert spark.read.parquet(path).agg(F.sum("pv")).first()[0] == 300_000
    assert tuple(rollup_table.visitors_over(stored, "2023-01-01 00:00:00", 7).first()) == (7, 0, 0, 0)
