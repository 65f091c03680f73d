"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Every query runs its whole
plan into Spark's `noop` sink; the better of two runs counts, so that JIT warm-up does not.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "k2_state_goods", "k3_line_state", "f10_order_entity", "s4_log_flatten",
    "j1_order_lines", "j2_goods", "j3_carts", "j4_comments", "j5_ip_places",
    "j11_refund_lines", "j12_line_created",
    "a0_order_rollup", "a1_daily_visitors", "a2_funnel", "a7_week_sales", "a10_sales_by_hour_day",
    "a11_top_areas", "a13_top_sales", "a16_orders_by_time", "a19_finished_by_day",
    "a22_views_per_user", "a23_write_back", "a25_dashboard", "a26_orders_per_customer",
    "x1_log_fields", "click_log_wide", "x12_order_json",
    "c1_fail_then_success", "c2a_repeated", "c2b_repeated_same", "c3_paid_or_timeout",
    "c4_unpaid_orders", "c5a_heat_warnings", "c5b_heat_alerts",
    "t4_paid_or_timeout_stream", "a1_visitors_stream",
]


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tradewind import session
    from tradewind.plans.queries import QUERIES

    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = session.build("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(root.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
