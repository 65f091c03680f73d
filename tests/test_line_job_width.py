"""The order-line job shuffles narrow rows, and its table is read without a shuffle where that has no use."""

from __future__ import annotations

import pytest

from test_scale import plan_of
from test_streaming import stream_of, values
from tradewind.operators import changefeed, widen
from tradewind.plans.queries import _dims
from tradewind.sources import tables
from tradewind.streaming import jobs, sinks

ORDER = list(changefeed.CHANGE_ORDER)


@pytest.mark.parametrize("files", [1, 3])
@pytest.mark.parametrize("on_missing", ["default", "drop"])
def test_lines_are_reduced_before_they_are_widened(spark, root, tmp_path, monkeypatch, files, on_missing):
    reduced, latest = [], changefeed.latest

    def noted(changes, *args, **kw):
        reduced.append(changes.columns)
        return latest(changes, *args, **kw)

    d, feed = _dims(spark, root), tables.line_changes(spark, root)
    monkeypatch.setattr(changefeed, "latest", noted)
    jobs.order_lines_job(stream_of(spark, feed, tmp_path, files, "executeTime"), lambda: d, f"{tmp_path}/json", f"{tmp_path}/lines",
                         f"{tmp_path}/c", fmt="parquet", once=True, on_missing=on_missing).awaitTermination()
    assert reduced and all(("goodsName" in c) == (on_missing == "drop") for c in reduced)
    monkeypatch.undo()
    made = sinks.read_latest(spark, f"{tmp_path}/lines", ["ogId"], ORDER)
    wide = widen.order_lines(feed, d, on_missing=on_missing, keep=ORDER)
    want = changefeed.line_state(wide, ORDER)
    kept = [c for c in made.columns if c in want.columns]
    assert values(made.select(kept)) == values(want.select(kept)) and set(want.columns) <= set(made.columns)
    assert spark.read.parquet(f"{tmp_path}/json").count() == changefeed.inserts(wide).count()


def test_one_folder_is_read_without_a_shuffle(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, "insert", "a"), (1, 2, "update", "b"), (2, 1, "insert", "c"), (2, 2, "delete", "c"), (None, 3, "insert", "d")],
                                 "id int, at int, eventType string, name string")
    sinks.append_changes(rows, 0, str(tmp_path), ["id"], ["at"])
    one = sinks.read_latest(spark, str(tmp_path), ["id"], ["at"])
    assert [tuple(r) for r in one.collect()] == [(1, "b")] and "Exchange" not in plan_of(one)
    sinks.append_changes(rows.limit(0), 1, str(tmp_path), ["id"], ["at"])
    two = sinks.read_latest(spark, str(tmp_path), ["id"], ["at"])
    assert [tuple(r) for r in two.collect()] == [(1, "b")] and two.columns == one.columns
