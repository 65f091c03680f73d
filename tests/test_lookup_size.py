"""What a lookup takes in a broadcast is judged by its own columns and by the driver's heap."""

from __future__ import annotations

from pyspark.sql import functions as F

from test_scale import plan_of, rows
from tradewind.operators import dims, lookup, widen
from tradewind.sources import tables


def test_columns_that_joins_add_count(spark, root, monkeypatch):
    d = dims.Dimensions(**{n: v(spark, root) for n, v in tables.DIMENSION_VIEWS.items()})
    profile, bound = dims.goods_profile(d), dims.goods_profile_bound(d)
    goods_alone = lookup.estimated_bytes(d.goods) * lookup.EXPANSION
    assert lookup.fits_broadcast(d.goods, limit=goods_alone)
    assert not lookup.fits_broadcast(profile, bound, limit=2 * goods_alone)
    # Narrower than its table: never taken for less than before.
    assert not lookup.fits_broadcast(d.goods.select("goodsId"), [d.goods], limit=goods_alone - 1)
    changes = tables.line_changes(spark, root)
    want = rows(widen.order_lines(changes, d, on_missing="drop"))
    monkeypatch.setattr(lookup, "BROADCAST_LIMIT", 2 * goods_alone)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        wide = widen.order_lines(changes, d, on_missing="drop")
        assert "HashedRelationBroadcastMode(List(input[0, bigint, true])" not in plan_of(wide) and "SortMergeJoin" in plan_of(wide)
        assert rows(wide) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_driver_broadcasts_less(spark, monkeypatch):
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory()
    assert lookup.broadcast_limit(spark) == min(lookup.BROADCAST_LIMIT, heap // lookup.HEAP_SHARE)
    keys = spark.range(1000).select(F.col("id").alias("k"))
    assert lookup.fits_broadcast(keys)
    monkeypatch.setattr(lookup, "HEAP_SHARE", heap)
    assert lookup.broadcast_limit(spark) == 1 and not lookup.fits_broadcast(keys)
