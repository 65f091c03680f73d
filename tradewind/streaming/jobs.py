"""The streaming jobs: each is a source, the batch operator, and a sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tradewind import schemas
from tradewind.functions import text, times
from tradewind.operators import changefeed, patterns, widen
from tradewind.operators.dims import Dimensions
from tradewind.streaming import sinks, timeouts


def event_time(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Event time from a field; `delay` is how late an event may still arrive."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


#: Time of the row that closes a finished input: past every window, and still inside what Spark can add delays to. A watermark
#: only follows events, so without it the windows at the end of the data would stay open.
END_OF_TIME = "9000-01-01 00:00:00"


def once_each(changes: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop changes delivered again within `delay`: a log position and row occur once."""
    timed = changes.withColumn("_at", F.timestamp_millis("executeTime")).withWatermark("_at", delay)
    # Rows of one entry share its log position; 128 bits of their content tell them apart.
    content = F.to_json("columns")
    marked = timed.withColumn("_row", F.xxhash64(content)).withColumn("_more", F.xxhash64(F.lit(1), content))
    return marked.dropDuplicatesWithinWatermark(
        ["logfileName", "logfileOffset", "tableName", "eventType", "_row", "_more"]).drop("_row", "_more", "_at")


def _delivered(changes: DataFrame, redelivery: str | None) -> DataFrame:
    return changes if redelivery is None else once_each(changes, redelivery)


def orders_job(changes: DataFrame, target: str, checkpoint: str, *, redelivery: str | None = None, **kw) -> StreamingQuery:
    """New orders as JSON. `redelivery` is the time within which a change delivered again is dropped."""
    new = changefeed.inserts(changefeed.of_table(_delivered(changes, redelivery), "orders"))
    return sinks.write_json(changefeed.orders(new), target, checkpoint, **kw)


def order_lines_job(changes: DataFrame, dimensions: Callable[[], Dimensions], target: str,
                    table: str, checkpoint: str, *, fmt: str = "kafka", once: bool = False,
                    on_missing: str = "default", redelivery: str | None = None, **options) -> StreamingQuery:
    """Widened order lines to two places: new lines as JSON, all changes to the latest rows.

    `dimensions` is called per micro-batch, so a dimension change is seen by the next batch.
    """
    order = list(changefeed.CHANGE_ORDER)

    def write(batch: DataFrame, batch_id: int) -> None:
        now = dimensions()
        widened = lambda rows: widen.widen_lines(rows, now, on_missing=on_missing, keep=order)
        lines = batch.select(*order, *changefeed.typed(schemas.ORDER_LINE), "eventType").persist()
        try:
            new = widened(changefeed.inserts(lines)).drop(*order, "eventType")
            sinks.write_json_batch(new, target, batch_id, fmt=fmt, **options)
            # Reduced before it is widened, so that narrow rows are shuffled. Where widening leaves lines out, it has to
            # come first: an older line that stays counts then.
            if on_missing == "default":
                sinks.append_changes(lines, batch_id, table, ["ogId"], order, finish=widened)
            else:
                sinks.append_changes(widened(lines), batch_id, table, ["ogId"], order)
        finally:
            lines.unpersist()

    return sinks.each_batch(changefeed.of_table(_delivered(changes, redelivery), "order_goods"), write, checkpoint, once=once)


def goods_job(changes, dimensions: Callable[[], Dimensions], target, checkpoint, **kw):
    return _enriched(changefeed.of_table(changes, "goods"),
                     lambda rows: widen.goods(rows, dimensions()), target, checkpoint, **kw)


def carts_job(messages, dimensions: Callable[[], Dimensions], ranges: DataFrame, target, checkpoint, **kw):
    return _enriched(messages, lambda rows: widen.carts(rows, dimensions(), ranges), target, checkpoint, **kw)


def comments_job(messages, dimensions: Callable[[], Dimensions], target, checkpoint, **kw):
    return _enriched(messages, lambda rows: widen.comments(rows, dimensions()), target, checkpoint, **kw)


def clicks_job(lines, ranges: DataFrame, target, checkpoint, **kw):
    return _enriched(lines, lambda rows: widen.clicks(rows, ranges), target, checkpoint, **kw)


def _enriched(stream: DataFrame, widened: Callable[[DataFrame], DataFrame], target: str,
              checkpoint: str, *, fmt: str = "kafka", once: bool | str = False, **options) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_json_batch(widened(batch), target, batch_id, fmt=fmt, **options)

    return sinks.each_batch(stream, write, checkpoint, once=once)


def unpaid_orders_job(changes: DataFrame, target: str, checkpoint: str, *, within: float = 900.0,
                      delay: str = "0 seconds", slice_seconds: float = 30 * 86400.0,
                      buckets: int = timeouts.BUCKETS, **kw) -> StreamingQuery:
    """Orders that were created and not paid in time, as JSON of the order at its creation.

    One order has a handful of changes, so slices of time need not be fine to keep state small.
    """
    rows = changefeed.orders(changefeed.with_payload(changefeed.of_table(changes, "orders")),
                             keep=["logfileOffset", F.timestamp_millis("executeTime").alias("_changed")])
    order = F.to_json(F.struct(*[n for n, _ in schemas.ORDER]))
    found = timeouts.followed_by_or_timeout(
        rows, "orderId", "_changed", "logfileOffset", patterns.order_created(), patterns.order_paid(),
        within, delay=delay, slice_seconds=slice_seconds, buckets=buckets, payload=order)
    late = found.filter(F.col("outcome") == "timeout").select(F.col("payload").alias("value"))
    return sinks.write_values(late, target, checkpoint, **kw)


def order_rollup(orders: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Orders per minute, area and status; a minute is emitted when it is over and `delay` past."""
    created = F.try_to_timestamp("createTime", F.lit(times.DATETIME))
    return (orders.withColumn("_at", created).withWatermark("_at", delay)
            .groupBy(F.window("_at", "1 minute").alias("_w"), "areaId", "orderStatus")
            .agg(F.count("*").alias("count"), text.money_sum(F.col("totalMoney")).alias("totalMoney"))
            .select(F.col("_w.start").alias("__time"), "areaId", "orderStatus", "count", "totalMoney"))


def visitor_pairs(visits: DataFrame, *, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Views per day, visitor and address; the state is spread over visitors, not days."""
    return (event_time(visits, ts, delay)
            .groupBy(F.window(ts, "1 day").alias("_w"), "guid", "ip").agg(F.count("*").alias("_n"))
            .select(F.col("_w.start").alias("_day"), "guid", "ip", "_n"))


def visitors_job(visits: DataFrame, path: str, checkpoint: str, *, ts: str = "ts",
                 delay: str = "10 minutes", once: bool = False) -> StreamingQuery:
    """Exact daily counters, written when a day is over.

    All pairs of a day leave the state in the same micro-batch, so the distinct counts are taken
    there as an ordinary aggregate.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        days = batch.groupBy(times.day_key(F.col("_day")).alias("day")).agg(
            F.sum("_n").alias("pv"), F.count_distinct("guid").alias("uv"),
            F.count_distinct("ip").alias("ip"))
        if not batch.isEmpty():
            days.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return sinks.each_batch(visitor_pairs(visits, ts=ts, delay=delay), write, checkpoint, once=once)


def live_visitors(visits: DataFrame, *, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Running daily counters for a live panel; visitors and addresses are estimates (±2%)."""
    return (event_time(visits, ts, delay).groupBy(F.window(ts, "1 day").alias("_w"))
            .agg(F.count("*").alias("pv"), F.approx_count_distinct("guid", 0.02).alias("uv"),
                 F.approx_count_distinct("ip", 0.02).alias("ip"))
            .select(times.day_key(F.col("_w.start")).alias("day"), "pv", "uv", "ip"))
