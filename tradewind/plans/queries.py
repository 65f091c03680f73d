"""Every operator as a named query over the warehouse tables. `oracle.py` holds the same
results in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import schemas, session
from tradewind.functions import geo, text, times, weblog
from tradewind.operators import backfill, changefeed, dims, ip_ranges, metrics, patterns, rollup_table, widen
from tradewind.plans.dashboard import dashboard, entries
from tradewind.sources import streams, tables
from tradewind.streaming import handover, jobs, panels, pending, sequences, sinks, staging, timeouts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EV = tables.EVENTS_AS_OF
OD = tables.ORDERS_AS_OF
HOUR, DAY = 3600, 86400


def query(fn: Query) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        return fn(session.ensure(spark), root)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _register(name: str, fn: Query) -> None:
    fn.__name__ = name
    query(fn)


def _dims(spark, root) -> dims.Dimensions:
    return dims.Dimensions(**{n: view(spark, root) for n, view in tables.DIMENSION_VIEWS.items()})


def _staged(spark, rows: DataFrame, at: Column, purpose: str, **closing) -> staging.Staged:
    """Rows of a table as an ordered history, closed by a row with these values."""
    end = staging.closing_row(spark, rows.schema, **closing) if closing else None
    return staging.Staged(rows, at, session.scratch_dir(spark, purpose), closing=end)


def _run(history: staging.Staged, rows: DataFrame) -> DataFrame:
    """A streaming result over the whole history."""
    out = f"{history.folder}/out"
    with session.state_partitions(rows.sparkSession):
        query = sinks.write_rows(rows, out, f"{history.folder}/checkpoint", once=staging.AT_ONCE)
    history.feed(query)
    return rows.sparkSession.read.schema(rows.schema).parquet(out)


# ---- sources and sinks ------------------------------------------------------------------

@query
def s4_log_flatten(spark, root):
    flat = changefeed.flatten_log(tables.log_batches(spark, root))
    return flat.select("logfileName", "logfileOffset", "executeTime", "schemaName", "tableName",
                       "eventType", *[F.col("columns")[c].alias(c) for c in ("ogId", "goodsId", "image")])


for _table in schemas.DIMENSIONS:
    _register(f"s5_dim_{_table}", lambda spark, root, t=_table: streams.project_dimension(
        tables.DIMENSION_VIEWS[t](spark, root), t))
    _register(f"k2_state_{_table}", lambda spark, root, t=_table: changefeed.dimension_state(
        changefeed.of_tables(tables.dimension_changes(spark, root)), t))


def _goods_feed(spark, root) -> DataFrame:
    return changefeed.of_table(tables.dimension_changes(spark, root), "goods")


for _table in schemas.DIMENSIONS:
    def _sync(spark, root, t=_table):
        """The streaming sync of a dimension over its history of changes: current rows of its table."""
        feed = changefeed.of_table(tables.dimension_changes(spark, root), t)
        history = _staged(spark, feed, F.col("logfileOffset"), f"k2-{t}")
        history.feed(sinks.sync_dimensions(history.stream(), f"{history.folder}/dims", f"{history.folder}/checkpoint",
                                           once=staging.AT_ONCE, dimensions=[t]))
        return sinks.read_dimension(spark, f"{history.folder}/dims", t)

    _register(f"k2_sync_{_table}", _sync)


# Log positions at which a range's load begins, reads, and ends.
HANDOVERS = {"early": (0, 2, 3), "midway": (2, 3, 4), "late": (5, 5, 5)}


def _handover(spark, root, schedule: tuple[int, int, int]) -> DataFrame:
    """Goods loaded in key ranges while their changes come in. The source is what the changes up to a position make of it."""
    feed, order = _goods_feed(spark, root), list(changefeed.CHANGE_ORDER)
    key, fields = schemas.DIMENSIONS["goods"]
    typed = feed.select("eventType", *order, *changefeed.typed(fields))
    span = typed.agg(F.min(key), F.max(key), F.min("executeTime"), F.min("logfileName")).head()
    ranges = handover.key_ranges(span[0], span[1], 4)
    history = _staged(spark, feed, F.col("logfileOffset"), "k2-handover")
    table = f"{history.folder}/dims/goods"

    def load(number: int) -> None:
        low, read, high = schedule
        at = iter([low, high])
        source = changefeed.latest(typed.where(F.col("logfileOffset") <= read), [key], order, [n for n, _ in fields if n != key])
        handover.load_range(spark, lambda: source.where(handover.in_range(key, *ranges[number])),
                            lambda: {"executeTime": span[2], "logfileName": span[3], "logfileOffset": next(at)}, number, table)

    def between(stage: int) -> None:
        for number in range(stage, len(ranges), 2):  # some ranges after each part of the feed
            load(number)

    history.feed(sinks.sync_dimensions(history.stream(), f"{history.folder}/dims", f"{history.folder}/checkpoint",
                                       once=staging.AT_ONCE, dimensions=["goods"]), between)
    for number in range(len(ranges)):
        load(number)
    return handover.read_latest(spark, table, [key], order).select(*[n for n, _ in fields])


for _name, _schedule in HANDOVERS.items():
    _register(f"k2_handover_goods_{_name}", lambda spark, root, s=_schedule: _handover(spark, root, s))


@query
def s2_dead_letters(spark, root):
    """Order changes as JSON text, every seventh broken, read as a stream into two sinks: offsets of the good, text of the bad."""
    out = session.scratch_dir(spark, "s2")
    feed = tables.order_changes(spark, root)
    broken = F.col("logfileOffset") % 7 == 0
    whole = F.to_json(F.struct(*[n for n, _ in schemas.CHANGE]))
    feed.select(F.when(broken, F.concat(F.lit("broken "), F.col("logfileOffset"))).otherwise(whole).alias("value")).write.text(f"{out}/in")
    good = lambda batch, n: batch.select("logfileOffset", "eventType").write.mode("overwrite").parquet(f"{out}/good/batch_id={n}")
    changes = streams.change_stream(spark, "text", path=f"{out}/in", keep_origin=True)
    sinks.with_dead_letters(changes, good, f"{out}/bad", f"{out}/checkpoint", once=True).awaitTermination()
    bad = spark.read.schema("raw string, source string, position bigint").parquet(f"{out}/bad")
    made = spark.read.schema("logfileOffset bigint, eventType string").parquet(f"{out}/good")
    return made.select("logfileOffset", "eventType", F.lit(None).cast("string").alias("raw")).unionByName(
        bad.select(F.lit(None).cast("bigint").alias("logfileOffset"), F.lit(None).cast("string").alias("eventType"), "raw"))


@query
def s6_fact_by_sql(spark, root):
    """The order fact as a view, read with SQL text."""
    return spark.sql(
        "SELECT areaId, orderStatus, SUM(`count`) AS orders FROM {dws} GROUP BY areaId, orderStatus",
        dws=tables.dws_orders(spark, root))


@query
def k3_line_state(spark, root):
    """Current order lines, widened: reduced to the latest rows first, so fewer rows are joined."""
    rows = tables.line_changes(spark, root).select(
        "eventType", *changefeed.CHANGE_ORDER, *changefeed.typed(schemas.ORDER_LINE))
    state = changefeed.latest(rows, ["ogId"], list(changefeed.CHANGE_ORDER),
                              ["orderId", "goodsId", "goodsNum", "goodsPrice"])
    return widen.widen_lines(state, _dims(spark, root))


@query
def k4_line_job(spark, root):
    """The streaming order-line job, run to the end of the table: current rows of its sink."""
    out = session.scratch_dir(spark, "k4")
    feed = tables.line_changes(spark, root, tables.stream(spark, root, "lineitem"))
    d = _dims(spark, root)
    jobs.order_lines_job(feed, lambda: d, f"{out}/json", f"{out}/lines", f"{out}/checkpoint",
                         fmt="parquet", once=True).awaitTermination()
    rows = sinks.read_latest(spark, f"{out}/lines", ["ogId"], list(changefeed.CHANGE_ORDER))
    return rows.drop(*changefeed.CHANGE_ORDER, "eventType")


@query
def t8_once_each(spark, root):
    """A feed in which every third change comes twice, read as a stream in order: each change once."""
    feed = tables.line_changes(spark, root)
    again = feed.withColumn("_n", F.explode(F.when(F.col("logfileOffset") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))))).drop("_n")
    history = _staged(spark, again, F.col("executeTime"), "t8")
    return _run(history, jobs.once_each(history.stream(), "1 day").select(
        "logfileOffset", "eventType", *changefeed.typed(schemas.ORDER_LINE)))


@query
def k1_order_json_job(spark, root):
    """The streaming order job, run to the end of the table: fields of its JSON records."""
    out = session.scratch_dir(spark, "k1")
    feed = tables.order_changes(spark, root, tables.stream(spark, root, "orders"))
    jobs.orders_job(feed, f"{out}/json", f"{out}/checkpoint", fmt="parquet",
                    once=True).awaitTermination()
    made = spark.read.schema("value string").parquet(f"{out}/json").select(
        F.from_json("value", schemas.ddl(schemas.ORDER)).alias("o"))
    return made.select("o.orderId", "o.userId", "o.orderStatus", "o.totalMoney", "o.areaId",
                       "o.createTime")


# ---- filters, routing, projections ------------------------------------------------------

@query
def f1_one_table(spark, root):
    rows = changefeed.of_table(tables.dimension_changes(spark, root), "orders")
    return rows.select("tableName", "eventType", "logfileOffset", F.col("columns")["orderId"].alias("orderId"))


@query
def f2_dimension_tables(spark, root):
    rows = changefeed.of_tables(tables.dimension_changes(spark, root))
    return rows.groupBy("tableName", "eventType").agg(F.count("*").alias("changes"))


@query
def f3_inserts(spark, root):
    return changefeed.inserts(tables.order_changes(spark, root)).select(
        "logfileOffset", "eventType", F.col("columns")["orderStatus"].alias("orderStatus"))


@query
def f4_actions(spark, root):
    rows = tables.dimension_changes(spark, root)
    return rows.groupBy("eventType", changefeed.action().alias("action")).agg(
        F.count("*").alias("changes"))


@query
def f5_with_payload(spark, root):
    rows = tables.line_changes(spark, root).withColumn("columns", F.when(
        F.col("eventType") == "delete", F.create_map().cast("map<string,string>"))
        .otherwise(F.col("columns")))
    return changefeed.with_payload(rows).select(
        "logfileOffset", "eventType", F.size("columns").alias("fields"))


@query
def f7_since(spark, root):
    ts = F.col("__time")
    d = tables.dws_orders(spark, root)
    return d.filter(times.since(ts, OD, "1 YEAR")).agg(*[
        F.count_if(times.since(ts, OD, n)).alias(a) for n, a in
        (("7 DAY", "week"), ("48 HOUR", "two_days"), ("1 MONTH", "month"), ("1 YEAR", "year"))])


@query
def f8_shifted_week(spark, root):
    d = tables.dws_events(spark, root)
    return d.filter(times.shifted_week(F.col("__time"), EV)).select(
        "__time", "areaId", "totalMoney")


@query
def f9_finished(spark, root):
    return tables.dws_events(spark, root).filter(F.col("orderStatus") == 2).select(
        "__time", "areaId", "totalMoney")


@query
def f10_order_entity(spark, root):
    return changefeed.orders(tables.order_changes(spark, root))


# ---- joins ------------------------------------------------------------------------------

@query
def j1_order_lines(spark, root):
    return widen.order_lines(tables.line_changes(spark, root), _dims(spark, root))


@query
def j1_order_lines_drop(spark, root):
    return widen.order_lines(tables.line_changes(spark, root), _dims(spark, root), on_missing="drop")


@query
def f3_inserted_lines(spark, root):
    """New lines only: the filter runs below the join."""
    return changefeed.inserts(widen.order_lines(tables.line_changes(spark, root), _dims(spark, root)))


@query
def j1_lines_await_goods(spark, root):
    """Order lines that come before their goods wait a day for them: fields of the streaming job's JSON records."""
    feed = tables.late_goods_feed(spark, root)
    end = F.unix_millis(F.lit(jobs.END_OF_TIME).cast("timestamp"))
    history = _staged(spark, feed, F.col("executeTime"), "j1-await", executeTime=end, eventType="end",
                      columns=F.create_map(F.lit("end"), F.lit("")))
    # The views are worked out once, not once a micro-batch.
    views = tables.DIMENSION_VIEWS | {"goods": tables.known_goods}
    d = dims.Dimensions(**{n: session.written(view(spark, root), f"j1-{n}") for n, view in views.items()})
    out = history.folder
    with session.state_partitions(spark, on_disk=True):
        job = pending.waiting_lines_job(history.stream(), lambda: d, f"{out}/json", f"{out}/checkpoint", wait="1 DAY",
                                        delay="0 seconds", fmt="parquet", once=staging.AT_ONCE)
    history.feed(job)
    wide = widen.order_lines(feed, d).schema
    return spark.read.schema("value string").parquet(f"{out}/json").select(F.from_json("value", wide).alias("r")).select("r.*")


@query
def j2_goods(spark, root):
    return widen.goods(tables.goods_changes(spark, root), _dims(spark, root))


@query
def j3_carts(spark, root):
    return widen.carts(tables.cart_messages(spark, root), _dims(spark, root),
                       tables.ip_ranges(spark, root), keep=["event_id"])


@query
def j4_comments(spark, root):
    return widen.comments(tables.comment_messages(spark, root), _dims(spark, root), keep=["event_id"])


def _job(spark, rows: DataFrame, start, wide: DataFrame, purpose: str) -> DataFrame:
    """An enriching job over messages in files: the fields of its JSON records."""
    out = session.scratch_dir(spark, purpose)
    rows.write.parquet(f"{out}/in")
    start(streams.file_stream(spark, f"{out}/in", rows.schema, maxFilesPerTrigger=tables.FILES_PER_BATCH), f"{out}/json",
          f"{out}/checkpoint", fmt="parquet", once=True).awaitTermination()
    made = spark.read.schema("value string").parquet(f"{out}/json")
    return made.select(F.from_json("value", wide.schema).alias("r")).select("r.*")


@query
def j2_goods_job(spark, root):
    d, feed = _dims(spark, root), tables.goods_changes(spark, root)
    return _job(spark, feed, lambda s, *a, **k: jobs.goods_job(s, lambda: d, *a, **k), widen.goods(feed, d), "j2")


@query
def j3_carts_job(spark, root):
    d, ranges, messages = _dims(spark, root), tables.ip_ranges(spark, root), tables.cart_messages(spark, root).select("value")
    return _job(spark, messages, lambda s, *a, **k: jobs.carts_job(s, lambda: d, ranges, *a, **k), widen.carts(messages, d, ranges), "j3")


@query
def j4_comments_job(spark, root):
    d, messages = _dims(spark, root), tables.comment_messages(spark, root).select("value")
    return _job(spark, messages, lambda s, *a, **k: jobs.comments_job(s, lambda: d, *a, **k), widen.comments(messages, d), "j4")


@query
def click_log_job(spark, root):
    ranges, lines = tables.ip_ranges(spark, root), tables.log_lines(spark, root).select("value")
    return _job(spark, lines, lambda s, *a, **k: jobs.clicks_job(s, ranges, *a, **k), widen.clicks(lines, ranges), "clicks")


@query
def j5_ip_places(spark, root):
    v = tables.visits(spark, root).select("event_id", "ip")
    return ip_ranges.locate(v, tables.ip_ranges(spark, root))


@query
def j6_category_tree(spark, root):
    return dims.flatten_categories(tables.goods_cats(spark, root))


@query
def j7_org_tree(spark, root):
    return dims.flatten_orgs(tables.org(spark, root))


@query
def j8_named_areas(spark, root):
    rows = metrics.orders_by_area(tables.dws_events(spark, root), EV)
    return metrics.named_areas(rows, tables.areas(spark, root))


@query
def j8_named_areas_all(spark, root):
    rows = metrics.orders_by_area(tables.dws_events(spark, root), EV)
    return metrics.named_areas(rows, tables.areas(spark, root), keep_unknown=True)


@query
def j9_located_areas(spark, root):
    a = tables.areas(spark, root)
    rows = metrics.named_areas(metrics.orders_by_area(tables.dws_events(spark, root), EV), a,
                               keep_unknown=True)
    return metrics.located_areas(rows, a)


def _lines(spark, root):
    l = tables.load(spark, root, "lineitem")
    return l.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ogId"),
        F.col("l_orderkey").alias("orderId"), F.col("l_partkey").alias("goodsId"),
        F.col("l_quantity").alias("goodsNum"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("goodsPrice"),
        F.col("l_shipdate").alias("createTime"))


def _drawn_status(key: str):
    return (F.col(key) * 2654435761 % 4294967296 % 91 + 10).cast("int")


def _orders(spark, root):
    """Orders with a status drawn from their key and mapped to the bands."""
    return tables.load(spark, root, "orders").select(
        F.col("o_orderkey").alias("orderId"), F.col("o_custkey").alias("userId"),
        text.status_band(_drawn_status("o_orderkey")).alias("orderStatus"),
        F.col("o_totalprice").alias("totalMoney"), F.col("o_totalprice").alias("realTotalMoney"),
        F.col("o_orderdate").alias("createTime"))


@query
def j11_refund_lines(spark, root):
    return backfill.refund_lines(_lines(spark, root), _orders(spark, root))


@query
def j12_line_created(spark, root):
    """Lines take the creation time of their order."""
    lines = _lines(spark, root).select("ogId", "orderId", "goodsId", "createTime")
    return backfill.update_from(lines, _orders(spark, root), ["orderId"], {"createTime": "createTime"})


@query
def j12_refund_money(spark, root):
    """Refunds take the paid price of their order and goods, a key of two columns."""
    lines = _lines(spark, root)
    paid = lines.groupBy("orderId", "goodsId").agg(
        text.money_sum(text.line_amount(F.col("goodsPrice"), F.col("goodsNum"))).alias("payPrice"))
    refunds = backfill.refund_lines(lines, _orders(spark, root)).withColumn("backMoney", F.lit(-1.0))
    return backfill.update_from(refunds, paid, ["orderId", "goodsId"], {"backMoney": "payPrice"})


# ---- aggregations -----------------------------------------------------------------------

@query
def a0_order_rollup(spark, root):
    new = changefeed.inserts(changefeed.of_table(tables.order_changes(spark, root), "orders"))
    return metrics.order_rollup(changefeed.orders(new))


@query
def a0_rollup_stream(spark, root):
    """The streaming roll-up over the history of orders, day after day."""
    feed = changefeed.orders(changefeed.inserts(tables.order_changes(spark, root)))
    created = times.micros(F.try_to_timestamp("createTime", F.lit(times.DATETIME)))
    history = _staged(spark, feed, created, "a0", createTime=jobs.END_OF_TIME)
    made = _run(history, jobs.order_rollup(history.stream()))
    return made.withColumn("__time", F.col("__time").cast("timestamp_ntz"))


@query
def a0_rollup_by_day(spark, root):
    """The stored roll-up: written without the orders of the last quarter of 1997, which come late and renew their days."""
    orders = changefeed.orders(changefeed.inserts(changefeed.of_table(tables.order_changes(spark, root), "orders")))
    late = F.coalesce(F.col("createTime").between("1997-10-01", "1998-01-01"), F.lit(False))
    path = session.scratch_dir(spark, "rollup")
    rollup_table.write_days(metrics.order_rollup(orders.where(~late)), path, rolled_up=True)
    rollup_table.refresh_days(orders, orders.where(late), path)
    return rollup_table.read_days(spark, path).drop(rollup_table.DAY)


def _stored_fact(spark, root) -> DataFrame:
    path = session.scratch_dir(spark, "fact")
    rollup_table.write_days(tables.dws_events(spark, root), path)
    return rollup_table.read_days(spark, path)


@query
def a3_orders_1d_by_day(spark, root):
    """Orders of a day from the fact stored by day."""
    return metrics.order_count(_stored_fact(spark, root), EV, "1 DAY")


@query
def a7_week_sales_by_day(spark, root):
    return metrics.week_sales(spark, _stored_fact(spark, root), EV)


@query
def a1_visitors_by_sketch(spark, root):
    """Counters of 1, 7 and 30 days from one stored row a day; visitors and addresses are estimates, held to the exact counts
    of the visits: `uv_near` and `ip_near` say whether they are within 3 percent."""
    path = session.scratch_dir(spark, "visitors")
    visits = tables.visits(spark, root)
    rollup_table.write_sketches(rollup_table.visitor_sketches(visits), path)
    stored = spark.read.parquet(path)
    one, week, month = (rollup_table.visitors_over(stored, EV, n) for n in (1, 7, 30))
    back = F.datediff(F.lit(EV).cast("date"), F.col("ts").cast("date"))
    pairs = visits.where((back >= 0) & (back < 30)).groupBy("guid", "ip").agg(F.min(back).alias("_back"))
    exact = pairs.select("guid", "ip", F.explode(F.filter(F.array(*map(F.lit, (1, 7, 30))), lambda n: n > F.col("_back"))).alias("days"))
    exact = exact.groupBy("days").agg(F.count_distinct("guid").alias("_uv"), F.count_distinct("ip").alias("_ip"))
    near = lambda c: (F.abs(F.col(c) - F.coalesce(f"_{c}", F.lit(0))) * 100 <= 3 * F.coalesce(f"_{c}", F.lit(0))).alias(f"{c}_near")
    return one.union(week).union(month).join(exact, "days", "left").select("days", "pv", near("uv"), near("ip"))


@query
def a1_daily_visitors(spark, root):
    return metrics.daily_visitors(tables.visits(spark, root))


@query
def a1_visitors_on_day(spark, root):
    return metrics.visitors_on(tables.visits(spark, root), "2024-01-30").unionByName(
        metrics.visitors_on(tables.visits(spark, root), "2024-02-10"))


@query
def a1_visitors_stream(spark, root):
    """The streaming counters over the history of visits, range after range."""
    v = tables.visits(spark, root).select("ts", "guid", "ip")
    history = _staged(spark, v, times.micros(F.col("ts")), "a1", ts=jobs.END_OF_TIME)
    out = f"{history.folder}/days"
    history.feed(jobs.visitors_job(history.stream(), out, f"{history.folder}/checkpoint", once=staging.AT_ONCE))
    return spark.read.parquet(out).select("day", "pv", "uv", "ip")


def _stage():
    t = F.col("event_type")
    return (F.when(t == "view", "browse").when(t == "click", "cart")
            .when(t == "signup", "order").when(t == "purchase", "pay"))


@query
def a2_funnel(spark, root):
    return metrics.funnel(tables.load(spark, root, "events"), _stage())


for _name, _length in {"a3_orders_1d": "1 DAY", "a4_orders_7d": "7 DAY"}.items():
    _register(_name, lambda spark, root, n=_length: metrics.order_count(
        tables.dws_events(spark, root), EV, n))
for _name, _length in {"a5_orders_30d": "30 DAY", "a14_orders_month": "1 MONTH",
                       "a15_orders_year": "1 YEAR"}.items():
    _register(_name, lambda spark, root, n=_length: metrics.order_count(
        tables.dws_orders(spark, root), OD, n))


@query
def a6_orders_by_area(spark, root):
    return metrics.orders_by_area(tables.dws_events(spark, root), EV)


@query
def a7_week_sales(spark, root):
    return metrics.week_sales(spark, tables.dws_events(spark, root), EV)


@query
def a8_month_sales(spark, root):
    return metrics.sales_padded(tables.dws_orders(spark, root), OD, "1 MONTH")


@query
def a9_day_sales(spark, root):
    return metrics.sales_padded(tables.dws_events(spark, root), EV, "1 DAY")


@query
def a10_sales_by_hour(spark, root):
    return metrics.sales_by_hour(spark, tables.dws_events(spark, root), EV)


@query
def a10_sales_by_hour_day(spark, root):
    return metrics.sales_by_hour(spark, tables.dws_events(spark, root), EV, "24 HOUR")


@query
def a11_top_areas(spark, root):
    top = metrics.top_areas_by_orders(tables.dws_events(spark, root), EV, 8)
    return metrics.named_areas(top, tables.areas(spark, root))


@query
def a12_orders_by_day(spark, root):
    return metrics.orders_by_day(spark, tables.dws_events(spark, root), EV)


@query
def a13_top_sales(spark, root):
    top = metrics.top_areas_by_sales(tables.dws_events(spark, root), EV, 4)
    return metrics.named_areas(top, tables.areas(spark, root))


@query
def a16_orders_by_time(spark, root):
    return metrics.orders_by_time(tables.dws_events(spark, root), EV)


@query
def a17_orders_by_area_orders(spark, root):
    return metrics.orders_by_area(tables.dws_orders(spark, root), OD, "30 DAY")


@query
def a18_top_finished_areas(spark, root):
    return metrics.top_areas_by_orders(tables.dws_events(spark, root), EV, 10, status=2)


@query
def a19_finished_by_day(spark, root):
    return metrics.finished_by_day_of_month(tables.dws_events(spark, root), EV)


@query
def a20_hour_sales(spark, root):
    return metrics.orders_by_hour_bare(tables.dws_events(spark, root), EV)


@query
def a20_month_sales(spark, root):
    return metrics.sales_total(tables.dws_orders(spark, root), OD, "1 MONTH")


@query
def a21_year_sales(spark, root):
    return metrics.sales_total(tables.dws_orders(spark, root), OD, "1 YEAR")


@query
def a22_views_per_user(spark, root):
    return metrics.sum_per_user(tables.load(spark, root, "events"), "user_id", "value").withColumn("views", F.round("views", 4))


def _amounts(spark, root):
    lines = _lines(spark, root).withColumn(
        "payPrice", text.line_amount(F.col("goodsPrice"), F.col("goodsNum")))
    return backfill.order_amounts(lines, F.col("createTime"), "1995-01-01", "2001-09-01")


@query
def a23_order_amounts(spark, root):
    return _amounts(spark, root)


@query
def a23_write_back(spark, root):
    return backfill.write_back_amounts(_orders(spark, root), _amounts(spark, root))


def _document(spark, root):
    v = tables.visits(spark, root)
    return dashboard(tables.dws_events(spark, root), tables.areas(spark, root),
                     metrics.visitors_on(v, "2024-01-30"), metrics.funnel(v, _stage()), EV)


@query
def a25_dashboard(spark, root):
    """Every entry of every panel of the document."""
    return entries(_document(spark, root))


@query
def a25_dashboard_live(spark, root):
    """Every entry of the document over live panels, after the history of events has come in, range after range."""
    events = tables.load(spark, root, "events")
    history = _staged(spark, events, times.micros(F.col("ts")), "a25")
    live, path = history.stream(), f"{history.folder}/panels"
    first, *others = panels.start(tables.dws_events(spark, root, live), tables.visits(spark, root, live), _stage(), path,
                                  f"{history.folder}/checkpoint", once=staging.AT_ONCE)
    try:
        history.feed(first, lambda _: [q.processAllAvailable() for q in others])
    finally:
        for q in others:
            q.stop()
    return entries(panels.document(spark, path, tables.areas(spark, root), "2024-01-30", EV))


@query
def a25_dashboard_fields(spark, root):
    """Figures taken back out of the document."""
    get = lambda path, name: F.get_json_object("document", path).alias(name)
    return _document(spark, root).select(
        get("$.visitor[0].value", "pv"), get("$.visitor[1].value", "uv"),
        get("$.visitor[2].value", "visitor_ips"), get("$.convert[3].value", "paid"),
        get("$.orderNum.mouthOrderNum", "month_orders"), get("$.orderNum.weekOrderNum", "week_orders"),
        get("$.orderNum.dayOrderNum", "day_orders"), get("$.sales.monthSale", "month_sale"),
        get("$.sales.daySale", "day_sale"), get("$.weekSale.week[6]", "this_week_last_day"),
        get("$.weekSale.week[5]", "this_week_day_6"), get("$.weekSale.month[0]", "last_week_day_1"),
        get("$.weekOrderFinish.data[3]", "orders_day_4"), get("$.top4sale.area[0]", "best_area"),
        get("$.top8orderNum[0].value", "most_orders"))


@query
def a26_orders_per_customer(spark, root):
    rows = tables.load(spark, root, "orders").select("o_custkey", "o_orderkey")
    return backfill.values_per_key(rows, "o_custkey", "o_orderkey")


@query
def o3_latest_goods(spark, root):
    return backfill.top_items(tables.goods(spark, root), "goodsId").select("goodsId", "goodsName")


# ---- scalar functions -------------------------------------------------------------------

@query
def x1_log_fields(spark, root):
    return weblog.parse(tables.log_lines(spark, root), keep=["event_id"])


@query
def x1_extended_fields(spark, root):
    """The same lines with the request cookie and the caller's address at the end."""
    lines = tables.log_lines(spark, root).withColumn("value", F.concat(
        "value", F.lit(' "session='), "event_id", F.lit('" "10.0.0.'), F.col("event_id") % 250, F.lit('"')))
    return weblog.parse(lines, extended=True, keep=["event_id"])


@query
def click_log_wide(spark, root):
    """Log text to placed visits: parse, address lookup, region split, time."""
    return widen.clicks(tables.log_lines(spark, root), tables.ip_ranges(spark, root), keep=["event_id"])


@query
def x2_log_time(spark, root):
    """Log times with a zone offset, and text that is no time."""
    text_ = F.when(F.col("event_type") == "error", "no time").otherwise(
        F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0200")))
    return tables.load(spark, root, "events").select(
        "event_id", times.datetime_text(times.log_time(text_)).alias("at"))


@query
def x4_millis_text(spark, root):
    millis = F.floor(times.micros(F.col("ts")) / 1000).cast("string")
    return tables.load(spark, root, "events").select("event_id", times.millis_text(millis).alias("at"))


@query
def x5_region_split(spark, root):
    placed = ip_ranges.locate(tables.visits(spark, root).select("event_id", "ip"),
                              tables.ip_ranges(spark, root))
    # The whole text, and the text cut short right after a mark.
    cut = lambda mark: F.concat(F.substring_index("country", mark, 1), F.lit(mark))
    short = (F.when(F.col("event_id") % 3 == 0, cut("省")).when(F.col("event_id") % 3 == 1, cut("市"))
             .otherwise(F.col("country")))
    province, city = geo.region_split(short)
    return placed.select("event_id", province.alias("province"), city.alias("city"))


@query
def x6_ip_number(spark, root):
    """Whole addresses, and addresses whose third part is no number."""
    ip = F.when(F.col("event_type") == "error",
                F.concat(F.substring_index("ip", ".", 2), F.lit(".x.7"))).otherwise(F.col("ip"))
    return tables.visits(spark, root).select("event_id", geo.ip_number(ip).alias("number"))


@query
def x7_zero_pad(spark, root):
    big = F.when(F.col("event_type") == "view", F.col("event_id") + 12345678901).otherwise(F.col("event_id"))
    return tables.load(spark, root, "events").select("event_id", text.zero_pad(big).alias("padded"))


@query
def x8_weekdays(spark, root):
    return tables.load(spark, root, "events").groupBy(
        times.weekday_label(F.col("ts")).alias("weekday")).agg(F.count("*").alias("events"))


@query
def x9_date_shift(spark, root):
    d = F.to_date("o_orderdate")
    return tables.load(spark, root, "orders").select(
        "o_orderkey", times.days_back(d, 7).alias("week_before"),
        times.months_back(d, 1).alias("month_before"), times.years_back(d, 1).alias("year_before"))


@query
def x10_time_parts(spark, root):
    ts = F.col("ts")
    return tables.load(spark, root, "events").select(
        "event_id", times.day_key(ts).alias("day"), F.substring(times.datetime_text(ts), 1, 10).alias("day_cut"),
        F.hour(ts).alias("hour"), F.dayofmonth(ts).alias("day_of_month"))


@query
def x11_cart_messages(spark, root):
    return tables.cart_messages(spark, root).select("event_id", text.parse_cart(F.col("value")).alias("c")).select(
        "event_id", "c.*")


@query
def x11_comment_messages(spark, root):
    return tables.comment_messages(spark, root).select(
        "event_id", text.parse_comment(F.col("value")).alias("c")).select(
        "event_id", "c.userId", "c.userName", "c.orderGoodsId", "c.starScore", "c.comments",
        text.attachment("c"), "c.goodsId", "c.timestamp")


for _table in schemas.DIMENSIONS:
    _register(f"x11_json_{_table}", lambda spark, root, t=_table: (
        (lambda rows: rows.select(text.parse_dimension(text.entity_json(rows), t).alias("d")).select("d.*"))(
            streams.project_dimension(tables.DIMENSION_VIEWS[t](spark, root), t))))


@query
def x12_order_json(spark, root):
    """Order records as JSON, and fields taken back out; null fields are left out."""
    rows = changefeed.orders(tables.order_changes(spark, root))
    made = rows.select("orderId", text.entity_json(rows).alias("j"))
    read = made.select("orderId", F.from_json("j", "map<string,string>").alias("m"))
    return read.select("orderId", *[F.col("m")[n].alias(n) for n in
                                    ("orderNo", "orderStatus", "orderScore", "createTime")],
                       F.size("m").alias("fields"))


@query
def x13_range_search(spark, root):
    return ip_ranges.search(tables.ip_ranges(spark, root), "1")


@query
def x14_clean_area(spark, root):
    return tables.ip_ranges(spark, root).select("begin", geo.clean_area(F.col("area")).alias("area"))


@query
def x15_counters(spark, root):
    """Counters out of JSON text; absent and non-integer ones count as zero."""
    doc = F.when(F.col("event_type") == "error", F.lit("not json")).when(
        F.col("event_type") == "view", F.lit('{"k": "many"}')).otherwise(F.col("props"))
    return tables.load(spark, root, "events").select(
        "event_id", text.counter(doc, "k").alias("k"), text.counter(doc, "absent").alias("absent"))


@query
def x16_status_bands(spark, root):
    return _orders(spark, root).select("orderId", "orderStatus")


@query
def x17_line_amount(spark, root):
    return _lines(spark, root).select(
        "ogId", "goodsId", F.round(text.line_amount(F.col("goodsPrice"), F.col("goodsNum")), 2).alias("payPrice"))


@query
def x18_month_start(spark, root):
    o = tables.load(spark, root, "orders")
    as_text = F.date_format("o_orderdate", "dd.MM.yyyy HH:mm")
    return o.select("o_orderkey", times.reformat(as_text, "dd.MM.yyyy HH:mm", "yyyy/MM/dd").alias("day"),
                    times.datetime_text(times.month_start(F.col("o_orderdate"))).alias("month"))


# ---- patterns ---------------------------------------------------------------------------

@query
def c1_fail_then_success(spark, root):
    t = F.col("event_type")
    return patterns.strict_pair(
        tables.load(spark, root, "events"), "user_id", "ts", "event_id", t == "error", t == "signup",
        6 * HOUR, keep=["event_id", "ts", "event_type"])


@query
def c2a_repeated(spark, root):
    return patterns.repeat_match(
        tables.load(spark, root, "events"), "user_id", "ts", "event_id",
        F.col("event_type") == "view", 5, 5 * DAY, keep=["event_id", "ts"])


@query
def c2b_repeated_same(spark, root):
    """Three messages in a row with one and the same text."""
    return patterns.repeat_match(
        tables.load(spark, root, "events"), "user_id", "ts", "event_id",
        F.col("event_type").isNotNull(), 3, 2 * DAY, same="event_type", keep=["event_id", "ts", "event_type"])


@query
def c3_paid_or_timeout(spark, root):
    t = F.col("event_type")
    return patterns.followed_by_or_timeout(
        tables.load(spark, root, "events"), "user_id", "ts", "event_id", t == "click", t == "purchase",
        12 * HOUR, keep=["event_id", "ts"])


def _with_bursts(spark, root):
    """Events, and how to match them where a user's month is too much for one task."""
    events = tables.load(spark, root, "events")
    month = 30 * DAY
    return events, dict(slice_seconds=month, cuts=patterns.burst_cuts(
        events, "user_id", "ts", "event_id", slice_seconds=month, burst=40))


@query
def c1_fail_then_success_bursts(spark, root):
    events, how = _with_bursts(spark, root)
    t = F.col("event_type")
    return patterns.strict_pair(events, "user_id", "ts", "event_id", t == "error", t == "signup", 6 * HOUR,
                                keep=["event_id", "ts", "event_type"], **how)


@query
def c2b_repeated_same_bursts(spark, root):
    events, how = _with_bursts(spark, root)
    return patterns.repeat_match(events, "user_id", "ts", "event_id", F.col("event_type").isNotNull(), 3, 2 * DAY,
                                 same="event_type", keep=["event_id", "ts", "event_type"], **how)


@query
def c3_paid_or_timeout_bursts(spark, root):
    events, how = _with_bursts(spark, root)
    t = F.col("event_type")
    return patterns.followed_by_or_timeout(events, "user_id", "ts", "event_id", t == "click", t == "purchase", 12 * HOUR,
                                           keep=["event_id", "ts"], **how)


@query
def t4_paid_or_timeout_stream(spark, root):
    """The same from a stream over the history of events."""
    t = F.col("event_type")
    history = _staged(spark, tables.load(spark, root, "events"), times.micros(F.col("ts")), "t4", ts=jobs.END_OF_TIME)
    rows = timeouts.followed_by_or_timeout(
        history.stream(), "user_id", "ts", "event_id", t == "click", t == "purchase", 12 * HOUR, buckets=32)
    made = _run(history, rows)
    return made.select("user_id", "event_id", _ntz("ts"), "outcome", _ntz("paid_ts"))


def _ntz(c: str) -> Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


@query
def c4_unpaid_orders(spark, root):
    feed = changefeed.with_payload(changefeed.of_table(tables.payment_changes(spark, root), "orders"))
    rows = changefeed.orders(feed, keep=["logfileOffset", F.timestamp_millis("executeTime").alias("at")])
    found = patterns.unpaid_orders(rows, ts="at", tie="logfileOffset", keep=["userId", "totalMoney"])
    return found.select("orderId", "userId", "totalMoney", "outcome",
                        F.date_format("paid_ts", times.DATETIME).alias("paid_at"))


@query
def c4_unpaid_orders_job(spark, root):
    """The streaming job for unpaid orders over the history of payments: its JSON records."""
    past = F.unix_millis(F.lit(jobs.END_OF_TIME).cast("timestamp"))
    history = _staged(spark, tables.payment_changes(spark, root), F.col("executeTime"), "c4", executeTime=past,
                      tableName="orders", eventType="end", columns=F.create_map(F.lit("end"), F.lit("")))
    out = history.folder
    with session.state_partitions(spark):
        job = jobs.unpaid_orders_job(history.stream(), f"{out}/json", f"{out}/checkpoint", buckets=32, fmt="parquet",
                                     once=staging.AT_ONCE)
    history.feed(job)
    made = spark.read.schema("value string").parquet(f"{out}/json").select(
        F.from_json("value", schemas.ddl(schemas.ORDER)).alias("o"))
    return made.select("o.orderId", "o.userId", "o.totalMoney", "o.isPay")


def _warnings(spark, root):
    return patterns.heat_warnings(tables.readings(spark, root), 50.0, 2 * HOUR)


@query
def c5a_heat_warnings(spark, root):
    return _warnings(spark, root).withColumn("average", F.round("average", 4))


@query
def c5b_heat_alerts(spark, root):
    return patterns.heat_alerts(_warnings(spark, root), 24 * HOUR)


def _events_in_order(spark, root, purpose: str, rows: DataFrame | None = None) -> staging.Staged:
    rows = tables.load(spark, root, "events") if rows is None else rows
    return _staged(spark, rows, times.micros(F.col("ts")), purpose, ts=jobs.END_OF_TIME)


@query
def c1_fail_then_success_stream(spark, root):
    """The same from a stream over the history of events."""
    t, history = F.col("event_type"), _events_in_order(spark, root, "c1")
    found = sequences.strict_pairs(history.stream(), "user_id", "ts", "event_id", t == "error", t == "signup", 6 * HOUR,
                                   keep=["event_id", "ts", "event_type"])
    return _run(history, found.select("user_id", "s1.event_id", "s1.ts", "s1.event_type"))


@query
def c2a_repeated_stream(spark, root):
    history = _events_in_order(spark, root, "c2a")
    return _run(history, sequences.repeats(history.stream(), "user_id", "ts", "event_id", F.col("event_type") == "view", 5, 5 * DAY,
                                           keep=["event_id", "ts"]).drop(sequences.CLOCK))


@query
def c2b_repeated_same_stream(spark, root):
    history = _events_in_order(spark, root, "c2b")
    return _run(history, sequences.repeats(
        history.stream(), "user_id", "ts", "event_id", F.col("event_type").isNotNull(), 3, 2 * DAY, same="event_type",
        keep=["event_id", "ts", "event_type"]).drop(sequences.CLOCK))


@query
def c5a_heat_warnings_stream(spark, root):
    history = _events_in_order(spark, root, "c5a", tables.readings(spark, root))
    found = sequences.heat_warnings(history.stream(), 50.0, 2 * HOUR)
    return _run(history, found.drop(sequences.CLOCK)).withColumn("average", F.round("average", 4))


@query
def c5b_heat_alerts_stream(spark, root):
    """Warnings and the alerts made of them in one streaming query of two stateful operators."""
    history = _events_in_order(spark, root, "c5b", tables.readings(spark, root))
    return _run(history, sequences.heat_alerts(history.stream(), 50.0, 2 * HOUR, 24 * HOUR))
