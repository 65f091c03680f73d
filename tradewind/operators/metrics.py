"""Dashboard metrics over the order fact (`__time`, `areaId`, `orderStatus`, `totalMoney`,
`count`) and the click stream.

Every metric takes `as_of` in place of the current time, so results repeat. Its bounds fold to
literals and reach the scan; a fact stored by day (`rollup_table`) is pruned by them. Sums combine on the
map side, so an area or day with a third of all rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import text, times
from tradewind.operators.lookup import lookup_join

_TIME = "__time"
FACT_DAY = "fact_day"  # partition column of a stored fact
STAGES = ("browse", "cart", "order", "pay")


# ---- roll-ups ---------------------------------------------------------------------------

def order_rollup(orders: DataFrame, *, grain: str = "minute") -> DataFrame:
    """Order fact: new orders by minute, area and status."""
    created = F.try_to_timestamp("createTime", F.lit(times.DATETIME))
    return orders.groupBy(
        F.date_trunc(grain, created).cast("timestamp_ntz").alias(_TIME), "areaId", "orderStatus",
    ).agg(F.count("*").alias("count"), text.money_sum(F.col("totalMoney")).alias("totalMoney"))


def daily_visitors(visits: DataFrame, *, ts: str = "ts", guid: str = "guid", ip: str = "ip") -> DataFrame:
    """Page views, distinct visitors and distinct addresses per day.

    Rows are first reduced to one per (day, visitor, address); only that much smaller set goes
    through the double distinct count.
    """
    pairs = visits.groupBy(times.day_key(F.col(ts)).alias("day"), guid, ip).agg(
        F.count("*").alias("_n"))
    return pairs.groupBy("day").agg(
        F.sum("_n").alias("pv"), F.count_distinct(guid).alias("uv"), F.count_distinct(ip).alias("ip"))


def visitors_on(visits: DataFrame, day: str, **names) -> DataFrame:
    """The three counters of one day; a day without visits shows zeros."""
    ts = names.get("ts", "ts")
    start = F.lit(day).cast("date").cast("timestamp_ntz")
    one = visits.filter((F.col(ts) >= start) & (F.col(ts) < start + F.expr("INTERVAL 1 DAY")))
    found = daily_visitors(one, **names)
    # A keyless aggregate always has one row.
    top = lambda c: F.coalesce(F.max(c), F.lit(0).cast("bigint")).alias(c)
    return found.agg(F.lit(day).alias("day"), top("pv"), top("uv"), top("ip"))


def funnel(events: DataFrame, stage: Column) -> DataFrame:
    """How many events reached each of browse, cart, order, pay, and the share kept from the
    stage before. `stage` names the stage of a row, null for none."""
    n = lambda s: F.count_if(stage == s)
    counts = events.agg(n("browse").alias("browse"), n("cart").alias("cart"),
                        n("order").alias("order"), n("pay").alias("pay"))
    share = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 6)).alias(f"{a}_rate")
    return counts.select("browse", "cart", "order", "pay", share("cart", "browse"),
                         share("order", "cart"), share("pay", "order"))


# ---- single figures ---------------------------------------------------------------------

def _from_day(dws: DataFrame, as_of, length: str) -> DataFrame:
    """A fact stored by day is pruned to the days of the length; the time column itself can't do that."""
    if FACT_DAY not in dws.columns:
        return dws
    return dws.filter(F.col(FACT_DAY) >= times.before(as_of, length).cast("date"))


def _recent(dws: DataFrame, as_of, length: str) -> DataFrame:
    return _from_day(dws, as_of, length).filter(times.since(F.col(_TIME), as_of, length))


def _count() -> Column:
    return F.coalesce(F.sum("count"), F.lit(0).cast("bigint"))


def order_count(dws: DataFrame, as_of, length: str) -> DataFrame:
    """Orders within a length of time such as "1 DAY", "30 DAY", "1 YEAR"."""
    return _recent(dws, as_of, length).agg(_count().alias("orders"))


def sales_total(dws: DataFrame, as_of, length: str) -> DataFrame:
    return _recent(dws, as_of, length).agg(text.money_sum(F.col("totalMoney")).alias("sales"))


def sales_padded(dws: DataFrame, as_of, length: str) -> DataFrame:
    """Whole units, ten digits, zeros in front."""
    return sales_total(dws, as_of, length).select(text.whole_padded(F.col("sales")).alias("sales"))


# ---- by area ----------------------------------------------------------------------------

def orders_by_area(dws: DataFrame, as_of, length: str = "1 DAY") -> DataFrame:
    return _recent(dws, as_of, length).groupBy("areaId").agg(_count().alias("orders"))


def top_areas_by_orders(dws: DataFrame, as_of, n: int = 8, *, length: str = "1 DAY",
                        status: int | None = None) -> DataFrame:
    """The n areas with most orders; ties go to the smaller id."""
    rows = dws if status is None else dws.filter(F.col("orderStatus") == status)
    return orders_by_area(rows, as_of, length).orderBy(F.desc("orders"), "areaId").limit(n)


def top_areas_by_sales(dws: DataFrame, as_of, n: int = 4, *, length: str = "1 DAY") -> DataFrame:
    return (_recent(dws, as_of, length).groupBy("areaId")
            .agg(text.money_sum(F.col("totalMoney")).alias("sales"))
            .orderBy(F.desc("sales"), "areaId").limit(n))


def named_areas(rows: DataFrame, areas: DataFrame, *, keep_unknown: bool = False) -> DataFrame:
    """Area names for area ids. Areas without a name are dropped, or kept with null."""
    names = areas.select(F.col("id").alias("_area"), F.col("name").alias("areaName"))
    return lookup_join(rows, names, [("areaId", "_area")], "left" if keep_unknown else "inner",
                       sized_by=[areas]).drop("_area")


def located_areas(rows: DataFrame, areas: DataFrame, *, by: str = "areaName") -> DataFrame:
    """Coordinates for area names."""
    spots = areas.select(F.col("name").alias("_name"), "lon", "lat")
    return lookup_join(rows, spots, [(by, "_name")], sized_by=[areas]).drop("_name")


# ---- by time ----------------------------------------------------------------------------

def day_spine(spark: SparkSession, as_of, days: int = 7, *, back: int = 0) -> DataFrame:
    """The last `days` days up to `as_of`, oldest first, with position, key and weekday."""
    day = F.date_sub(times.as_of_literal(as_of).cast("date"),
                     (F.lit(days - 1 + back) - F.col("id")).cast("int"))
    return spark.range(days).select(
        F.col("id").cast("int").alias("pos"), times.day_key(day).alias("day"),
        times.weekday_label(day).alias("weekday"))


def fill_days(spine: DataFrame, by_day: DataFrame, value: str) -> DataFrame:
    """Every day of the spine, zero where nothing happened. Both sides are a few days long."""
    zero = F.lit(0).cast(by_day.schema[value].dataType)
    return (spine.join(by_day.select("day", value), "day", "left")
            .withColumn(value, F.coalesce(value, zero)))


def week_sales(spark: SparkSession, dws: DataFrame, as_of) -> DataFrame:
    """This week's and the previous week's sales, day by day, side by side.

    One scan covers both weeks. This week starts six days back, the previous one ends a week
    back, so no day belongs to both.
    """
    ts = F.col(_TIME)
    by_day = (_from_day(dws, as_of, "14 DAY").filter(times.since(ts, as_of, "6 DAY") | times.shifted_week(ts, as_of))
              .groupBy(times.day_key(ts).alias("day"))
              .agg(text.money_sum(F.col("totalMoney")).cast("bigint").alias("sales")))
    spine = day_spine(spark, as_of, 7).unionByName(
        day_spine(spark, as_of, 7, back=7))
    # One pass over the fact serves both weeks: rows of the same position pair up.
    filled = fill_days(spine, by_day, "sales")
    newest = times.day_key(F.date_sub(times.as_of_literal(as_of).cast("date"), 6))
    pick = lambda c, now: F.max(F.when((F.col("day") >= newest) == F.lit(now), F.col(c)))
    return filled.groupBy("pos").agg(
        pick("day", True).alias("day"), pick("weekday", True).alias("weekday"),
        pick("sales", True).alias("sales"), pick("day", False).alias("last_day"),
        pick("weekday", False).alias("last_weekday"), pick("sales", False).alias("last_sales"),
    ).orderBy("pos")


def sales_by_hour(spark: SparkSession, dws: DataFrame, as_of, lookback: str = "1 HOUR") -> DataFrame:
    """Sales per hour of day, all 24 hours present."""
    by_hour = (_recent(dws, as_of, lookback).groupBy(F.hour(_TIME).alias("hour"))
               .agg(text.money_sum(F.col("totalMoney")).alias("sales")))
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    return hours.join(by_hour, "hour", "left").withColumn(
        "sales", F.coalesce("sales", F.lit(0.0)))


def orders_by_hour_bare(dws: DataFrame, as_of, lookback: str = "1 HOUR") -> DataFrame:
    """Sales per hour of day, only hours with orders."""
    return (_recent(dws, as_of, lookback).groupBy(F.hour(_TIME).alias("hour"))
            .agg(text.money_sum(F.col("totalMoney")).alias("sales")))


def orders_by_day(spark: SparkSession, dws: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Orders of each of the last days, zeros included."""
    by_day = (_recent(dws, as_of, f"{days} DAY").groupBy(times.day_key(F.col(_TIME)).alias("day"))
              .agg(_count().alias("orders")))
    return fill_days(day_spine(spark, as_of, days), by_day, "orders").select(
        "pos", "day", "weekday", "orders")


def orders_by_time(dws: DataFrame, as_of, length: str = "7 DAY") -> DataFrame:
    return _recent(dws, as_of, length).groupBy(_TIME).agg(_count().alias("orders"))


def finished_by_day_of_month(dws: DataFrame, as_of, *, length: str = "7 DAY", n: int = 10,
                             status: int = 2) -> DataFrame:
    return (_recent(dws.filter(F.col("orderStatus") == status), as_of, length)
            .groupBy(F.dayofmonth(_TIME).alias("day")).agg(_count().alias("orders"))
            .orderBy(F.desc("orders"), "day").limit(n))


def sum_per_user(rows: DataFrame, user: str, views: str) -> DataFrame:
    return (rows.groupBy(user).agg(F.sum(views).alias("views")).orderBy(user))
