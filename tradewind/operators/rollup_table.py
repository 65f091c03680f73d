"""The order fact and the visitor counters as stored tables.

The fact lies in one partition a day. Late orders rewrite the days they fall on and no others, and metrics over a length of
time open the days of that length only: `metrics` filters on the partition column where a fact has it.

Visitors are stored as one row a day with a sketch of the visitors and one of the addresses. Sketches of days unite
to that of a week or a month, which distinct counts do not, so a longer report reads a row a day in place of all visits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import times
from tradewind.operators import metrics

DAY = metrics.FACT_DAY
SKETCH_BITS = 14  # 16 kB at most; a standard error below one percent


# ---- order fact -------------------------------------------------------------------------

def write_days(fact: DataFrame, path: str, *, rolled_up: bool = False) -> None:
    """Replace the days that `fact` has rows of; other days stay. Rows without a time share a partition of their own.

    Days are dealt to tasks by size, and run-time planning cuts a day that is too much for one. A fact that is `rolled_up`
    has at most a row for each minute, area and status of a day; its days are small and many, and dealt by number."""
    days = fact.withColumn(DAY, F.col("__time").cast("date"))
    tasks = 2 * fact.sparkSession.sparkContext.defaultParallelism
    dealt = days.repartition(tasks, DAY) if rolled_up else days.hint("rebalance", DAY)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The stored fact, with its partition column. A day's partition is replaced, so read after a refresh, not across one."""
    return spark.read.parquet(path)


def refresh_days(orders: DataFrame, late: DataFrame, path: str, *, grain: str = "minute") -> None:
    """Roll up again the days on which `late` orders were created. `orders` are all orders, late ones included.

    Late orders whose creation time does not parse have no day and change nothing. A day that has lost all its orders keeps
    its old rows: new orders only ever add to the fact."""
    # Calendar days: a few thousand rows however many orders.
    days = late.select(_created_day().alias("_day")).filter("_day IS NOT NULL").distinct()
    first, last = days.agg(F.min("_day"), F.max("_day")).head()
    if first is None:
        return
    # As text the time sorts like the time itself, so these bounds reach the scan.
    near = orders.filter(F.col("createTime").between(f"{first} 00:00:00", f"{last} 23:59:59"))
    touched = near.withColumn("_day", _created_day()).join(F.broadcast(days), "_day", "left_semi").drop("_day")
    write_days(metrics.order_rollup(touched, grain=grain), path, rolled_up=True)


def _created_day() -> Column:
    return F.try_to_timestamp("createTime", F.lit(times.DATETIME)).cast("date")


# ---- visitor sketches -------------------------------------------------------------------

def visitor_sketches(visits: DataFrame, *, ts: str = "ts", guid: str = "guid", ip: str = "ip") -> DataFrame:
    """fact_day, pv, and sketches of visitors and addresses (null where a day has none that is known). Visits combine on the
    map side, so a day moves one row a task."""
    return visits.groupBy(F.col(ts).cast("date").alias(DAY)).agg(
        F.count("*").alias("pv"), F.hll_sketch_agg(guid, F.lit(SKETCH_BITS)).alias("guids"), F.hll_sketch_agg(ip, F.lit(SKETCH_BITS)).alias("ips"))


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Replace the days that are there; a day is one row."""
    sketches.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def visitors_over(sketches: DataFrame, as_of, days: int) -> DataFrame:
    """The counters of the last `days` days up to that of `as_of`: pv is exact, uv and ip are estimates. Zeros without visits."""
    today = times.as_of_literal(as_of).cast("date")
    recent = sketches.filter((F.col(DAY) > F.date_sub(today, days)) & (F.col(DAY) <= today))
    guess = lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0).cast("bigint"))
    return recent.agg(F.coalesce(F.sum("pv"), F.lit(0).cast("bigint")).alias("pv"), guess("guids").alias("uv"), guess("ips").alias("ip")).select(
        F.lit(days).alias("days"), "pv", "uv", "ip")
