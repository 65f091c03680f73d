"""Back-fill and repair of order data in bulk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.functions import text
from tradewind.operators.lookup import lookup_join


def refund_lines(lines: DataFrame, orders: DataFrame, statuses=(10, 11)) -> DataFrame:
    """Order and goods of every order in a refund status; orders without lines keep null goods.

    The right outer join is taken apart: matching lines come from a lookup join, which splits an
    order with very many lines over tasks, and orders without lines from an anti join against the
    refund orders that were matched.
    """
    wanted = orders.filter(F.col("orderStatus").isin(*statuses)).select("orderId")
    matched = lookup_join(lines.select("orderId", "goodsId"), wanted, "orderId", "inner",
                          sized_by=[orders])
    empty = wanted.join(matched.select("orderId").distinct(), "orderId", "left_anti")
    return matched.unionByName(empty.withColumn("goodsId", F.lit(None).cast(
        lines.schema["goodsId"].dataType)))


def update_from(target: DataFrame, source: DataFrame, on: list[str], sets: dict[str, str]) -> DataFrame:
    """Copy columns from `source` (one row per key) where the keys match; other rows stay.

    `sets` maps target columns to source columns. A matched row takes the source value even if
    it is null.
    """
    new = source.select(*on, *[F.col(s).alias(f"_new_{t}") for t, s in sets.items()],
                        F.lit(True).alias("_hit"))
    joined = lookup_join(target, new, on, sized_by=[source])
    pick = lambda c: (F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
                      if c in sets else F.col(c))
    return joined.select(*[pick(c) for c in target.columns])


def order_amounts(lines: DataFrame, created: Column, start, end) -> DataFrame:
    """Sum of paid prices per order over lines created in [start, end)."""
    lit = lambda v: F.lit(str(v)).cast("timestamp_ntz")
    return (lines.filter((created >= lit(start)) & (created < lit(end))).groupBy("orderId")
            .agg(text.money_sum(F.col("payPrice")).alias("amount")))


def write_back_amounts(orders: DataFrame, amounts: DataFrame) -> DataFrame:
    """Orders with their recomputed amount as total and real total."""
    return update_from(orders, amounts, ["orderId"],
                       {"totalMoney": "amount", "realTotalMoney": "amount"})


def values_per_key(rows: DataFrame, key: str, value: str, *, width: int = 1 << 16) -> DataFrame:
    """(key, position, value, length): the sorted list of ids of each key, an element a row.

    Ids are ranked inside ranges of `width`, and counts per range give the position where a range begins, so no
    task holds the list of a key. The width does not show in the result. Null ids are left out; repeated ones keep
    their places.
    """
    ranged = rows.filter(F.col(value).isNotNull()).withColumn("_range", F.expr(f"`{value}` div {width}"))
    counts = ranged.groupBy(key, "_range").agg(F.count("*").alias("_n"))
    upto = W.partitionBy(key).orderBy("_range")
    begins = counts.select(
        F.col(key).alias("_key"), F.col("_range").alias("_r"),
        (F.sum("_n").over(upto) - F.col("_n")).alias("_begin"), F.sum("_n").over(W.partitionBy(key)).alias("length"))
    rank = F.row_number().over(W.partitionBy(key, "_range").orderBy(value)) - 1
    return (ranged.withColumn("_rank", rank)
            .join(begins, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_r")))
            .select(key, (F.col("_begin") + F.col("_rank")).alias("position"), F.col(value).alias("value"), "length"))


def top_items(rows: DataFrame, by: str, n: int = 10) -> DataFrame:
    return rows.orderBy(F.desc(by)).limit(n)
