"""What the training-data operators share: reading, durable intermediate tables, native text columns."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind import session


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def durable(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read again: cuts lineage, survives lost executors."""
    path = session.scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are.

    `lower` also maps letters beyond ASCII, so it serves pure ASCII texts only; they are the
    cheap and common case."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def row_hash(*cols: Column) -> Column:
    """A 64-bit value that tells rows with one id but other content apart."""
    return F.xxhash64(*cols)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which null keys match; the keys appear once."""
    renamed = right.select([F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


def prefix_sums(df: DataFrame, group: list[str], order: list[str], value: str, purpose: str) -> DataFrame:
    """`df` with `_id`, unique in the written table, and `_before`: the sum of `value` over earlier rows of the group.

    No group is gathered in one task: rows are sorted over all partitions by range and written with
    their partition; sums per group and partition give each partition its base, and rows add up
    within it. A group adds one row per partition to the only window over a whole group."""
    at = F.monotonically_increasing_id()
    sort = [*[F.col(c) for c in group], *[F.col(c) for c in order]]
    laid = durable(df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_id", at), purpose).withColumn(
        "_part", F.shiftright("_id", 33))
    earlier = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    bases = laid.groupBy(*group, "_part").agg(F.sum(value).alias("_sum")).select(
        *group, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = W.partitionBy(*group, "_part").orderBy("_id").rowsBetween(W.unboundedPreceding, -1)
    local = laid.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return null_safe(local, bases, [*group, "_part"], "inner").withColumn(
        "_before", F.col("_base") + F.col("_local")).drop("_base", "_local", "_part")
