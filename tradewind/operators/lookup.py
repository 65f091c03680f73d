"""The one join every enrichment uses: a fact against a keyed lookup table.

No shuffle of the fact while the lookup is provably small. Beyond that, one plain shuffle join: the fact
is scanned once, and run-time planning splits partitions that turn out too large, hot keys included
(`spark.sql.adaptive.skewJoin.enabled`, on by default; inner and left joins split the fact side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_LIMIT = 256 * 1024 * 1024
# The driver collects a lookup's rows and builds the hash table, whose pages grow by doubling, and other lookups may be under way.
HEAP_SHARE = 8
# A row in a broadcast hash table is far larger than the same row in compressed parquet.
EXPANSION = 32


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan; None where it cannot be read."""
    plan = getattr(df, "_jdf", None)  # a remote session has no JVM handle
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes that a lookup may take in a broadcast: fewer where the driver's heap is small."""
    heap = int(spark._jvm.java.lang.Runtime.getRuntime().maxMemory())
    return min(BROADCAST_LIMIT, heap // HEAP_SHARE)


def row_bytes(df: DataFrame) -> int:
    """Catalyst's usual size of a row with these columns."""
    return 8 + int(df._jdf.schema().defaultSize())


def fits_broadcast(df: DataFrame, sized_by: list[DataFrame] | None = None,
                   limit: int | None = None) -> bool:
    """True when an upper estimate of `df` in memory is inside the limit.

    `sized_by` names the base tables whose rows bound those of `df`. It matters for a lookup
    that is itself a chain of key joins: Catalyst multiplies the inputs' sizes there, while
    such a chain never has more rows than its first table. It has more columns, though, and
    those count: a row is taken as many times larger as the chain is wider than its tables.
    """
    bases = sized_by or [df]
    sizes = [estimated_bytes(d) for d in bases]
    if any(s is None for s in sizes):
        return False
    limit = broadcast_limit(df.sparkSession) if limit is None else limit
    wider = max(1.0, row_bytes(df) / sum(map(row_bytes, bases)))
    return sum(sizes) * EXPANSION * wider <= limit


def lookup_join(fact: DataFrame, lookup: DataFrame, on, how: str = "left", *,
                sized_by: list[DataFrame] | None = None, limit: int | None = None) -> DataFrame:
    """Join `fact` to `lookup` on equal keys (left or inner), whatever the lookup's size.

    `on` is a column name, a list of names, or a list of (fact column, lookup column) pairs.
    Keys compare in the fact's type. Of the lookup's keys only those with a name of their own
    survive.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join keeps the fact side, so how={how!r} is not supported")
    pairs = [(p, p) if isinstance(p, str) else p for p in ([on] if isinstance(on, str) else on)]
    kinds = fact.schema
    keys = [f"_k{i}" for i in range(len(pairs))]
    same = {r for l, r in pairs if l == r}
    marked = lookup.select(
        *[F.col(r).try_cast(kinds[l].dataType).alias(k) for (l, r), k in zip(pairs, keys)],
        *[F.col(c) for c in lookup.columns if c not in same])
    cond = F.lit(True)
    for (left, _), k in zip(pairs, keys):
        cond = cond & (F.col(left) == F.col(k))
    if fits_broadcast(lookup, sized_by, limit):
        marked = F.broadcast(marked)
    return fact.join(marked, cond, how).drop(*keys)


def one_per_key(lookup: DataFrame, key: str) -> DataFrame:
    """A dimension snapshot with one row per key: of repeated keys the largest row in column order."""
    rest = [c for c in lookup.columns if c != key]
    if not rest:
        return lookup.distinct()
    return lookup.groupBy(key).agg(F.max(F.struct(*rest)).alias("_v")).select(
        *[key if c == key else F.col(f"_v.`{c}`").alias(c) for c in lookup.columns])
