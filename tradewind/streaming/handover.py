"""Load then follow: a table of latest rows is filled from its source in key ranges while the change feed goes on.

The log position is noted before a range is read (low) and after it (high). What is read may hold any of the changes
between the two, so a range's rows take their place in the order of changes at low: every change above it wins, and those up
to low can't. Changes are whole rows, so one that the load has seen already does no harm. A range can be trusted once the feed has
been applied up to its high position; until then readers may ask for the trusted ranges only.

Ranges are independent: they can be loaded in any order, by several jobs, and a load that was interrupted skips the
ranges it has finished. The source is never locked, the feed never waits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.operators import changefeed
from tradewind.streaming import sinks

RANGES = 16


def key_ranges(least: int | None, most: int | None, ranges: int = RANGES) -> list[tuple[int | None, int | None]]:
    """(from, below) of equally wide ranges of a whole-number key; the first and the last are open, since rows come in while
    the load runs."""
    if least is None or most is None:
        return [(None, None)]
    step = max(-(-(most - least + 1) // ranges), 1)
    cuts = list(range(least + step, most + 1, step))
    return list(zip([None, *cuts], [*cuts, None]))


def in_range(key: str, low: int | None, below: int | None):
    """Rows of a range. Rows without a key belong to the first one."""
    at = F.col(key).cast("bigint")
    if low is None:
        return F.lit(True) if below is None else (at < below) | at.isNull()
    return at >= low if below is None else (at >= low) & (at < below)


def load_range(spark: SparkSession, read: Callable[[], DataFrame], position: Callable[[], dict], number: int, path: str, *, event: str = "eventType") -> bool:
    """Loads one range, unless that is done: `read` gives its rows, `position` the log's position (the order columns and
    their values) at the moment of the call. Returns whether it was loaded now."""
    if number in sinks._finished(spark, f"{path}/snapshot", "range"):
        return False
    low = position()
    rows = read().withColumns({**{c: F.lit(v).cast(_kind(v)) for c, v in low.items()}, event: F.lit("insert")})
    rows.write.mode("overwrite").parquet(f"{path}/snapshot_rows/range={number}")
    high = position()
    # The marks come last: a range without them is loaded again.
    marks = spark.createDataFrame([(number, *low.values(), *high.values())], ", ".join(
        ["number int", *[f"low_{c} {_kind(v)}" for c, v in low.items()], *[f"high_{c} {_kind(v)}" for c, v in high.items()]]))
    marks.coalesce(1).write.mode("overwrite").parquet(f"{path}/snapshot/range={number}")
    return True


def _kind(value) -> str:
    return "string" if isinstance(value, str) else "bigint"


def trusted_ranges(spark: SparkSession, path: str, applied: dict) -> list[int]:
    """Loaded ranges whose high position is not above `applied`, the position up to which the feed has been written."""
    done = sinks._finished(spark, f"{path}/snapshot", "range")
    if not done:
        return []
    marks = spark.read.parquet(*[f"{path}/snapshot/range={n}" for n in done])
    reached = F.struct(*[F.col(f"high_{c}") for c in applied]) <= F.struct(
        *[F.lit(v).cast(_kind(v)).alias(f"high_{c}") for c, v in applied.items()])
    return sorted(r["number"] for r in marks.where(reached).select("number").collect())  # one row a range


def _rows(spark: SparkSession, path: str, ranges: list[int]) -> DataFrame | None:
    parts = [spark.read.parquet(*[f"{path}/snapshot_rows/range={n}" for n in ranges])] if ranges else []
    changes = sinks._merged(spark, path)
    if changes is not None:
        parts.append(changes)
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1].select(*parts[0].columns))


def read_latest(spark: SparkSession, path: str, key: list[str], order: list[str], *, applied: dict | None = None,
                within: Callable[[int], object] | None = None, event: str = "eventType") -> DataFrame | None:
    """Current rows of loaded ranges and changes together. With `applied` and `within` (the condition of a range), only
    keys of ranges that can be trusted."""
    done = sinks._finished(spark, f"{path}/snapshot", "range")
    ranges = done if applied is None else trusted_ranges(spark, path, applied)
    rows = _rows(spark, path, ranges)
    if rows is None:
        return None
    if applied is not None:
        known = F.lit(False)
        for n in ranges:
            known = known | within(n)
        rows = rows.where(known)
    values = [c for c in rows.columns if c not in (*key, *order, event)]
    return changefeed.latest(rows, key, order, values, event=event)
