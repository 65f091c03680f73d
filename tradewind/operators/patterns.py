"""Event sequences per key, within a length of time.

A busy key is split into slices of time, so that a key with a third of all events is spread over
many tasks. Within a slice, matches come from one window. What a slice needs to know about later
ones is a single event per pattern step, the first that fits, and that is found in a summary of
one row per key and slice. Slice length has no influence on the result. A burst, which a slice however short
can't spread, is cut further by `burst_cuts`: between events of one instant too, in the order of the tie-break.

Rules: order is (time, tie-break); a match must take strictly less than `within`; matches may
overlap; "next" means the very next event of the key, "later" the first suitable one. Events
without a key or a time match nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind import session
from tradewind.functions import times

NEXT, LATER = "next", "later"
SLICE_SECONDS = 3600.0
BURST = 1_000_000  # rows of one key and slice that one task takes on
SAMPLES = 16  # rows looked at for each cut
BROADCAST_CUTS = 1_000_000  # of about 24 bytes each


@dataclass(frozen=True)
class Step:
    """A condition on one event, and how the event follows the step before."""

    where: Column
    follows: str = LATER


def time_slice(us: str, seconds: float) -> Column:
    """Number of the slice an instant in epoch microseconds falls in; exact before 1970 too."""
    length = int(seconds * 1_000_000)
    return F.expr(f"({us} - pmod({us}, {length})) div {length}")


def _in_slices(df: DataFrame, key: str, ts: str, slice_seconds: float) -> DataFrame:
    timed = df.withColumn("_us", times.micros(F.col(ts))).filter(
        F.col("_us").isNotNull() & F.col(key).isNotNull())
    return timed.withColumn("_slice", time_slice("_us", slice_seconds))


def burst_cuts(df: DataFrame, key: str, ts: str, tie: str, *, slice_seconds: float = SLICE_SECONDS,
               burst: int = BURST) -> DataFrame | None:
    """Where to cut the slices that hold more than `burst` rows of a key, or None if there are none.

    One row per such key and slice with its cut points, ordered instants and tie-breaks. They are for `cuts` of the
    patterns over the same key, time, tie-break and slice length, whatever the steps, and change no result. Counting is one narrow pass
    that combines on the map side; a second pass takes a sample, by hash, of the busy slices alone. There is about
    one cut for `burst` rows, so the table has at most a `burst`-th of the rows; it is written to the checkpoint folder and counted
    before it may be broadcast. Rows alike in time and tie-break stay together."""
    rows = _in_slices(df.select(*dict.fromkeys([key, ts, tie])), key, ts, slice_seconds)
    busy = session.written(rows.groupBy(key, "_slice").agg(F.count("*").alias("_n")).filter(F.col("_n") > burst).drop("_n"), "busy-slices")
    if busy.isEmpty():
        return None
    at = F.struct("_us", F.col(tie).alias("_tie"))
    sampled = rows.filter(F.pmod(F.xxhash64("_us", tie), F.lit(max(1, burst // SAMPLES))) == 0).join(busy, [key, "_slice"], "left_semi")
    points = sampled.groupBy(key, "_slice").agg(F.sort_array(F.collect_list(at)).alias("_p"))
    found = session.written(points.select(key, "_slice", F.filter("_p", lambda _, i: i % SAMPLES == SAMPLES - 1).alias("_cuts")), "burst-cuts")
    n = found.agg(F.coalesce(F.sum(F.size("_cuts") + 1), F.lit(0))).head()[0]
    return F.broadcast(found) if n <= BROADCAST_CUTS else found


def _cut(rows: DataFrame, key: str, tie: str, cuts: DataFrame | None) -> DataFrame:
    """Slices of (slice, part) instead, in the same order: a part is what lies between two cuts."""
    if cuts is None:
        return rows
    at = F.struct("_us", F.col(tie).alias("_tie"))
    part = F.when(F.col("_cuts").isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda c: c <= at)))
    return rows.join(cuts, [key, "_slice"], "left").withColumn(
        "_slice", F.struct(F.col("_slice").alias("slice"), part.alias("part"))).drop("_cuts")


def _with_following(rows: DataFrame, key: str, tie: str, target: str, name: str, follows: str,
                    only: Column) -> DataFrame:
    """Add `name`: `target` of the next row of the key, or of the next row where it is not null.

    The window is the one shuffle of all rows: the summary combines on the map side to one row per
    key and slice, and the join finds the rows placed by key and slice. The window runs backwards
    in time, so "the first suitable event after this one" is a running value. Only rows with
    `only` are returned.
    """
    order = F.struct("_us", tie)
    boxed = F.struct(F.col(target).alias("t"))
    if follows == LATER:
        boxed = F.when(F.col(target).isNotNull(), boxed)
        order = F.when(F.col(target).isNotNull(), order)
    back = Window.partitionBy(key, "_slice").orderBy(F.desc("_us"), F.desc(tie))
    inside = F.last(boxed, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)) \
        if follows == LATER else F.lag(boxed, 1).over(back)
    firsts = rows.groupBy(key, "_slice").agg(F.min_by(boxed, order).alias("_first"))
    later = Window.partitionBy(key).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    carried = firsts.select(key, "_slice", F.last("_first", ignorenulls=True).over(later).alias("_beyond"))
    found = rows.withColumn("_inside", inside).filter(only)
    return (found.join(carried, [key, "_slice"], "left")
            .withColumn(name, F.coalesce("_inside", "_beyond")["t"]).drop("_inside", "_beyond"))


def sequence_match(df: DataFrame, key: str, ts: str, tie: str, steps: list[Step], within: float, *,
                   keep: list[str], slice_seconds: float = SLICE_SECONDS,
                   timeouts: bool = False, cuts: DataFrame | None = None) -> DataFrame:
    """Matches of a sequence of steps: the key and one struct `s0`, `s1`, ... per step.

    With `timeouts`, first events without a match are kept too: `matched` tells them apart, and
    their later steps are null. `cuts` are those of `burst_cuts`.
    """
    if all(s.follows == LATER for s in steps[1:]):
        # Only "next" cares about events that are no step; without it they need not move at all.
        fits = F.lit(False)
        for s in steps:
            fits = fits | F.coalesce(s.where, F.lit(False))
        df = df.filter(fits)
    flags = [f"_w{i}" for i in range(len(steps))]
    fields = list(dict.fromkeys([*keep, ts]))
    rows = _in_slices(
        df.select(*dict.fromkeys([key, ts, tie, *keep]),
                  *[F.coalesce(s.where, F.lit(False)).alias(f) for s, f in zip(steps, flags)]),
        key, ts, slice_seconds)
    rows = _cut(rows, key, tie, cuts)
    event = F.struct(*fields, "_us")
    # _t{i}: what the rest of the pattern looks like when this event is taken as step i.
    last = len(steps) - 1
    out = rows.withColumn(f"_t{last}", F.when(F.col(flags[last]), F.struct(event.alias("e"))))
    for i in range(last - 1, -1, -1):
        out = _with_following(out, key, tie, f"_t{i + 1}", "_rest", steps[i + 1].follows,
                              F.col(flags[0]) if i == 0 else F.lit(True))
        out = out.withColumn(f"_t{i}", F.when(F.col(flags[i]), F.struct(
            event.alias("e"), F.col("_rest").alias("n")))).drop("_rest", f"_t{i + 1}")
    path = lambda i: "_t0" + ".n" * i + ".e"
    whole = F.coalesce(F.col(path(last) + "._us") - F.col("_us") < int(round(within * 1_000_000)),
                       F.lit(False))
    marked = out.filter(flags[0]).withColumn("matched", whole)
    if not timeouts:
        marked = marked.filter("matched")
    step = lambda i: F.struct(*[F.col(f"{path(i)}.{c}").alias(c) for c in fields])
    return marked.select(
        key, step(0).alias("s0"),
        *[F.when(F.col("matched"), step(i)).alias(f"s{i}") for i in range(1, len(steps))],
        *(["matched"] if timeouts else []))


def repeat_match(df: DataFrame, key: str, ts: str, tie: str, where: Column, times_n: int,
                 within: float, *, same: str | None = None, keep: list[str] | None = None,
                 slice_seconds: float = SLICE_SECONDS, cuts: DataFrame | None = None) -> DataFrame:
    """`times_n` suitable events in a row (others in between do not matter) within a time.

    Returns the first event's `keep` columns and the last event's time. With `same`, all events
    of the match must carry one and the same value in that column. `cuts` are those of `burst_cuts`.
    """
    keep, ahead = keep or [ts], times_n - 1
    rows = _in_slices(df.filter(where).select(
        *dict.fromkeys([key, ts, tie, *keep, *([same] if same else [])])), key, ts, slice_seconds)
    rows = _cut(rows, key, tie, cuts)
    order = Window.partitionBy(key, "_slice").orderBy("_us", tie)
    event = F.struct("_us", F.col(tie).alias("_tie"), F.col(ts).alias("_ts"),
                     *([F.col(same).alias("_v")] if same else []))
    # The event itself and up to `ahead` more of its slice.
    numbered = rows.withColumn("_n", F.row_number().over(order)).withColumn(
        "_run", F.collect_list(event).over(order.rowsBetween(0, ahead)))
    firsts = numbered.groupBy(key, "_slice").agg(F.sort_array(F.collect_list(
        F.when(F.col("_n") <= ahead, event))).alias("_firsts"))
    # Every slice here has an event, so the `ahead` slices that follow hold enough of them.
    later = Window.partitionBy(key).orderBy("_slice").rowsBetween(1, max(ahead, 1))
    carried = firsts.select(key, "_slice", F.slice(F.flatten(
        F.collect_list("_firsts").over(later)), 1, ahead).alias("_beyond"))
    full = F.slice(F.concat("_run", F.coalesce("_beyond", F.array().cast(
        numbered.schema["_run"].dataType))), 1, times_n)
    found = numbered.join(carried, [key, "_slice"], "left").withColumn("_all", full)
    end = F.get("_all", F.lit(ahead))
    hit = end["_us"] - F.col("_us") < int(round(within * 1_000_000))
    if same:
        hit = hit & (F.size(F.array_distinct(F.transform("_all", lambda e: e["_v"]))) == 1)
    return found.filter(hit).select(*dict.fromkeys([key, *keep]), end["_ts"].alias("last_ts"))


# ---- the rules built on it --------------------------------------------------------------

def strict_pair(df, key, ts, tie, first: Column, second: Column, within, *, keep, **kw) -> DataFrame:
    """First event directly followed by second; the second event's columns."""
    found = sequence_match(df, key, ts, tie, [Step(first), Step(second, NEXT)], within, keep=keep, **kw)
    return found.select(key, *[F.col(f"s1.{c}").alias(c) for c in keep if c != key])


def followed_by_or_timeout(df, key, ts, tie, first: Column, second: Column, within, *, keep,
                           **kw) -> DataFrame:
    """Every first event with the outcome `paid` (and when) or `timeout`."""
    found = sequence_match(df, key, ts, tie, [Step(first), Step(second, LATER)], within,
                           keep=keep, timeouts=True, **kw)
    return found.select(
        key, *[F.col(f"s0.{c}").alias(c) for c in dict.fromkeys([*keep, ts]) if c != key],
        F.when(F.col("matched"), "paid").otherwise("timeout").alias("outcome"),
        F.col(f"s1.{ts}").alias("paid_ts"))


def order_created() -> Column:
    return (F.col("isPay") == 0) & (F.col("orderStatus") == 0)


def order_paid() -> Column:
    return (F.col("isPay") == 1) & (F.col("orderStatus") == 0)


def unpaid_orders(orders: DataFrame, *, ts: str, tie: str, within: float = 900.0,
                  keep: list[str] | None = None, **kw) -> DataFrame:
    """Orders created but not paid within fifteen minutes, and those paid in time."""
    return followed_by_or_timeout(orders, "orderId", ts, tie, order_created(), order_paid(), within,
                                  keep=keep or [ts], **kw)


def heat_warnings(readings: DataFrame, threshold: float, within: float = 10.0, *,
                  key: str = "rack", ts: str = "ts", tie: str = "event_id", **kw) -> DataFrame:
    """Two temperature readings in a row above the threshold; a power reading in between breaks
    the pair. The warning carries the average and the time of its last reading."""
    hot = (F.col("kind") == "temperature") & (F.col("value") > threshold)
    pair = sequence_match(readings, key, ts, tie, [Step(hot), Step(hot, NEXT)], within,
                          keep=["value", tie], **kw)
    return pair.select(key, F.col(f"s1.{ts}").alias(ts), F.col(f"s1.{tie}").alias(tie),
                       ((F.col("s0.value") + F.col("s1.value")) / 2).alias("average"))


def heat_alerts(warnings: DataFrame, within: float = 20.0, *, key: str = "rack", ts: str = "ts",
                tie: str = "event_id", **kw) -> DataFrame:
    """Two warnings in a row, the second hotter than the first."""
    any_row = F.lit(True)
    pair = sequence_match(warnings, key, ts, tie, [Step(any_row), Step(any_row, NEXT)], within,
                          keep=["average", tie], **kw)
    return pair.filter("s1.average > s0.average").select(
        key, F.col(f"s0.{tie}").alias("first_id"), F.col(f"s1.{tie}").alias("second_id"),
        F.col(f"s1.{ts}").alias(ts))
