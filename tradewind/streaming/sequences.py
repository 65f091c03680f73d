"""Sequences of neighbouring events from a live stream: the streaming forms of `patterns.strict_pair`,
`patterns.repeat_match` and the rules built on them.

Events are held per key and slice of time until the watermark has passed the slice, then sorted and looked through, so
they may arrive in any order within the delay. A slice also holds the head of what follows, as long as a match may
take: an event's neighbours that matter are then all in its own slice, and a pair or run that crosses a border is found
once, in the slice in which it begins. State is what the slices not yet passed hold; a busy key is as many rows as it
has slices, and slices are shorter the busier it is.

Everything is Spark's own windowed aggregation, so the results of one rule can be the input of the next in the same query:
they carry the time at which their slice was settled, and the second rule's slices follow that clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import times

CLOCK = "_settled"  # window in which a result was found: the event time of what follows


def _us(seconds: float) -> int:
    return int(round(seconds * 1_000_000))


def _interval(us: int) -> str:
    return f"{us} microseconds"


def _held(df: DataFrame, key: str, clock: Column, event: Column, length: int, beyond: int) -> DataFrame:
    """key, CLOCK, _e: the events of a key (structs that begin with their order) in each slice and the head of the next.

    `event` has the field `_home`, an instant on the clock in microseconds, by which it belongs to one slice."""
    slices = F.window(clock, _interval(length + beyond), _interval(length)).alias(CLOCK)
    return df.groupBy(F.col(key), slices).agg(F.sort_array(F.collect_list(event)).alias("_e"))


def _from_slice(found: DataFrame, length: int) -> DataFrame:
    """Matches `_m` whose first event `a` belongs to the slice."""
    begin = F.unix_micros(F.col(CLOCK)["start"])
    return found.where((F.col("_m.a._home") >= begin) & (F.col("_m.a._home") < begin + length))


def _timed(df: DataFrame, key: str, ts: str, delay: str, where: Column) -> DataFrame:
    """Events that fit and have a key, under a watermark that all events move, also those that are left out. Naming the event
    time in the condition keeps it behind the watermark; events without a time are in no slice."""
    timed = df.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", delay)
    return timed.where((F.col(key).isNotNull() & F.coalesce(where, F.lit(False))) | F.col("_at").isNull())


def _length(slice_seconds: float | None, within: float) -> int:
    return _us(max(slice_seconds or 2 * within, within))


def _adjacent(held: DataFrame, first: str, second: str, length: int, within: int) -> DataFrame:
    """One row per pair of neighbours `_m.a`, `_m.b` of the flags `first` and `second`, less than `within` apart."""
    pairs = F.transform("_e", lambda e, i: F.struct(e.alias("a"), F.get("_e", i + 1).alias("b")))
    fits = F.filter(pairs, lambda p: F.coalesce(p["a"][first] & p["b"][second] & (p["b"]["_us"] - p["a"]["_us"] < within), F.lit(False)))
    return _from_slice(held.withColumn("_m", F.explode(fits)), length)


def strict_pairs(df: DataFrame, key: str, ts: str, tie: str, first: Column, second: Column, within: float, *, keep: list[str],
                 delay: str = "0 seconds", slice_seconds: float | None = None) -> DataFrame:
    """`first` directly followed by `second` in less than `within` seconds: key, structs `s0` and `s1` of the columns
    `keep`, and the clock for what follows. Later than `delay` is dropped."""
    length, reach = _length(slice_seconds, within), _us(within)
    flag = lambda c: F.coalesce(c, F.lit(False))
    us = times.micros(F.col(ts))
    # Every event may stand between two others, but only those of the pair need their columns.
    row = F.when(flag(first) | flag(second), F.struct(*keep))
    event = F.struct(us.alias("_us"), F.col(tie).alias("_tie"), us.alias("_home"), flag(first).alias("_first"),
                     flag(second).alias("_second"), row.alias("_row"))
    held = _held(_timed(df, key, ts, delay, F.lit(True)), key, F.col("_at"), event, length, reach)
    return _adjacent(held, "_first", "_second", length, reach).select(
        key, F.col("_m.a._row").alias("s0"), F.col("_m.b._row").alias("s1"), CLOCK)


def repeats(df: DataFrame, key: str, ts: str, tie: str, where: Column, times_n: int, within: float, *, same: str | None = None,
            keep: list[str] | None = None, delay: str = "0 seconds", slice_seconds: float | None = None) -> DataFrame:
    """`times_n` suitable events in a row in less than `within` seconds, with `same` of one value in that column: the first
    event's `keep` columns and the last one's time. Unsuitable events never reach the state."""
    keep, length, reach = keep or [ts], _length(slice_seconds, within), _us(within)
    us = times.micros(F.col(ts))
    rows = _timed(df, key, ts, delay, where)
    event = F.struct(us.alias("_us"), F.col(tie).alias("_tie"), us.alias("_home"), F.struct(*dict.fromkeys([ts, *keep])).alias("_row"),
                     (F.col(same) if same else F.lit(0)).alias("_v"))
    held = _held(rows, key, F.col("_at"), event, length, reach)
    if same:
        # How many events up to each one have its value without a break: a count that a change sets back.
        empty = F.array().cast("array<int>")
        run = F.aggregate(F.sequence(F.lit(0), F.size("_e") - 1), F.struct(empty.alias("runs"), F.lit(0).alias("n")), lambda s, i: F.struct(
            F.concat(s["runs"], F.array(_run(s, i))).alias("runs"), _run(s, i).alias("n")))["runs"]
        held = held.withColumn("_runs", run)
    last = times_n - 1
    ends = F.transform("_e", lambda e, i: F.struct(e.alias("a"), F.get("_e", i + last).alias("b"),
                                                   (F.get("_runs", i + last) if same else F.lit(times_n)).alias("n")))
    fits = F.filter(ends, lambda m: F.coalesce((m["b"]["_us"] - m["a"]["_us"] < reach) & (m["n"] >= times_n), F.lit(False)))
    return _from_slice(held.withColumn("_m", F.explode(fits)), length).select(
        key, *[F.col(f"_m.a._row.{c}").alias(c) for c in keep if c != key], F.col(f"_m.b._row.{ts}").alias("last_ts"), CLOCK)


def _run(state: Column, i: Column) -> Column:
    here, before = F.get("_e", i)["_v"], F.get("_e", i - 1)["_v"]
    return F.when(here == before, state["n"] + 1).otherwise(F.when(here.isNull(), 0).otherwise(1))


def heat_warnings(readings: DataFrame, threshold: float, within: float = 10.0, *, key: str = "rack", ts: str = "ts",
                  tie: str = "event_id", **how) -> DataFrame:
    """`patterns.heat_warnings` of a stream, with the clock for `heat_alerts`."""
    hot = (F.col("kind") == "temperature") & (F.col("value") > threshold)
    pairs = strict_pairs(readings, key, ts, tie, hot, hot, within, keep=["value", tie, ts], **how)
    return pairs.select(key, F.col(f"s1.{ts}").alias(ts), F.col(f"s1.{tie}").alias(tie),
                        ((F.col("s0.value") + F.col("s1.value")) / 2).alias("average"), CLOCK)


def heat_alerts(readings: DataFrame, threshold: float, within: float = 10.0, alert_within: float = 20.0, *, key: str = "rack",
                ts: str = "ts", tie: str = "event_id", slice_seconds: float | None = None, alert_slice_seconds: float | None = None,
                delay: str = "0 seconds") -> DataFrame:
    """`patterns.heat_alerts` straight from the stream of readings: two stateful operators in one query. The first one's
    warnings, sorted by nothing but their slices, are the second one's events."""
    first = _length(slice_seconds, within)
    warnings = heat_warnings(readings, threshold, within, key=key, ts=ts, tie=tie, slice_seconds=slice_seconds, delay=delay)
    # A warning is settled at the end of its first reading's slice: at most that slice and both reaches lie between the clocks
    # of two warnings that make an alert.
    length, beyond = _length(alert_slice_seconds, alert_within), first + _us(within) + _us(alert_within)
    clock = F.window_time(F.col(CLOCK))
    us = times.micros(F.col(ts))
    event = F.struct(us.alias("_us"), F.col(tie).alias("_tie"), F.unix_micros(clock).alias("_home"), F.lit(True).alias("_any"),
                     F.col("average"), F.col(ts).alias("_ts"))
    held = _held(warnings, key, clock, event, length, beyond)
    return _adjacent(held, "_any", "_any", length, _us(alert_within)).where("_m.b.average > _m.a.average").select(
        key, F.col("_m.a._tie").alias("first_id"), F.col("_m.b._tie").alias("second_id"), F.col("_m.b._ts").alias(ts))
