"""First event, then a second within a time: matches and time-outs from a live stream.

Batch form: `patterns.followed_by_or_timeout`. The stream form holds the events the watermark
has not passed yet. A call into Python has a fixed cost, so state is kept per bucket of keys
rather than per key, and each call works on all keys of its bucket at once; slices of time
bound the state of a busy key and spread it over tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tradewind.operators import patterns

BUCKETS = 1024

# Travels with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _settle(events: pd.DataFrame, reach: int, passed: int):
    """Split pending events, given that all events up to `passed` are known.

    Returns (decided first events with `paid`, -1 for a time-out; events to keep; next instant at
    which something can be decided, or None).
    """
    codes = pd.factorize(events["key"])[0]
    us, tie, first = (events[c].to_numpy() for c in ("us", "tie", "first"))
    # In key and time order. Of two entries made from one event the second kind sorts ahead, so
    # that an event never closes itself.
    order = np.lexsort((first, tie, us, codes))
    events, codes, us, first = events.iloc[order], codes[order], us[order], first[order]
    n = len(us)
    ahead = np.minimum.accumulate(np.where(first, n, np.arange(n))[::-1])[::-1]
    near = np.minimum(ahead, n - 1)
    met = (ahead < n) & (codes[near] == codes) & (us[near] - us < reach)
    due = np.where(met, us[near], us + reach)
    done = first & (due <= passed)
    waiting = first & ~done
    floor = min(us[waiting].min(), passed) if waiting.any() else passed
    kept = waiting | (~first & (us >= floor))
    wake = int(due[waiting].min()) if waiting.any() else None
    return (events[done].assign(paid=np.where(met, us[near], -1)[done]), events[kept], wake)


def _sliced(df: DataFrame, within: float, slice_seconds: float | None) -> DataFrame:
    """Add `_us`, `_slice` and `_home` to events with a time in `_at`.

    A slice also sees the first `within` of the next one, which is all a match that starts in it
    can need; `_home` marks the copy in an event's own slice.
    """
    seconds = max(slice_seconds or 8 * within, within)
    timed = df.withColumn("_us", F.unix_micros("_at")).filter(F.col("_us").isNotNull())
    own = timed.withColumn("_own", patterns.time_slice("_us", seconds))
    early = F.expr(f"pmod(_us, {int(seconds * 1_000_000)}) < {int(round(within * 1_000_000))}")
    copies = own.withColumn("_slice", F.explode(
        F.when(early, F.array(F.col("_own"), F.col("_own") - 1)).otherwise(F.array("_own"))))
    return copies.withColumn("_home", F.col("_slice") == F.col("_own")).drop("_own")


def followed_by_or_timeout(df: DataFrame, key: str, ts: str, tie: str, first: Column,
                           second: Column, within: float, *, delay: str = "0 seconds",
                           slice_seconds: float | None = None, buckets: int = BUCKETS,
                           payload: Column | None = None) -> DataFrame:
    """Rows (key, ts, tie, outcome, paid_ts), each emitted once the watermark settles it.

    `payload` is a text of the first event that is carried along and comes out as a column.

    `tie` must be a whole number; times are kept to the microsecond. `buckets` must stay the same for the
    life of a checkpoint, so it follows no setting of the session.
    """
    reach = int(round(within * 1_000_000))
    timed = df.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", delay)
    flagged = timed.select(key, "_at", F.col(tie).cast("bigint").alias("_tie"),
                           F.coalesce(first, F.lit(False)).alias("_first"),
                           F.coalesce(second, F.lit(False)).alias("_second"),
                           F.coalesce(F.when(first, payload) if payload is not None else F.lit(None),
                                      F.lit("")).alias("_payload"))
    # Every event must move the watermark, but only two kinds need to be shuffled. Naming the
    # event time in the condition keeps the filter above the watermark in the plan.
    needed = flagged.filter(F.col("_first") | F.col("_second") | F.col("_at").isNull())
    cut = _sliced(needed, within, slice_seconds).withColumn(
        "_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    kind = df.schema[key].dataType.simpleString()
    out = f"`{key}` {kind}, _us bigint, _tie bigint, _payload string, _paid bigint"
    names = ("key", "us", "tie", "payload", "first")
    held = (f"key array<{kind}>, us array<bigint>, tie array<bigint>, payload array<string>, "
            "first array<boolean>")

    def run(group: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = []
        if state.exists:
            parts.append(pd.DataFrame(dict(zip(names, map(list, state.get)))))
        for part in rows:
            if part.empty:  # a time-out call brings no events
                continue
            named = part.rename(columns={key: "key", "_us": "us", "_tie": "tie", "_payload": "payload"})
            for flag, chosen in ((True, part["_first"] & part["_home"]), (False, part["_second"])):
                parts.append(named.loc[chosen, list(names[:-1])].assign(first=flag))
        passed = state.getCurrentWatermarkMs() * 1000
        events = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame()
        if events.empty:
            if state.exists:
                state.remove()
            return
        done, kept, wake = _settle(events, reach, passed)
        if len(kept):
            state.update(tuple(kept[c].tolist() for c in names))
            wake = int(kept["us"].max()) if wake is None else wake
            state.setTimeoutTimestamp(max(-(-wake // 1000), passed // 1000 + 1))
        elif state.exists:
            state.remove()
        if len(done):
            yield pd.DataFrame({key: done["key"], "_us": done["us"], "_tie": done["tie"],
                                "_payload": done["payload"], "_paid": done["paid"]})

    settled = cut.groupBy("_bucket", "_slice").applyInPandasWithState(
        run, out, held, "append", GroupStateTimeout.EventTimeTimeout)
    paid = F.col("_paid") >= 0
    return settled.select(
        key, F.timestamp_micros("_us").alias(ts), F.col("_tie").alias(tie),
        F.when(paid, "paid").otherwise("timeout").alias("outcome"),
        F.when(paid, F.timestamp_micros("_paid")).alias("paid_ts"),
        *([F.col("_payload").alias("payload")] if payload is not None else []))
