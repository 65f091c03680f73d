"""Tables of latest rows: folds of growing spans, in buckets by key."""

from __future__ import annotations

import glob
import random
import re

from pyspark.sql import functions as F

from tradewind.streaming import sinks

SCHEMA = "id long, at long, eventType string, v string"


def test_folds_write_a_share_and_keep_the_state(spark, tmp_path):
    path, rnd, state, written, sent = str(tmp_path / "t"), random.Random(1), {}, {}, 0
    clock = list(range(10_000))
    rnd.shuffle(clock)
    for n in range(27):
        rows = [(rnd.randrange(40), clock.pop(), rnd.choice(["insert", "update", "update", "delete"]), f"v{n}-{i}") for i in range(3)]
        for r in rows:
            if r[0] not in state or state[r[0]][1] < r[1]:
                state[r[0]] = r
        sent += len(rows)
        sinks.append_changes(spark.createDataFrame(rows, SCHEMA).coalesce(1), n, path, ["id"], ["at"], reduce_every=3)
        for a, b, level in sinks._folds(spark, path):
            if (a, b, level) not in written:
                written[a, b, level] = spark.read.parquet(f"{path}/reduced/fold_level={level}/fold_batches={a}-{b}").count()
        if n % 9 == 0 or n == 26:
            want = {k: r[3] for k, r in state.items() if r[2] != "delete"}
            assert {r.id: r.v for r in sinks.read_latest(spark, path, ["id"], ["at"]).collect()} == want
    # 27 batches in spans of 3: three levels, each of which writes a row once at most.
    assert {level for _, _, level in written} == {1, 2, 3} and sum(written.values()) <= 3 * sent
    assert sum(n for (_, _, level), n in written.items() if level == 1) <= sent
    folds, batches = sinks._chosen(spark, path)
    assert folds == [(0, 26, 3)] and batches == []

    some = [(k,) for k in sorted(state)[:3]]
    got = sinks.read_latest(spark, path, ["id"], ["at"], only=some)
    want = {k: state[k][3] for k, in some if state[k][2] != "delete"}
    assert {r.id: r.v for r in got.collect()} == want
    assert re.search(r"PartitionFilters: \[[^\]]*fold_bucket#\d+ (IN|=)", got._jdf.queryExecution().toString())
    buckets = glob.glob(f"{path}/reduced/fold_level=3/*/fold_bucket=*")
    read = {r.f.split("fold_bucket=")[1].split("/")[0] for r in sinks._rows_of(spark, path, folds, [], [
        int(buckets[0].split("=")[-1])]).select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(buckets) > 3 and len(read) == 1


def test_folds_without_rows_and_missing_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.read_latest(spark, path, ["id"], ["at"]) is None and sinks.read_latest(spark, path, ["id"], ["at"], only=[(1,)]) is None
    none = spark.createDataFrame([], SCHEMA)
    for n in (0, 1, 3):
        sinks.append_changes(none, n, path, ["id"], ["at"], reduce_every=2)
        assert sinks.read_latest(spark, path, ["id"], ["at"]).collect() == []
    # Batches 4 and 5 never came; a batch at the end of a longer span folds what there is.
    for n in (6, 7):
        sinks.append_changes(spark.createDataFrame([(n, n, "insert", "x")], SCHEMA), n, path, ["id"], ["at"], reduce_every=2)
    assert sorted(r.id for r in sinks.read_latest(spark, path, ["id"], ["at"]).collect()) == [6, 7]
    assert (0, 7, 3) in sinks._folds(spark, path)
    # A fold by hand crosses the spans of later ones; nothing is lost or comes back.
    sinks.append_changes(spark.createDataFrame([(6, 8, "delete", None)], SCHEMA), 8, path, ["id"], ["at"], reduce_every=2)
    sinks.reduce_changes(spark, path, ["id"], ["at"])
    for n in range(9, 16):
        sinks.append_changes(spark.createDataFrame([(n, n, "insert", "x")], SCHEMA), n, path, ["id"], ["at"], reduce_every=2)
        assert sorted(r.id for r in sinks.read_latest(spark, path, ["id"], ["at"]).collect()) == [7, *range(9, n + 1)]
