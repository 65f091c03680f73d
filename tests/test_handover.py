"""Load then follow against the source's own history, the Kafka forms of sources, and records that don't decode."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from test_streaming import values
from tradewind import schemas
from tradewind.operators import changefeed
from tradewind.sources import streams, tables
from tradewind.streaming import handover, sinks

KEY, ORDER = ["id"], ["executeTime", "logfileName", "logfileOffset"]


def history(seed, keys=30, changes=200):
    """(position, key, event, value): inserts, updates, deletes and new inserts of deleted keys."""
    r, alive, out = random.Random(seed), set(), []
    for at in range(1, changes + 1):
        k = r.randrange(keys)
        event = r.choice(["update", "delete"]) if k in alive else "insert"
        (alive.discard if event == "delete" else alive.add)(k)
        out.append((at, k, event, f"v{at}"))
    return out


def source_at(changes, position):
    rows = {}
    for at, k, event, v in changes:
        if at <= position:
            rows.pop(k, None) if event == "delete" else rows.__setitem__(k, v)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_any_interleaving_gives_the_source(spark, tmp_path, seed):
    changes, r, path = history(seed), random.Random(seed), str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "log", *c) for c in changes],
                                  "executeTime long, logfileName string, logfileOffset long, id long, eventType string, v string")
    ranges = handover.key_ranges(0, 29, 4)
    place = lambda at: {"executeTime": 1, "logfileName": "log", "logfileOffset": at}
    cuts = sorted(r.sample(range(1, 200), 3)) + [200]
    loads = {n: r.randrange(len(cuts)) for n in range(len(ranges))}
    begun = 0
    for batch, upto in enumerate(cuts):
        # The feed of this test begins at a position of its own, as a log that is kept for some days does.
        sinks.append_changes(frame.where((F.col("logfileOffset") > begun) & (F.col("logfileOffset") <= upto)), batch, path, KEY, ORDER)
        begun = upto
        for n in (n for n, b in loads.items() if b == batch):
            low = r.randint(upto, 200)
            seen = r.randint(low, 200)
            high = r.randint(seen, 200)
            at = iter([place(low), place(high)])
            rows = spark.createDataFrame(list(source_at(changes, seen).items()), "id long, v string").where(handover.in_range("id", *ranges[n]))
            assert handover.load_range(spark, lambda: rows, lambda: next(at), n, path)
            assert not handover.load_range(spark, lambda: 1 / 0, lambda: 1 / 0, n, path)  # it is done
            assert (n in handover.trusted_ranges(spark, path, place(high))) and (high == low or n not in handover.trusted_ranges(
                spark, path, place(high - 1)))
        # What can be trusted is what the source has held at the position reached.
        got = handover.read_latest(spark, path, KEY, ORDER, applied=place(upto), within=lambda n: handover.in_range("id", *ranges[n]))
        trusted = handover.trusted_ranges(spark, path, place(upto))
        want = {k: v for k, v in source_at(changes, upto).items() if any(
            (ranges[n][0] is None or k >= ranges[n][0]) and (ranges[n][1] is None or k < ranges[n][1]) for n in trusted)}
        assert {x.id: x.v for x in got.collect()} == want
    assert {x.id: x.v for x in handover.read_latest(spark, path, KEY, ORDER).collect()} == source_at(changes, 200)


def test_rows_older_than_the_feed_come_from_the_load(spark, tmp_path):
    changes, path = history(9), str(tmp_path / "t")
    late = [c for c in changes if c[0] > 150]  # the log no longer has what came before
    frame = spark.createDataFrame([(1, "log", *c) for c in late],
                                  "executeTime long, logfileName string, logfileOffset long, id long, eventType string, v string")
    sinks.append_changes(frame, 0, path, KEY, ORDER)
    at = iter([{"executeTime": 1, "logfileName": "log", "logfileOffset": p} for p in (160, 180)])
    rows = spark.createDataFrame(list(source_at(changes, 170).items()), "id long, v string")
    handover.load_range(spark, lambda: rows, lambda: next(at), 0, path)
    assert {x.id: x.v for x in handover.read_latest(spark, path, KEY, ORDER).collect()} == source_at(changes, 200)
    assert handover.read_latest(spark, str(tmp_path / "none"), KEY, ORDER) is None


def test_key_ranges_hold_every_key_once(spark):
    for least, most, n in ((1, 100, 7), (5, 5, 4), (-3, 2, 16), (None, None, 4)):
        ranges = handover.key_ranges(least, most, n)
        keys = spark.createDataFrame([(k,) for k in (None, -50, -1, 0, 1, 5, 99, 1000)], "id long")
        counts = [keys.where(handover.in_range("id", *r)).count() for r in ranges]
        assert sum(counts) == 8 and len(ranges) <= n


def test_kafka_forms_bind_and_keep_their_place(spark, monkeypatch):
    """The readers' own calls, with a frame in place of the connector and a plain decoder in place of the protobuf package."""
    frame = spark.createDataFrame([(bytearray(b"{}"), "changes", 3, 7, None)], "value binary, topic string, partition int, offset long, timestamp timestamp")

    class Reader:
        def format(self, fmt):
            assert fmt == "kafka"
            return self

        def options(self, **options):
            assert options == {"subscribe": "changes"}
            return self

        def load(self):
            return frame

    class Session:
        readStream = Reader()

    seen = []

    def decode(df, descriptor, value="value", *, keep=None):
        seen.append((df.columns, descriptor, value, keep))
        return df.select(*keep, *[F.lit(None).cast(t).alias(n) for n, t in schemas.CHANGE])

    monkeypatch.setattr(changefeed, "decode", decode)
    got = streams.change_stream(Session(), "kafka", descriptor="d", subscribe="changes")
    assert got.columns == [n for n, _ in schemas.CHANGE]
    got = streams.change_stream(Session(), "kafka", descriptor="d", keep_origin=True, subscribe="changes")
    assert [tuple(r)[:3] for r in got.collect()] == [(bytearray(b"{}"), "changes/3", 7)]
    assert [s[1:] for s in seen] == [("d", "value", []), ("d", "value", list(changefeed.ORIGIN))]
    assert streams.text_stream(Session(), "kafka", subscribe="changes").columns == ["value", "ingestTime"]


def test_good_and_bad_records_are_the_input(spark, root, tmp_path):
    feed = tables.order_changes(spark, root).limit(200)
    lines = [r.value for r in feed.select(F.to_json(F.struct(*feed.columns)).alias("value")).collect()]
    broken = ["", "{", "[1]", "null", '{"tableName": "orders"}', "plain text", '{"eventType": "insert"}']
    spark.createDataFrame([(x,) for x in [*lines, *broken]], "value string").repartition(3).write.text(f"{tmp_path}/in")
    changes = streams.change_stream(spark, "text", path=f"{tmp_path}/in", keep_origin=True)
    for _ in range(2):  # the second run has nothing to do
        sinks.with_dead_letters(changes, lambda b, n: b.write.mode("overwrite").parquet(f"{tmp_path}/good/batch_id={n}"),
                                f"{tmp_path}/bad", f"{tmp_path}/c", once=True).awaitTermination()
    good = spark.read.schema(feed.schema).parquet(f"{tmp_path}/good")
    plain = lambda df: values(df.select(*[c for c in feed.columns if c != "columns"], F.sort_array(F.map_entries("columns"))))
    assert plain(good) == plain(feed)
    bad = spark.read.parquet(f"{tmp_path}/bad")
    assert sorted(r.raw for r in bad.collect()) == sorted(broken) and bad.where("source IS NULL").count() == 0


def test_a_fold_that_runs_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, 5, "insert", "a"), (2, 6, "insert", "b")], "id long, at long, eventType string, v string")
    for _ in range(2):
        sinks.append_changes(batch, 3, path, KEY, ["at"], reduce_every=4)
        assert {r.id: r.v for r in sinks.read_latest(spark, path, KEY, ["at"]).collect()} == {1: "a", 2: "b"}
