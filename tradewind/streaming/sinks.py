"""Sinks. Every one can be run again for the same micro-batch without doubling its rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from tradewind import schemas
from tradewind.functions import text
from tradewind.operators import changefeed

CHECKPOINT_EVERY = "5 seconds"


def _trigger(writer: DataStreamWriter, once: bool | str) -> DataStreamWriter:
    """`once`: True ends the job behind what is there now; a text is the time between micro-batches."""
    if once is True:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=once or CHECKPOINT_EVERY)


def write_rows(df: DataFrame, path: str, checkpoint: str, *, once: bool | str = False) -> StreamingQuery:
    """Rows as they are, to a folder of Parquet files."""
    return _trigger(df.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint), once).start()


def write_json(df: DataFrame, target: str, checkpoint: str, **kw) -> StreamingQuery:
    """Rows as JSON objects to a topic (Kafka) or a folder (file formats)."""
    return write_values(df.select(text.entity_json(df).alias("value")), target, checkpoint, **kw)


def write_values(values: DataFrame, target: str, checkpoint: str, *, fmt: str = "kafka",
                 once: bool = False, **options) -> StreamingQuery:
    """The text column `value` to a topic or a folder."""
    writer = (values.writeStream.format(fmt).outputMode("append").options(**options)
              .option("checkpointLocation", checkpoint))
    writer = writer.option("topic", target) if fmt == "kafka" else writer.option("path", target)
    return _trigger(writer, once).start()


def write_json_batch(df: DataFrame, target: str, batch_id: int, *, fmt: str, **options) -> None:
    """One micro-batch as JSON. A folder gets one sub-folder per batch, replaced on a retry."""
    out = df.select(text.entity_json(df).alias("value")).write.format(fmt).options(**options)
    if fmt == "kafka":
        out.option("topic", target).save()
    else:
        out.mode("overwrite").save(f"{target}/batch_id={batch_id}")


def each_batch(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, *,
               once: bool = False, mode: str = "append") -> StreamingQuery:
    writer = (df.writeStream.outputMode(mode).foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    return _trigger(writer, once).start()


# ---- tables of latest rows --------------------------------------------------------------
#
# A table of latest rows is a folder of change batches plus folds: folders in which a span of
# batches has been reduced to one row per key. Folds have levels: `REDUCE_EVERY` batches make one of
# the first level, as many of those one of the second, and so on. A row is thus written again once a
# level, however large the table has become, and a reader has some folders of each level to read.
# Folds are in buckets by key, so that a reader of few keys leaves the others closed.

REDUCE_EVERY = 100
BUCKETS = 16  # of every fold; part of the format


def append_changes(batch: DataFrame, batch_id: int, path: str, key: list[str], order: list[str], *,
                   event: str = "eventType", reduce_every: int = REDUCE_EVERY,
                   finish: Callable[[DataFrame], DataFrame] = lambda last: last) -> None:
    """Keep a micro-batch's last change per key, deletes included. `finish` adds columns to these: it keeps every row, the
    key, the order and the event. A batch that ends a span of `reduce_every` batches,
    or of a power of that, folds the largest such span. Writing costs the batch's share: a fold reads the folds inside its
    span, never what lies before it."""
    values = [c for c in batch.columns if c not in (*key, *order, event)]
    last = changefeed.latest(batch, key, order, values, event=event, with_deleted=True)
    finish(last).write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
    level = 0
    while (batch_id + 1) % reduce_every ** (level + 1) == 0:
        level += 1
    if level:
        spark = batch.sparkSession
        _fold(spark, path, level, batch_id + 1 - reduce_every ** level, batch_id, key, order, event)
        _drop_folded(spark, path, batch_id)


def _names(spark: SparkSession, pattern: str) -> list[list[str]]:
    """Values in the names `a=1/b=2` of the finished folders that a pattern finds, by one listing."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks)
    paths = [s.getPath().getParent().toString().split("/")[-pattern.count("="):] for s in found or []]
    return [[name.split("=")[1] for name in path] for path in paths]


def _finished(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers N of the finished sub-folders `name=N`."""
    return sorted(int(n) for n, in _names(spark, f"{path}/{name}=*"))


def _folds(spark: SparkSession, path: str) -> list[tuple[int, int, int]]:
    """(first batch, last batch, level) of the finished folds."""
    return [(*map(int, span.split("-")), int(level)) for level, span in _names(spark, f"{path}/reduced/fold_level=*/fold_batches=*")]


def _inside(span: tuple, other: tuple) -> bool:
    return other[0] <= span[0] and span[1] <= other[1]


def _chosen(spark: SparkSession, path: str, span: tuple[int, int] | None = None) -> tuple[list[tuple], list[int]]:
    """(folds, batches) that hold all changes, or all of a span: the longest folds, and what none of them covers."""
    whole = [f for f in _folds(spark, path) if span is None or _inside(f, span)]
    whole.sort(key=lambda f: (f[0] - f[1], f))
    taken: list[tuple] = []
    for f in whole:
        if not any(_inside(f, t) for t in taken):
            taken.append(f)
    batches = [n for n in _finished(spark, f"{path}/changes", "batch_id") if span is None or span[0] <= n <= span[1]]
    return taken, [n for n in batches if not any(t[0] <= n <= t[1] for t in taken)]


def _bucket(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


def _rows_of(spark: SparkSession, path: str, folds: list[tuple], batches: list[int], buckets: list[int] | None = None) -> DataFrame | None:
    """Rows of these folders; of the folds only these buckets."""
    known = _finished(spark, f"{path}/changes", "batch_id")
    if not known or not (folds or batches):
        return None
    # A fold without rows has no files; the newest batch, which is always there, tells the columns.
    schema = spark.read.parquet(f"{path}/changes/batch_id={known[-1]}").schema
    rows = None
    if batches:
        rows = spark.read.schema(schema).parquet(*[f"{path}/changes/batch_id={n}" for n in batches])
    if folds:
        reduced = spark.read.schema(StructType([*schema.fields, StructField("fold_bucket", IntegerType())])).option(
            "basePath", f"{path}/reduced").parquet(*[f"{path}/reduced/fold_level={lv}/fold_batches={a}-{b}" for a, b, lv in folds])
        if buckets is not None:
            reduced = reduced.where(F.col("fold_bucket").isin(buckets))
        reduced = reduced.select(*schema.names)
        rows = reduced if rows is None else rows.unionByName(reduced)
    return rows


def _fold(spark: SparkSession, path: str, level: int, first: int, upto: int, key: list[str], order: list[str], event: str) -> None:
    """Reduce a span of batches to one row per key. Deletes stay, so that a late older change does not bring a row back."""
    if (first, upto) in {f[:2] for f in _folds(spark, path)}:
        return  # a batch that is run again has been folded already
    rows = _rows_of(spark, path, *_chosen(spark, path, (first, upto)))
    if rows is None:
        return
    values = [c for c in rows.columns if c not in (*key, *order, event)]
    last = changefeed.latest(rows, key, order, values, event=event, with_deleted=True).withColumn("fold_bucket", _bucket(key))
    # Run-time planning puts small buckets into one task and cuts large ones.
    last.hint("rebalance", "fold_bucket").write.mode("overwrite").partitionBy("fold_bucket").parquet(
        f"{path}/reduced/fold_level={level}/fold_batches={first}-{upto}")


def _drop_folded(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove what lies in folds older than the one that ends with this batch. What that one has folded stays, for
    readers that listed the folders before."""
    folds = _folds(spark, path)
    old = [f for f in folds if f[1] < batch_id]
    gone = [f"{path}/reduced/fold_level={f[2]}/fold_batches={f[0]}-{f[1]}" for f in folds
            if any(_inside(f, o) and f[:2] != o[:2] for o in old)]
    gone += [f"{path}/changes/batch_id={n}" for n in _finished(spark, f"{path}/changes", "batch_id")
             if any(o[0] <= n <= o[1] for o in old)]
    for folder in gone:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _merged(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows that decide the current state."""
    return _rows_of(spark, path, *_chosen(spark, path))


def read_latest(spark: SparkSession, path: str, key: list[str], order: list[str], *,
                event: str = "eventType", only: list[tuple] | None = None) -> DataFrame | None:
    """Current rows of a table of latest rows; with `only`, those of a few keys, for which few buckets are opened."""
    folds, batches = _chosen(spark, path)
    if only is None:
        rows = _rows_of(spark, path, folds, batches)
    else:
        every = _rows_of(spark, path, folds, batches)
        if every is None:
            return None
        wanted = spark.createDataFrame(only, StructType([every.schema[k] for k in key])).distinct()
        buckets = [r[0] for r in wanted.select(_bucket(key)).distinct().collect()]
        rows = _rows_of(spark, path, folds, batches, buckets).join(F.broadcast(wanted), key, "left_semi")
    if rows is None:
        return None
    values = [c for c in rows.columns if c not in (*key, *order, event)]
    if len(folds) + len(batches) == 1:  # one folder has one row per key already
        return rows.where(F.col(event) != "delete").select(*key, *values)
    return changefeed.latest(rows, key, order, values, event=event)


def reduce_changes(spark: SparkSession, path: str, key: list[str], order: list[str], *,
                   event: str = "eventType") -> None:
    """Fold all batches so far into one folder, of level 0: for maintenance, not needed by readers or writers."""
    known = _finished(spark, f"{path}/changes", "batch_id")
    if known:
        _fold(spark, path, 0, 0, known[-1], key, order, event)


def sync_dimensions(changes: DataFrame, path: str, checkpoint: str, *, once: bool | str = False,
                    dimensions: Iterable[str] = tuple(schemas.DIMENSIONS)) -> StreamingQuery:
    """Keep dimension tables up to date from the change feed, one pass over the feed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            for table in dimensions:
                key, fields = schemas.DIMENSIONS[table]
                rows = changefeed.of_table(held, table).select(
                    "eventType", *changefeed.CHANGE_ORDER, *changefeed.typed(fields))
                append_changes(rows, batch_id, f"{path}/{table}", [key], list(changefeed.CHANGE_ORDER))
        finally:
            held.unpersist()

    return each_batch(changefeed.of_tables(changes, dimensions), write, checkpoint, once=once)


def with_dead_letters(decoded: DataFrame, write: Callable[[DataFrame, int], None], letters: str, checkpoint: str, *,
                      once: bool | str = False) -> StreamingQuery:
    """One pass, two sinks: good records to `write`, bad ones as they came, with where they came from, to the folder
    `letters`. Both are replaced when a micro-batch is run again."""
    def both(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            good, bad = changefeed.quarantine(held)
            write(good.drop(*changefeed.ORIGIN), batch_id)
            bad.select(*changefeed.ORIGIN).write.mode("overwrite").parquet(f"{letters}/batch_id={batch_id}")
        finally:
            held.unpersist()

    return each_batch(decoded, both, checkpoint, once=once)


def read_dimension(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    key, fields = schemas.DIMENSIONS[table]
    rows = read_latest(spark, f"{path}/{table}", [key], list(changefeed.CHANGE_ORDER))
    return rows if rows is None else rows.select(*[n for n, _ in fields])
