"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings that can change at run time. Wall-clock text (log times, day keys) must not
# depend on the executor's zone, so the session zone is pinned.
_RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    # Wide records compile to methods the JVM never optimises (above 8000 bytes of bytecode
    # it interprets them, several times slower); with this limit Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Whole texts travel to Python workers; ten thousand of them in one batch can be a lot.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build(app: str = "tradewind", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; `master` is left to spark-submit on a cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else made."""
    for key, value in _RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_STATE = "spark.sql.streaming.stateStore"
#: State on the executors' disks, in a bounded part of their memory; a commit writes its changes, and one store holds a join's sides.
_ON_DISK = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}.rocksdb.maxMemoryUsageMB": "100",
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


@contextlib.contextmanager
def state_partitions(spark: SparkSession, on_disk: bool = False) -> Iterator[int]:
    """Streams started inside keep their state in two partitions a core, or in fewer if the session has fewer.

    A micro-batch commits every partition of every state store, rows or none, and a stream takes the number at its start, where
    run-time planning does not lessen it. A checkpoint keeps its number, so this is for streams whose checkpoint is new, and so
    is `on_disk`, for state that grows with the data."""
    name = "spark.sql.shuffle.partitions"
    few = min(int(spark.conf.get(name)), 2 * spark.sparkContext.defaultParallelism)
    wanted = {name: str(few)} | (_ON_DISK if on_disk else {})
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield few
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@functools.cache
def _local_scratch() -> str:
    base = tempfile.mkdtemp(prefix="tradewind-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The folder is read from `spark.checkpoint.dir`, or is the one set with `setCheckpointDir`. Only a
    session on one machine may name none; it gets a temporary folder that goes with the process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/tradewind/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder once and read from there."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
