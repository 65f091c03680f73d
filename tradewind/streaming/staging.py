"""History as a stream in order: staged by ranges of time (or log position), one range per micro-batch.

Files of a table hold all times mixed, so a watermark that follows them must wait for ever, and a streaming job over them
keeps its whole input in its state. Here the history is dealt into ranges first, by one shuffle; a driver releases
a range to the stream's folder when the one before has been worked off. The watermark then follows the ranges and state
is what one range and the delay hold, whatever the length of the history.

Releasing is a rename, so rows are written once. A run that was interrupted goes on where it stopped: released ranges
stay, and the stream's checkpoint knows which of them it has seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

ROWS = 4_000_000  # of a range: a micro-batch has a fixed cost, so ranges are no smaller than they must be
LEAST = 2
GRID = 10_000  # places for cuts, as fine as the quantiles are
PARTS = 16  # files of a range, at most
AT_ONCE = "0 seconds"  # trigger of a job that is fed range by range


class Staged:
    """`history` in ranges of about `rows` rows, by `at`, a whole number such as epoch microseconds or a log position.

    Equal values share a range. Rows without `at` come first. `closing` are rows of the same schema for a range of their own
    behind all others: what moves the watermark past the end of the data."""

    def __init__(self, history: DataFrame, at: Column, folder: str, *, rows: int = ROWS, closing: DataFrame | None = None):
        self.spark, self.schema, self.folder = history.sparkSession, history.schema, folder
        if not self._exists("staged/_SUCCESS"):
            keyed = history.select("*", at.cast("bigint").alias("_stage_at"))
            # One scan for the number of rows and all places at which a range can be cut.
            n, grid = keyed.agg(F.count("*"), F.percentile_approx("_stage_at", [i / GRID for i in range(1, GRID)], 10_000)).head()
            ranges = max(LEAST, -(-n // rows))
            cuts = sorted({grid[min(max(i * GRID // ranges, 1), GRID - 1) - 1] for i in range(1, ranges)}) if grid else []
            number = _range_of(F.coalesce("_stage_at", F.lit(-2**63)), cuts)
            if closing is not None:
                keyed = keyed.unionByName(closing.select("*", F.lit(None).cast("bigint").alias("_stage_at"), F.lit(True).alias(
                    "_stage_end")), allowMissingColumns=True)
                number = F.when(F.col("_stage_end"), len(cuts) + 1).otherwise(number)
            # Rows of one instant may be very many; the second key lets them spread over tasks. Dealt by hash: cutting by order
            # would read the history once more to find its cuts.
            part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in history.columns if not _map(history, c)]), F.lit(PARTS))
            keyed.withColumn("stage", number).repartition("stage", part).drop("_stage_at", "_stage_end").write.partitionBy(
                "stage").mode("overwrite").parquet(f"{folder}/staged")
        self._path("live").getFileSystem(self._conf()).mkdirs(self._path("live"))

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _exists(self, name: str) -> bool:
        at = self._path(name)
        return at.getFileSystem(self._conf()).exists(at)

    def stream(self) -> DataFrame:
        """The released ranges as a stream."""
        return self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").parquet(f"{self.folder}/live")

    def waiting(self) -> list[int]:
        """Ranges that are not released yet."""
        marks = self._path("staged/stage=*")
        found = marks.getFileSystem(self._conf()).globStatus(marks)
        return sorted(int(s.getPath().getName().split("=")[1]) for s in found or [])

    def release(self, number: int) -> None:
        source, target = self._path(f"staged/stage={number}"), self._path(f"live/{number:06d}")
        if not source.getFileSystem(self._conf()).rename(source, target):
            raise OSError(f"range {number} could not be released")

    def feed(self, query: StreamingQuery, between: Callable[[int], None] | None = None) -> StreamingQuery:
        """Releases range after range to a running query and stops it behind the last. `between` is called with a range's
        number when it has been worked off."""
        try:
            query.processAllAvailable()
            for number in self.waiting():
                self.release(number)
                query.processAllAvailable()
                if between:
                    between(number)
        finally:
            query.stop()
        return query


def _range_of(at: Column, cuts: list[int], first: int = 0) -> Column:
    """How many cuts are not above `at`, found by halving: a value that is a cut begins the range above it."""
    if not cuts:
        return F.lit(first)
    half = len(cuts) // 2
    return F.when(at < cuts[half], _range_of(at, cuts[:half], first)).otherwise(_range_of(at, cuts[half + 1:], first + half + 1))


def _map(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "map"


def closing_row(spark: SparkSession, schema, **values) -> DataFrame:
    """One row of the schema with these columns (plain values or columns), all others null."""
    return spark.range(1).select(*[
        (values[f.name] if isinstance(values.get(f.name), Column) else F.lit(values.get(f.name))).cast(f.dataType).alias(f.name)
        for f in schema.fields])
