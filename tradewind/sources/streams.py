"""Streaming and JDBC readers. The connector is a parameter: Kafka in production, a folder of
files in tests and back-fills; everything downstream is the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.operators import changefeed


def text_stream(spark: SparkSession, fmt: str = "kafka", *, path: str | None = None,
                **options) -> DataFrame:
    """One text record per row, in a column named `value`, and the time at which it came in."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string"), F.col("timestamp").alias("ingestTime"))
    return reader.schema("value string").load(path).select("value", F.col("_metadata.file_modification_time").alias("ingestTime"))


def change_stream(spark: SparkSession, fmt: str = "kafka", *, path: str | None = None,
                  descriptor: str | None = None, keep_origin: bool = False, **options) -> DataFrame:
    """Change records. From Kafka they are protobuf bytes, from text files JSON, from other files rows.

    With `keep_origin`, bytes and text also bring the record as it came and its place, for `sinks.with_dead_letters`."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt not in ("kafka", "text"):
        return reader.schema(schemas.ddl(schemas.CHANGE)).load(path)
    kept = list(changefeed.ORIGIN) if keep_origin else []
    if fmt == "kafka":
        place = [F.col("value"), F.col("value").alias("raw"), F.concat_ws("/", "topic", "partition").alias("source"),
                 F.col("offset").alias("position")]
        return changefeed.decode(reader.load().select(*place), descriptor, "value", keep=kept)
    place = [F.col("value"), F.col("value").alias("raw"), F.col("_metadata.file_path").alias("source"),
             F.col("_metadata.file_block_start").alias("position")]
    return changefeed.from_json_text(reader.schema("value string").load(path).select(*place), "value", keep=kept)


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                **options) -> DataFrame:
    return spark.readStream.format(fmt).options(**options).schema(schema).load(path)


def jdbc_dimension(spark: SparkSession, url: str, table: str, dimension: str, *,
                   partition_column: str | None = None, bounds: tuple[int, int] | None = None,
                   partitions: int = 16, **options) -> DataFrame:
    """Full load of one dimension: only its own columns are read, split on a numeric key."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .options(**options))
    if partition_column and bounds:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1]))
                  .option("numPartitions", str(partitions)))
    return project_dimension(reader.load(), dimension)


def project_dimension(rows: DataFrame, dimension: str) -> DataFrame:
    """The columns of a dimension, typed."""
    _, fields = schemas.DIMENSIONS[dimension]
    return rows.select(*[F.col(n).try_cast(t).alias(n) for n, t in fields])
