"""Streaming inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.sources.readers import zoned


FILES_PER_TRIGGER = 1_000


def stream_table(
    spark: SparkSession, folder: str, table: str, files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    """Follow the Parquet files of one table; new files are picked up as they arrive.

    ``files_per_trigger`` bounds a micro-batch, so that a long history is not read at once.
    A streaming path must be a folder or a pattern; the pattern covers a one-file table too.
    """
    path = f"{folder.rstrip('/')}/{table}[.]parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return zoned(reader.parquet(path))


def stream_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Follow a message topic as (key, value) texts. Needs the Kafka package on the cluster."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def words(lines: DataFrame, column: str) -> DataFrame:
    return lines.select(F.explode(F.split(column, "[ \\n]")).alias("word"))
