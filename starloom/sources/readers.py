"""Readers: typed CSV extracts, lake tables by path or name, JDBC, and file options."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.schemas import RAW_FILES, raw_schema


def read_extract(spark: SparkSession, folder: str, entity: str, postal_as_text: bool = True):
    """One headered CSV extract. Columns bind by position; malformed cells become NULL."""
    return read_csv_typed(
        spark, f"{folder.rstrip('/')}/{RAW_FILES[entity]}", raw_schema(entity, postal_as_text)
    )


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("inferSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    options: dict | None = None,
) -> DataFrame:
    """JDBC scan, split over executors when a partition column and its bounds are given.

    User and password come from the environment (``JDBC_USER``, ``JDBC_PASSWORD``).
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for variable, option in [("JDBC_USER", "user"), ("JDBC_PASSWORD", "password")]:
        if os.environ.get(variable):
            reader = reader.option(option, os.environ[variable])
    if partition_column and bounds:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def read_files(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str,
    schema: T.StructType | None = None,
    glob: str | None = None,
    recursive: bool = False,
    ignore_corrupt: bool = False,
    modified_before: str | None = None,
    modified_after: str | None = None,
    **options,
) -> DataFrame:
    """File scan with the generic selection options of every file source."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    chosen = {
        "pathGlobFilter": glob,
        "recursiveFileLookup": recursive or None,
        "ignoreCorruptFiles": ignore_corrupt or None,
        "modifiedBefore": modified_before,
        "modifiedAfter": modified_after,
        **options,
    }
    for key, value in chosen.items():
        if value is not None:
            reader = reader.option(key, value)
    return reader.load(path if isinstance(path, str) else list(path))


def zoned(df: DataFrame) -> DataFrame:
    """Turn zone-less timestamps into instants of the session time zone."""
    casts = {
        f.name: F.col(f.name).cast("timestamp")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    return df.withColumns(casts) if casts else df


class TableSet:
    """Lazily opened Parquet tables ``<folder>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = zoned(read_path(self.spark, f"{self.folder}/{name}.parquet"))
        return self._open[name]

    def sql(self, text: str) -> DataFrame:
        """Run a SELECT whose ``{table}`` placeholders name tables of this set."""
        names = [n for n in TABLES if "{" + n + "}" in text]
        return self.spark.sql(text, **{n: self[n] for n in names})


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
