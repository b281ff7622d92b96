"""Named queries with their SQL checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.plans.bindings import BoundEntities, SecondDelivery
from starloom.sources.readers import TableSet


@dataclass(frozen=True)
class Inputs:
    """What a registered query gets: the tables, and the clinical-shaped views of them."""

    spark: SparkSession
    folder: str
    tables: TableSet
    enriched: BoundEntities
    second: BoundEntities


def open_inputs(spark: SparkSession, folder: str) -> Inputs:
    tables = TableSet(spark, folder)
    return Inputs(
        spark, folder, tables, BoundEntities(tables), BoundEntities(SecondDelivery(tables))
    )


def portable(df: DataFrame) -> DataFrame:
    """Column types every engine prints alike: dates and instants as text, decimals as
    doubles."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            casts[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f.name).cast("double")
    return df.withColumns(casts) if casts else df


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, build: Callable[[Inputs], DataFrame], sql: str | None = None):
        if name in self.queries:
            raise ValueError(f"query {name} is registered twice")
        self.queries[name] = lambda spark, folder: portable(build(open_inputs(spark, folder)))
        if sql is not None:
            self.sql[name] = sql

    def query(self, sql: str | None = None, name: str | None = None):
        """Decorator form of ``add``; the function's name is the query's name."""

        def register(build):
            self.add(name or build.__name__, build, sql)
            return build

        return register
