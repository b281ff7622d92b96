"""Null-defaulting projections driven by attribute descriptions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Attribute:
    """One target column: where it comes from, its type, and the value replacing NULL."""

    source: str
    name: str
    dtype: str
    default: object

    def default_sql(self) -> str:
        text = str(self.default).replace("\\", "\\\\").replace("'", "\\'")
        return f"CAST('{text}' AS {self.dtype})"

    def default_column(self) -> Column:
        return F.expr(self.default_sql())

    def project(self) -> Column:
        return F.expr(
            f"coalesce(CAST(`{self.source}` AS {self.dtype}), {self.default_sql()}) AS `{self.name}`"
        )


def null_defaulted(attributes: Sequence[Attribute]) -> list[Column]:
    """Projection list; the cast comes first so that a number may default to a text."""
    return [a.project() for a in attributes]


def any_present(columns: Sequence[str]) -> Column:
    """True where at least one of the columns is not NULL."""
    return reduce(or_, [F.col(c).isNotNull() for c in columns])


def default_member(spark: SparkSession, key_name: str, key: str, attributes) -> DataFrame:
    """One-row relation holding the unknown member."""
    return spark.range(1).select(
        F.lit(key).alias(key_name), *[F.expr(f"{a.default_sql()} AS `{a.name}`") for a in attributes]
    )
