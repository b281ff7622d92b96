"""Python functions over Arrow batches, for work the built-in functions do not cover.

Each sees one batch at a time and keeps no rows between batches. They travel with the job
by value, so executors need no copy of this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf, udf

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Types as objects: type texts would need a session while this module is imported.
HEAD_TAIL = T.StructType(
    [T.StructField("head", T.StringType()), T.StructField("tail", T.StringType())]
)


STAY_BANDS = [0, 6, 24, 48]


@pandas_udf(T.StringType())
def stay_band(hours: pd.Series) -> pd.Series:
    """Series to series: the band a length of stay falls into."""
    names = np.array(["unknown", *(f"from {h} h" for h in STAY_BANDS)])
    return pd.Series(names[np.digitize(hours.fillna(-1), STAY_BANDS)])


@pandas_udf(HEAD_TAIL)
def split_head(text: pd.Series) -> pd.DataFrame:
    """Series to frame: the text before and after its first separator ``#``."""
    parts = text.str.partition("#")
    return pd.DataFrame({"head": parts[0], "tail": parts[2]})


@pandas_udf(T.LongType())
def check_digit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Iterator to iterator: weighted digit sum modulo 11 of an identifier. The weights are set
    up once per task."""
    weights = np.array([1 + i % 9 for i in range(19)])
    for batch in batches:
        digits = batch.to_numpy()[:, None] // 10 ** np.arange(19)[None, :] % 10
        yield pd.Series((digits * weights).sum(axis=1) % 11)


@pandas_udf(T.LongType())
def patient_share(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Iterator over several columns: cents of a claim that its payer does not cover."""
    for claim, covered in batches:
        yield (claim - covered.fillna(0)).clip(lower=0).astype("int64")


@udf(T.StringType(), useArrow=True)
def initials(name):
    """Row function with Arrow transfer."""
    return None if name is None else "".join(part[0] for part in name.replace("#", " ").split())


def with_faults(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batch map: encounters that end before they start or cost less than is covered, and why."""
    for pdf in batches:
        reversed_ = pdf["stop_us"] < pdf["start_us"]
        over = pdf["covered"].fillna(0) > pdf["claim"]
        fault = np.select([reversed_, over], ["reversed", "over-covered"], default="")
        yield pdf.assign(fault=fault)[fault != ""][["id", "fault"]]


def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch and key: sum and count of integer amounts."""
    for pdf in batches:
        grouped = pdf.groupby("key")["amount"]
        out = grouped.agg(["sum", "count"]).reset_index()
        out.columns = ["key", "total", "n"]
        yield out


def grouped_mean(df: DataFrame, key: str, amount) -> DataFrame:
    """Mean per key as buffer, merge and finish.

    The buffers are built from Arrow batches before the shuffle, so a key with very many
    rows sends a few numbers per batch instead of its rows.
    """
    rows = df.select(F.col(key).cast("string").alias("key"), amount.cast("bigint").alias("amount"))
    buffers = rows.mapInPandas(partial_sums, "key string, total bigint, n bigint")
    return (
        buffers.groupBy("key")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .select("key", "n", (F.col("total").cast("double") / F.col("n")).alias("mean"))
    )
