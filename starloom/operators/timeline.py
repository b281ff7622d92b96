"""Joins along a per-key time line that stay balanced when one key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def merge_ordered(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer merge of two keyed series on key and time, in order of the keys."""
    return left.join(right, keys, "fullouter").orderBy(*keys)


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    time: str,
    value: str,
    slice_seconds: int = 3600,
) -> DataFrame:
    """For each left row the ``value`` of the last right row at or before its time.

    The time line of every key is cut into slices. A slice needs only its own rows and the
    last right row before it, which comes from one summary row per (key, slice). A hot key
    is therefore spread over as many tasks as it has slices. Among right rows with equal
    time the greatest value wins.
    """
    slice_of = F.floor(F.unix_micros(F.col(time)) / F.lit(slice_seconds * 1_000_000))
    marked_left = left.withColumns(
        {"_slice": slice_of, "_side": F.lit(1), "_value": F.lit(None).cast(
            right.schema[value].dataType)}
    )
    points = (
        right.groupBy(key, time).agg(F.max(value).alias("_value")).withColumn("_slice", slice_of)
    )
    # last right row of each slice, then the last one of any earlier slice
    last = points.groupBy(key, "_slice").agg(F.max_by("_value", time).alias("_last"))
    touched = marked_left.select(key, "_slice").distinct()
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        touched.join(last, [key, "_slice"], "fullouter")
        .withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier))
        .select(key, "_slice", "_carry")
    )
    rest = [c for c in left.columns if c not in (key, time)]
    merged = marked_left.unionByName(
        points.withColumn("_side", F.lit(0)), allowMissingColumns=True
    )
    upto = (
        Window.partitionBy(key, "_slice").orderBy(time, "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = merged.withColumn("_seen", F.last("_value", ignorenulls=True).over(upto)).where(
        F.col("_side") == 1
    )
    return inside.join(carried, [key, "_slice"], "left").select(
        key, time, *rest, F.coalesce("_seen", "_carry").alias(value)
    )
