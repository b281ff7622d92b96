"""Event-time windows and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def windowed_counts(
    stream: DataFrame, time: str, keys: list[str], width: str, slide: str | None = None,
    late_by: str | None = None,
) -> DataFrame:
    """Counts per tumbling (no ``slide``) or sliding window and key."""
    if late_by:
        stream = stream.withWatermark(time, late_by)
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        stream.groupBy(window.alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")
    )


def session_counts(
    stream: DataFrame, time: str, keys: list[str], gap: str, late_by: str
) -> DataFrame:
    """Sessions per key: runs of events less than ``gap`` apart."""
    return (
        stream.withWatermark(time, late_by)
        .groupBy(F.session_window(time, gap).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")
    )


def active_keys(stream: DataFrame, time: str, key: str, width: str, late_by: str) -> DataFrame:
    """Distinct keys per window: first one row per (window, key), then a count of those."""
    once = (
        stream.withWatermark(time, late_by)
        .groupBy(F.window(time, width).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    return (
        once.groupBy(F.window(F.window_time("w"), width).alias("w2"))
        .agg(F.count(F.lit(1)).alias("active"), F.sum("hits").alias("hits"))
        .select(F.col("w2.start").alias("start"), "active", "hits")
    )
