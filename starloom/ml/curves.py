"""Threshold tables and distances of distributions, from prefix sums over ranges of scores.

Equal scores are counted first, so a score of a third of the rows is one row afterwards. The
counted scores are dealt over ranges; the totals of the ranges give where each range starts, and
a running sum inside a range does the rest. No task sees all scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.operators.facts import stored

RANGES = 64


def running_sums(rows: DataFrame, by: Column, sums: list[str], ranges: int = RANGES) -> DataFrame:
    """``rows`` with ``cum_<name>`` for each column of ``sums``: its sum over all rows up to and
    with this one in the order ``by``, whose values must differ from row to row."""
    names = [c for c in rows.columns]
    dealt = stored(rows.repartitionByRange(ranges, by).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("_range").agg(*[F.sum(c).alias(f"_total_{c}") for c in sums])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # over the ranges, not the rows
    starts = totals.select("_range", *[F.coalesce(F.sum(f"_total_{c}").over(before), F.lit(0)).alias(f"_start_{c}") for c in sums])
    inside = Window.partitionBy("_range").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    running = dealt.withColumns({f"_own_{c}": F.sum(c).over(inside) for c in sums})
    joined = running.join(F.broadcast(starts), "_range")  # a row per range
    return joined.select(*names, *[(F.col(f"_own_{c}") + F.col(f"_start_{c}")).alias(f"cum_{c}") for c in sums])


def threshold_table(scored: DataFrame, score: str, label: str, ranges: int = RANGES) -> DataFrame:
    """Per distinct score, as the least score still taken: (threshold, own_tp and own_fp with
    just this score, taken, tp, fp, positives, negatives, precision, recall, fall_out, f1). Labels are 0 or 1; rows without a score or a
    label take no part. Rates over nothing are null."""
    known = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        F.col(score).alias("threshold"), F.col(label).cast("bigint").alias("hit"))
    counted = known.groupBy("threshold").agg(
        F.sum("hit").alias("tp"), F.sum(1 - F.col("hit")).alias("fp"))
    counted = stored(counted, "scores")
    whole = counted.agg(F.sum("tp").alias("positives"), F.sum("fp").alias("negatives"))
    sums = running_sums(counted, F.desc("threshold"), ["tp", "fp"], ranges)
    tp, fp = F.col("cum_tp"), F.col("cum_fp")
    return sums.crossJoin(F.broadcast(whole)).select(  # one row of totals
        "threshold", F.col("tp").alias("own_tp"), F.col("fp").alias("own_fp"), (tp + fp).alias("taken"), tp.alias("tp"), fp.alias("fp"), "positives", "negatives",
        (tp / (tp + fp)).alias("precision"), F.try_divide(tp, "positives").alias("recall"),
        F.try_divide(fp, "negatives").alias("fall_out"), F.try_divide(2 * tp, tp + fp + F.col("positives")).alias("f1"))


def area_under_roc(table: DataFrame) -> DataFrame:
    """The area below recall over fall-out, by trapezoids: (area). A row of the table adds its own
    negatives times the positives taken before it and half of its own."""
    own_tp, own_fp = F.col("own_tp"), F.col("own_fp")
    part = own_fp * (F.col("tp") - own_tp + own_tp / 2)
    return table.agg(F.sum(part / (F.col("positives") * F.col("negatives").cast("double"))).alias("area"))


def best_f1(table: DataFrame) -> DataFrame:
    """The threshold of the greatest F1, the largest such one: (threshold, f1)."""
    return table.agg(F.max_by(F.struct("threshold", "f1"), F.struct("f1", "threshold")).alias("best")).select("best.*")


def distance_from(values: DataFrame, value: str, distribution: Column, ranges: int = RANGES) -> DataFrame:
    """Kolmogorov-Smirnov distance: the largest difference between the share of values up to a
    point and ``distribution`` there, an expression over the column ``value``."""
    counted = stored(values.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n")), "values")
    whole = counted.agg(F.sum("n").alias("_whole"))
    sums = running_sums(counted, F.asc(value), ["n"], ranges).crossJoin(F.broadcast(whole))
    up_to, below = F.col("cum_n") / F.col("_whole"), (F.col("cum_n") - F.col("n")) / F.col("_whole")
    return sums.agg(F.max(F.greatest(up_to - distribution, distribution - below)).alias("distance"))


def distance_between(values: DataFrame, value: str, first: Column, ranges: int = RANGES) -> DataFrame:
    """The same between two samples: the rows where ``first`` holds, and the others."""
    known = values.where(F.col(value).isNotNull()).select(value, F.coalesce(first, F.lit(False)).cast("bigint").alias("a"))
    counted = stored(known.groupBy(value).agg(F.sum("a").alias("a"), F.sum(1 - F.col("a")).alias("b")), "values")
    whole = counted.agg(F.sum("a").alias("_a"), F.sum("b").alias("_b"))
    sums = running_sums(counted, F.asc(value), ["a", "b"], ranges).crossJoin(F.broadcast(whole))
    return sums.agg(F.max(F.abs(F.col("cum_a") / F.col("_a") - F.col("cum_b") / F.col("_b"))).alias("distance"))
