"""Sessions that a closing event or a quiet time ends, from mergeable summaries.

The events of a key are cut into slices of time. Each slice is summarised by itself, as runs
(first, last, events, closed); runs of neighbouring slices are then put together in order, so no
task sees all events of a key. Behind the watermark nothing can change any more: of an open
session only one summary is kept for what lies there, and single events just for the time that
late ones may still fall into. Both are files, written per micro-batch and replaced if a batch
is repeated, next to the checkpoint of the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starloom.config import fresh_dir
from starloom.sources.sinks import remove_folder
from starloom.streaming.runner import stored_batches

SLICE_SECONDS = 600
_EVENTS = "key string, us bigint, closing boolean"
_RUNS = "key string, first bigint, last bigint, n bigint, closed boolean, settled boolean"


def runs(events: DataFrame, gap_us: int, slice_us: int, cut_us: int | None) -> DataFrame:
    """Runs of the events (key, us, closing) inside each slice; no run crosses ``cut_us``.

    A run ends with a closing event or when the next event is ``gap_us`` or more away. Of events
    at one instant the closing ones come last.
    """
    settled = F.lit(False) if cut_us is None else F.col("us") < cut_us
    cut = events.withColumn("settled", settled).withColumn("slice", F.floor(F.col("us") / slice_us))
    order = Window.partitionBy("key", "settled", "slice").orderBy("us", "closing")
    fresh = F.lag("closing").over(order) | (F.col("us") - F.lag("us").over(order) >= gap_us)
    marked = cut.withColumn("fresh", F.coalesce(fresh, F.lit(False)).cast("int"))
    numbered = marked.withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("key", "settled", "slice", "run").agg(
        F.min("us").alias("first"), F.max("us").alias("last"), F.count(F.lit(1)).alias("n"), F.max("closing").alias("closed"),
    ).select("key", "first", "last", "n", "closed", "settled")


def merged(summaries: DataFrame, gap_us: int) -> DataFrame:
    """Sessions from the runs of a key in order: (key, start, last, events, closed, and of the
    settled part s_first, s_last, s_n)."""
    order = Window.partitionBy("key").orderBy("first", "last")
    fresh = F.lag("closed").over(order) | (F.col("first") - F.lag("last").over(order) >= gap_us)
    marked = summaries.withColumn("fresh", F.coalesce(fresh, F.lit(False)).cast("int"))
    numbered = marked.withColumn("session", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    behind = lambda c: F.when(F.col("settled"), F.col(c))
    return numbered.groupBy("key", "session").agg(
        F.min("first").alias("start"), F.max("last").alias("last"), F.sum("n").alias("events"), F.max("closed").alias("closed"),
        F.min(behind("first")).alias("s_first"), F.max(behind("last")).alias("s_last"), F.sum(behind("n")).alias("s_n"),
    ).drop("session")


class _Store:
    """What a micro-batch leaves, by its number."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def put(self, rows: DataFrame, what: str, batch: int) -> DataFrame:
        path = f"{self.folder}/{what}/batch={batch}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def get(self, what: str, batch: int, schema: str) -> DataFrame:
        if batch not in stored_batches(self.spark, f"{self.folder}/{what}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{what}/batch={batch}")

    def drop_before(self, what: str, batch: int) -> None:
        for n in stored_batches(self.spark, f"{self.folder}/{what}"):
            if n < batch:
                remove_folder(self.spark, f"{self.folder}/{what}/batch={n}")


def closing_sessions(
    stream: DataFrame, key: str, time: str, closing: Column, gap_seconds: int, late_seconds: int,
    folder: str | None = None, slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Final sessions (key, start_us, duration_us, events) of all that has arrived.

    Events up to ``late_seconds`` behind the newest one of the earlier micro-batches may join,
    extend or split sessions that are still open; later ones are dropped. A session is final, and
    written once, when its end lies behind the watermark. A call on the same ``folder`` goes on
    where the last one stopped.
    """
    spark = stream.sparkSession
    folder = folder or fresh_dir(spark, "sessions")
    store, gap_us = _Store(spark, folder), gap_seconds * 1_000_000
    rows = stream.select(
        F.col(key).cast("string").alias("key"), F.unix_micros(time).alias("us"), F.coalesce(closing, F.lit(False)).alias("closing"))

    def step(batch: DataFrame, n: int) -> None:
        mark = store.get("mark", n - 1, "us bigint").agg(F.max("us")).first()[0]
        timely = batch.where("us is not null")
        if mark is not None:
            timely = timely.where(F.col("us") > mark)
        arrived = store.put(timely, "arrived", n)
        newest = arrived.agg(F.max("us")).first()[0]
        seen = [] if newest is None else [(newest // 1000 - late_seconds * 1000) * 1000]
        now = max([*seen, *([] if mark is None else [mark])], default=None)
        store.put(spark.createDataFrame([(now,)], "us bigint").coalesce(1), "mark", n)
        events = arrived.unionByName(store.get("late", n - 1, _EVENTS))
        open_ = store.get("open", n - 1, _RUNS)
        sessions = store.put(merged(runs(events, gap_us, slice_seconds * 1_000_000, now).unionByName(open_), gap_us), "sessions", n)
        end = F.col("last") + F.when(F.col("closed"), 0).otherwise(gap_us)
        final = F.lit(False) if now is None else end < now
        done = sessions.where(final).select("key", F.col("start").alias("start_us"), (end - F.col("start")).alias("duration_us"), "events")
        store.put(done, "out", n)
        held = sessions.where(~final).where("s_n is not null")
        store.put(held.select("key", F.col("s_first").alias("first"), F.col("s_last").alias("last"), F.col("s_n").alias("n"),
                              F.lit(False).alias("closed"), F.lit(True).alias("settled")), "open", n)
        store.put(events if now is None else events.where(F.col("us") >= now), "late", n)
        for what in ("mark", "late", "open", "arrived", "sessions"):
            store.drop_before(what, n - 1)  # a repeated batch needs those of the one before

    (
        rows.writeStream.outputMode("append").foreachBatch(step)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start().awaitTermination()
    )
    schema = "key string, start_us bigint, duration_us bigint, events bigint"
    if not stored_batches(spark, f"{folder}/out"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/out").drop("batch")
