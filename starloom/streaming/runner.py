"""Run a streaming query over everything that has arrived and read its result.

Results go to files below the shared folder, never to driver memory. Checkpoint and output
live side by side, so a query that is started again in the same ``folder`` goes on where it
stopped; without one, each call is a new query.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from starloom.config import fresh_dir
from starloom.sources.sinks import _files, remove_folder

# Sessions of one key are merged inside each input partition before the shuffle.
LOCAL_SESSION_MERGE = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}

# A processing-time timeout always asks for one more empty batch, so a run over what is
# available would never end; timeouts then fire with the next data instead.
NO_EMPTY_BATCHES = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}

# State with an initial relation, timers or several variables lives in this store.
KEYED_STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
                     "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

# Results of so many micro-batches are put together into one.
MERGED_BATCHES = 16


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings a streaming query picks up when it starts, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_append(stream: DataFrame, folder: str | None = None, conf: dict | None = None) -> DataFrame:
    """Append mode into Parquet files; only rows the watermark has finalised."""
    spark = stream.sparkSession
    folder = folder or fresh_dir(spark, "stream")
    with settings(spark, conf or {}):
        (
            stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
        )
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def run_batches(
    stream: DataFrame,
    mode: str,
    folder: str | None = None,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    conf: dict | None = None,
    keep: int | None = None,
) -> tuple[str, DataFrame]:
    """Write each micro-batch to its own folder, replaced if the batch is repeated.

    ``keep`` is the number of newest results that stay; all, if not given.
    """
    spark = stream.sparkSession
    folder = folder or fresh_dir(spark, "stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        shaped = shape(batch) if shape else batch
        shaped.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
        if keep:
            remove_folder(spark, f"{folder}/out/batch={batch_id - keep}")

    with settings(spark, conf or {}):
        (
            stream.writeStream.outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True).start().awaitTermination()
        )
    return folder, spark.read.parquet(f"{folder}/out")


def run_complete(stream: DataFrame, shape=None, folder: str | None = None) -> DataFrame:
    """Complete mode: the last batch holds the whole result and replaces the one before it."""
    _, batches = run_batches(stream, "complete", folder, shape, keep=1)
    last = batches.agg(F.max("batch").alias("batch"))
    return batches.where(F.col("batch") == last.scalar()).drop("batch")


def stored_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the micro-batches that have left a result."""
    folder, files = _files(spark, path)
    if not files.exists(folder):
        return []
    names = (s.getPath().getName() for s in files.listStatus(folder))
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("batch="))


def run_merged(
    stream: DataFrame,
    mode: str,
    merge: Callable[[DataFrame], DataFrame],
    folder: str | None = None,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    conf: dict | None = None,
    every: int = MERGED_BATCHES,
) -> DataFrame:
    """``merge`` of the results of all micro-batches, of which at most ``every`` and one are kept.

    ``merge`` takes rows with a column ``batch`` and returns them with one, put together. Every
    so many batches the result so far is written as that of the batch. What it replaces goes
    when the next batch begins, since then this one will not be repeated.
    """
    spark = stream.sparkSession
    folder = folder or fresh_dir(spark, "stream")
    out = f"{folder}/out"

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch) if shape else batch
        known = [n for n in stored_batches(spark, out) if n < batch_id]
        if last := max((n for n in known if n % every == every - 1), default=None):
            for n in known:
                if n < last:
                    remove_folder(spark, f"{out}/batch={n}")
        if batch_id % every == every - 1 and known:
            before = spark.read.parquet(out).where(F.col("batch") < batch_id)
            merged = merge(before.unionByName(rows.withColumn("batch", F.lit(batch_id))))
            rows = merged.drop("batch")
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with settings(spark, conf or {}):
        (
            stream.writeStream.outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True).start().awaitTermination()
        )
    return merge(spark.read.parquet(out)).drop("batch")


def run_update(
    stream: DataFrame, keys: list[str], folder: str | None = None, conf: dict | None = None,
    every: int = MERGED_BATCHES,
) -> DataFrame:
    """Update mode: the newest row of each key over all batches."""

    def newest(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in keys and c != "batch"]
        best = rows.groupBy(*keys).agg(
            F.max_by(F.struct(*rest), "batch").alias("_row"), F.max("batch").alias("batch"))
        return best.select(*keys, "_row.*", "batch")

    return run_merged(stream, "update", newest, folder, conf=conf, every=every)


def run_counted(
    stream: DataFrame,
    counters: list[Column],
    shape: Callable[[DataFrame], DataFrame],
    folder: str,
    conf: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(results, counters) by micro-batch: ``shape`` of each batch, and the named counters over
    the rows that entered it, observed while the result is written, so in one pass.

    A batch that failed is repeated by the next call on the same ``folder`` and replaces what it
    left, so after any failure both are those of an unbroken run. The batches belong to the
    stream's own session, so observing them leaves the caller's as it is.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        shape(batch.observe(seen, *counters)).write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")
        counted = spark.createDataFrame([{k: int(v or 0) for k, v in seen.get.items()}])
        counted.coalesce(1).write.mode("overwrite").parquet(f"{folder}/counters/batch={batch_id}")

    with settings(spark, conf or {}):
        (
            stream.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True).start().awaitTermination()
        )
    return spark.read.parquet(f"{folder}/out"), spark.read.parquet(f"{folder}/counters")
