"""Small helpers for functions that map Arrow batches inside tasks."""

from __future__ import annotations

import contextlib
import ctypes
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starloom.config import fresh_dir

#: rows of one slice stop here, so that one batch of very long texts stays small in memory
SLICE_BYTES = 2 << 20
#: rows of a batch between the JVM and Python while a stage is written
BATCH_ROWS, BATCH_SETTING = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive parts whose ``column`` holds about ``limit`` bytes each."""
    start, held = 0, 0
    for i, value in enumerate(batch.column(column)):
        held += len(value.as_buffer()) if value.is_valid else 0
        if held >= limit:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def to_batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
         for c, f in zip(columns, schema)], schema=schema)


_HELD: dict = {}
_USED = [0]


def held(name: str, make: Callable):
    """What one operator keeps in a Python worker between tasks. A worker serves many operators
    one after another; it holds the table of one at a time."""
    _USED[0] += 1
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def tidy(run: Callable) -> Callable:
    """The same function over batches; at the end of a task the worker gives memory back that
    it no longer uses, as workers live on. A task that used no table drops what is held."""

    def tidied(batches):
        used = _USED[0]
        try:
            yield from run(batches)
        finally:
            if _USED[0] == used:
                _HELD.clear()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only where the C library can
                ctypes.CDLL(None).malloc_trim(0)

    return tidied


def map_texts(df: DataFrame, text: str, ddl: str, make: Callable[[], Callable]) -> DataFrame:
    """Map slices of the rows: ``make()`` runs once per task and returns the function from a
    record batch to the list of result columns of ``ddl``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(_ddl(df.sparkSession, ddl))

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, text):
                yield to_batch(work(part), schema)

    return df.mapInArrow(tidy(run), ddl)


def _ddl(spark: SparkSession, ddl: str) -> StructType:
    return spark.createDataFrame([], ddl).schema


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the shared folder and go on from there: lost executors then cost
    nothing that came before, and the plan starts anew. Texts and sets travel to Python in small
    batches meanwhile, so that long ones do not add up."""
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, label)
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_SETTING, before)
    back = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[back] = path
    return back


def together(df: DataFrame) -> DataFrame:
    """The rows in a few tasks for each core at most: for steps on rows counted as few, whatever the
    number of shuffle partitions."""
    return df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)


#: where the tables that ``stored`` returned lie
_FOLDERS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def discard(table: DataFrame) -> None:
    """Delete the files of a table that ``stored`` returned, once all that was made from it has
    been written. Later steps read what was written after it, so a lost executor needs it no more."""
    path = _FOLDERS.pop(table, None)
    if path is not None:
        folder = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
