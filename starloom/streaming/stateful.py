"""Custom state per key with pandas batches."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUMMARY = "key string, events bigint, first_us bigint, last_us bigint"


def batch_summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One (key, events, first, last) row per key and Arrow batch, before the shuffle."""
    for pdf in batches:
        grouped = pdf.groupby("key")["us"].agg(["count", "min", "max"]).reset_index()
        grouped.columns = ["key", "events", "first_us", "last_us"]
        yield grouped


ACTIVITY = "key string, session bigint, events bigint, first_us bigint, last_us bigint, closed boolean"


def activity(stream: DataFrame, key: str, time: str, idle_ms: int = 3_600_000) -> DataFrame:
    """Running number of events, first and last instant per key and session, in update mode.

    A session ends after ``idle_ms`` of clock time without input. It is emitted once more then,
    as closed, and its state (four numbers) is dropped; later events open the next session.
    ``session`` is the clock time at which it was opened, so no session hides another.
    """

    def update(
        group, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        def row(session, events, first, last, closed):
            return pd.DataFrame({
                "key": [group[0]], "session": [session], "events": [events], "first_us": [first],
                "last_us": [last], "closed": [closed]})

        if state.hasTimedOut:
            last_row = row(*state.get, True)
            state.remove()
            yield last_row
            return
        session, events, first, last = (
            state.get if state.exists else (state.getCurrentProcessingTimeMs(), 0, None, None))
        for pdf in batches:
            events += int(pdf["events"].sum())
            low, high = int(pdf["first_us"].min()), int(pdf["last_us"].max())
            first = low if first is None else min(first, low)
            last = high if last is None else max(last, high)
        state.update((session, events, first, last))
        state.setTimeoutDuration(idle_ms)
        yield row(session, events, first, last, False)

    rows = stream.select(
        F.col(key).cast("string").alias("key"), F.unix_micros(time).alias("us")
    )
    return (
        rows.mapInPandas(batch_summaries, SUMMARY)
        .groupBy("key")
        .applyInPandasWithState(
            update, ACTIVITY, "session bigint, events bigint, first_us bigint, last_us bigint",
            "update", GroupStateTimeout.ProcessingTimeTimeout,
        )
    )


def activity_totals(sessions: DataFrame) -> DataFrame:
    """All events of a key over its sessions."""
    return sessions.groupBy("key").agg(
        F.sum("events").alias("events"), F.min("first_us").alias("first_us"),
        F.max("last_us").alias("last_us"))


COUNTS = "key string, n bigint"


def batch_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One (key, n) row per key and Arrow batch, before the shuffle."""
    for pdf in batches:
        yield pdf.groupby("key", dropna=False).size().reset_index(name="n")


class RunningCount(StatefulProcessor):
    """Count per key that begins with a stored one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.count.update((int(initialState["n"].sum()),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0] if self.count.exists() else 0
        n += sum(int(pdf["n"].sum()) for pdf in rows)
        self.count.update((n,))
        yield pd.DataFrame({"key": [key[0]], "n": [n]})

    def close(self) -> None:
        pass


def running_counts(stream: DataFrame, key: str, stored: DataFrame) -> DataFrame:
    """Rows per key so far, in update mode, starting from ``stored`` (key, n).

    The state operator takes the stored counts once, before the first micro-batch; afterwards
    the state is all there is, also after a restart. Keys without input are not emitted. Rows
    are counted per key before the shuffle, so a hot key is a few rows there. Needs the state
    store of ``runner.KEYED_STATE_STORE``.
    """
    counts = stream.select(F.col(key).cast("string").alias("key")).mapInPandas(batch_counts, COUNTS)
    initial = stored.select(F.col("key").cast("string").alias("key"), F.col("n").cast("bigint").alias("n"))
    return counts.groupBy("key").transformWithStateInPandas(
        RunningCount(), COUNTS, "Update", "None", initialState=initial.groupBy("key"))
