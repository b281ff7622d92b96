"""Files that arrive one after the other, late events, restarts."""

import datetime
import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from starloom.streaming import runner, sessions, stateful, windows
from starloom.streaming.sources import stream_table, words
from tests.conftest import rows

SCHEMA = "user string, ts timestamp, kind string"


def at(minute):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)


class Feed:
    """A table folder that gets one more file per call."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base

    def add(self, *events):
        data = [(u, at(m), k) for u, m, k in events]
        self.spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(
            str(self.base / "feed.parquet"))

    def stream(self):
        return stream_table(self.spark, str(self.base), "feed")


def test_late_event_joins_an_open_session_and_is_dropped_behind_the_watermark(spark, tmp_path):
    feed, folder = Feed(spark, tmp_path), str(tmp_path / "q")

    def run():
        closing = sessions.closing_sessions(
            feed.stream(), "user", "ts", F.col("kind") == "close", 30 * 60, 600, folder)
        return rows(closing.select(
            "key", "start_us", "duration_us", "events").selectExpr(
            "key", "start_us div 60000000 - 28401120 AS start", "duration_us div 60000000 AS len",
            "events"))

    feed.add(("a", 0, "x"), ("a", 50, "x"), ("b", 10, "x"), ("b", 12, "close"))
    # watermark 40: both sessions of b are over, the one of a that began at 0 ended at 30
    assert run() == [("a", 0, 30, 1), ("b", 10, 2, 2)]
    feed.add(("a", 45, "x"), ("b", 20, "x"), ("a", 200, "x"))
    # 45 is late but open, so it moves the start of the session; 20 is behind the watermark
    assert run() == [("a", 0, 30, 1), ("a", 45, 35, 2), ("b", 10, 2, 2)]


def plain_sessions(events, gap):
    """(user, first, last, events, closed) in minutes."""
    out = []
    for user in sorted({u for u, _, _ in events}):
        run = []
        for _, m, kind in sorted((e for e in events if e[0] == user), key=lambda e: (e[1], e[2] == "close")):
            if run and (run[-1][1] == "close" or m - run[-1][0] >= gap):
                out.append((user, run))
                run = []
            run.append((m, kind))
        out.append((user, run))
    return [(u, r[0][0], r[-1][0], len(r), r[-1][1] == "close") for u, r in out]


def minutes(found):
    return rows(found.selectExpr(
        "key", "start_us div 60000000 - 28401120 AS start", "duration_us div 60000000 AS len", "events"))


def test_closing_sessions_equal_a_plain_loop_over_many_batches(spark, tmp_path):
    rng = random.Random(1)
    feed, folder = Feed(spark, tmp_path), str(tmp_path / "q")
    events, late = [], 30
    for batch in range(6):
        lo = batch * 200
        new = [(rng.choice("hhhhab"), lo + rng.randrange(230), rng.choice(["x"] * 9 + ["close"])) for _ in range(120)]
        newest = max((m for _, m, _ in events), default=None)
        events += [e for e in new if newest is None or e[1] > newest - late]
        feed.add(*new)
        found = sessions.closing_sessions(
            feed.stream(), "user", "ts", F.col("kind") == "close", 25 * 60, late * 60, folder, slice_seconds=120)
    mark = max(m for _, m, _ in events) - late
    expected = [(u, a, (z if c else z + 25) - a, n) for u, a, z, n, c in plain_sessions(events, 25)
                if (z if c else z + 25) < mark]
    assert len(expected) > 60 and sorted(minutes(found)) == sorted(expected)


def test_a_user_with_half_of_the_events_is_summarised_in_slices(spark):
    """Two closings at one instant; what meets per key are runs, not events."""
    events = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"),
        (F.col("id") * 1_000_000).alias("us"), F.lit(False).alias("closing"))
    twice = spark.createDataFrame([("t", 5, True), ("t", 5, True), ("t", 5, False)], "key string, us bigint, closing boolean")
    found = sessions.runs(events.unionByName(twice), 3_600_000_000, 600_000_000, 7_000_000_000)
    hot = found.where("key = 'hot'").agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("runs"), F.sum("n").alias("n")).first()
    assert hot.most <= 300 and hot.runs == 68 and hot.n == 20_000
    whole = sessions.merged(found, 3_600_000_000)
    assert whole.where("key = 'hot'").first().events == 20_000
    assert sorted(r.events for r in whole.where("key = 't'").collect()) == [1, 2]


def test_a_restarted_session_job_goes_on(spark, tmp_path, monkeypatch):
    """It dies after the results of a batch were written; the batch is repeated."""
    feed, folder = Feed(spark, tmp_path), str(tmp_path / "q")
    run = lambda: minutes(sessions.closing_sessions(
        feed.stream(), "user", "ts", F.col("kind") == "close", 30 * 60, 600, folder))
    feed.add(("a", 0, "x"), ("a", 20, "x"))
    run()
    feed.add(("a", 25, "close"), ("a", 100, "x"), ("b", 90, "x"))

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(sessions._Store, "drop_before", killed)
        with pytest.raises(Exception, match="killed"):
            run()
    assert run() == [("a", 0, 25, 3)]
    feed.add(("a", 300, "x"))
    assert run() == [("a", 0, 25, 3), ("a", 100, 30, 1), ("b", 90, 30, 1)]


def test_counts_start_from_a_stored_relation(spark, tmp_path):
    feed, folder = Feed(spark, tmp_path), str(tmp_path / "q")
    stored = spark.createDataFrame([("a", 100), ("a", 10), ("z", 5)], "key string, n bigint")

    def run():
        out = runner.run_update(stateful.running_counts(feed.stream(), "user", stored), ["key"], folder, runner.KEYED_STATE_STORE)
        return rows(out)

    feed.add(*[("a", i, "x") for i in range(500)], ("b", 1, "x"))
    assert run() == [("a", 610), ("b", 1)]  # the first row of a key is stored + batch
    feed.add(("a", 3, "x"), ("z", 4, "x"))
    assert run() == [("a", 611), ("b", 1), ("z", 6)]
    feed.add(("b", 3, "x"), ("b", 4, "x"))
    assert run() == [("a", 611), ("b", 3), ("z", 6)]


def test_a_run_that_failed_in_its_second_batch_equals_an_unbroken_one(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for n in range(3):
        feed.add(*[("a", i, "drop" if i % 3 == n else "keep") for i in range(30)])
    stream = lambda: stream_table(spark, str(tmp_path), "feed", 1)
    counters = [F.sum((F.col("kind") == "drop").cast("int")).alias("dropped"), F.count(F.lit(1)).alias("rows")]
    done = []

    def shape(batch, failing=False):
        done.append(1)
        kept = batch.where("kind = 'keep'").groupBy("user").agg(F.count(F.lit(1)).alias("n"))
        broken = failing and len(done) == 2
        return kept.withColumn("n", F.raise_error(F.lit("broken")).cast("bigint")) if broken else kept

    whole = [rows(df) for df in runner.run_counted(stream(), counters, shape, str(tmp_path / "whole"))]
    done.clear()
    folder = str(tmp_path / "broken")
    with pytest.raises(Exception, match="broken"):
        runner.run_counted(stream(), counters, lambda b: shape(b, True), folder)
    assert rows(spark.read.parquet(f"{folder}/counters"))[0][-1] == 0
    again = [rows(df) for df in runner.run_counted(stream(), counters, shape, folder)]
    assert again == whole and len(done) == 4
    assert sum(r["dropped"] for r in spark.read.parquet(f"{folder}/counters").collect()) == 30
    # a session that has observed could no longer ship a binary classifier
    points = spark.createDataFrame([(Vectors.dense([float(i)]), float(i % 2)) for i in range(20)], ["features", "label"])
    assert LogisticRegression().fit(points).transform(points).count() == 20


def test_results_of_many_batches_are_put_together(spark, tmp_path):
    feed, folder = Feed(spark, tmp_path), str(tmp_path / "q")
    for n in range(7):
        feed.add(("a", n, "x"), (f"u{n}", n, "x"))
    counts = stream_table(spark, str(tmp_path), "feed", 1).groupBy("user").agg(F.count(F.lit(1)).alias("n"))
    found = runner.run_update(counts, ["user"], folder, every=3)
    assert rows(found) == [("a", 7), *[(f"u{n}", 1) for n in range(7)]]
    assert runner.stored_batches(spark, f"{folder}/out") == [5, 6]


def test_running_state_goes_on_after_a_restart(spark, tmp_path):
    feed, folder = Feed(spark, tmp_path), str(tmp_path / "q")

    def run():
        out = runner.run_update(stateful.activity(feed.stream(), "user", "ts"), ["key", "session"],
                                folder, runner.NO_EMPTY_BATCHES)
        return rows(stateful.activity_totals(out).select("key", "events"))

    feed.add(("a", 0, "x"), ("a", 5, "x"), ("b", 1, "x"))
    assert run() == [("a", 2), ("b", 1)]
    feed.add(("a", 3, "x"))
    assert run() == [("a", 3), ("b", 1)]
    assert run() == [("a", 3), ("b", 1)]


def test_append_window_waits_for_the_watermark(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(("a", 1, "x"), ("a", 61, "x"), ("b", 75, "x"))
    counts = windows.windowed_counts(feed.stream(), "ts", [], "1 hour", late_by="10 minutes")
    assert [r["n"] for r in runner.run_append(counts).collect()] == [1]


def test_complete_counts_over_two_files(spark, tmp_path):
    feed, folder = Feed(spark, tmp_path), str(tmp_path / "q")
    for expected in ([("x", 1), ("y", 1)], [("x", 2), ("y", 2)]):
        feed.add(("a", 1, "x y"))
        counts = words(feed.stream(), "kind").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        assert rows(runner.run_complete(counts, folder=folder)) == expected


def test_a_timeout_closes_the_session_and_loses_no_event(spark, tmp_path):
    import time

    feed, folder = Feed(spark, tmp_path), str(tmp_path / "q")

    def run():
        out = runner.run_update(
            stateful.activity(feed.stream(), "user", "ts", idle_ms=1), ["key", "session"], folder,
            runner.NO_EMPTY_BATCHES)
        return rows(out.select("key", "events", "closed")), rows(
            stateful.activity_totals(out).select("key", "events"))

    feed.add(("a", 0, "x"), ("a", 5, "x"), ("b", 1, "x"))
    assert run() == ([("a", 2, False), ("b", 1, False)], [("a", 2), ("b", 1)])
    time.sleep(1.5)
    feed.add(("b", 30, "x"))
    # the state of a has timed out; b either too, before its new event, or not yet
    sessions, totals = run()
    assert ("a", 2, True) in sessions and totals == [("a", 2), ("b", 2)]
    time.sleep(1.5)
    feed.add(("a", 60, "x"))
    assert run()[1] == [("a", 3), ("b", 2)]
