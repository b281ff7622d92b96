"""Structured streaming over the test tables, replayed as arriving files."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.config import fresh_dir
from starloom.operators.joins import fits_broadcast
from starloom.registry.base import Inputs, Registry
from starloom.streaming import runner, sessions, stateful, windows
from starloom.streaming.sources import stream_table, words

REGISTRY = Registry()
query = REGISTRY.query

LATE = "10 minutes"
FINAL = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


def _stream(x: Inputs, table: str):
    return stream_table(x.spark, x.folder, table)


def _arriving(x: Inputs, table: str, files: int = 6, per_trigger: int = 2):
    """The table as several files that arrive over three or more micro-batches."""
    folder = fresh_dir(x.spark, f"arriving_{table}")
    x.tables[table].repartition(files).write.parquet(f"{folder}/{table}.parquet")
    return stream_table(x.spark, folder, table, per_trigger)


@query("SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '[ \\n]')) "
       "AS word FROM conversations) w GROUP BY 1")
def b_stream_word_count(x: Inputs):
    """Running word count, complete mode."""
    counts = words(_stream(x, "conversations"), "text").groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))
    return runner.run_complete(counts)


@query("SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1")
def b_stream_topic_count(x: Inputs):
    """Count of message values; the messages are the events keyed by user."""
    messages = _stream(x, "events").select(
        F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("value"))
    return runner.run_update(
        messages.groupBy("value").agg(F.count(F.lit(1)).alias("n")), ["value"])


def _bucket(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


@query(f"""SELECT {_bucket("time_bucket(INTERVAL 1 HOUR, ts)")} AS start,
    {_bucket("time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR")} AS "end", event_type,
    count(*) AS n FROM events GROUP BY 1, 2, 3""")
def b_stream_tumbling(x: Inputs):
    return runner.run_update(
        windows.windowed_counts(_stream(x, "events"), "ts", ["event_type"], "1 hour", late_by=LATE),
        ["start", "end", "event_type"])


@query(f"""SELECT {_bucket("s")} AS start, {_bucket("s + INTERVAL 1 HOUR")} AS "end", event_type,
    count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 20 MINUTE, ts),
        time_bucket(INTERVAL 20 MINUTE, ts) - INTERVAL 20 MINUTE,
        time_bucket(INTERVAL 20 MINUTE, ts) - INTERVAL 40 MINUTE]) AS s FROM events) w
    GROUP BY 1, 2, 3""")
def b_stream_sliding(x: Inputs):
    return runner.run_update(windows.windowed_counts(
        _stream(x, "events"), "ts", ["event_type"], "1 hour", "20 minutes", LATE),
        ["start", "end", "event_type"])


@query(f"""SELECT {_bucket("time_bucket(INTERVAL 1 HOUR, ts)")} AS start,
    {_bucket("time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR")} AS "end", event_type,
    count(*) AS n FROM events WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= {FINAL}
    GROUP BY 1, 2, 3""")
def b_stream_tumbling_final(x: Inputs):
    """Append mode: only windows behind the watermark."""
    return runner.run_append(windows.windowed_counts(
        _stream(x, "events"), "ts", ["event_type"], "1 hour", late_by=LATE))


SESSIONS = """
    SELECT user_id, min(ts) AS a, max(ts) AS z, count(*) AS n FROM (
        SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (
            SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events) f) g
    GROUP BY user_id, s
"""


@query(f"""SELECT user_id, epoch_us(a) AS start_us, epoch_us(z + INTERVAL 2 HOUR) AS end_us, n
    FROM ({SESSIONS}) s WHERE z + INTERVAL 2 HOUR <= {FINAL}""")
def b_stream_session_window(x: Inputs):
    found = windows.session_counts(
        _stream(x, "events"), "ts", ["user_id"], "2 hours", LATE)
    out = runner.run_append(found, conf=runner.LOCAL_SESSION_MERGE)
    return out.select("user_id", F.unix_micros("start").alias("start_us"),
                      F.unix_micros("end").alias("end_us"), "n")


@query("SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS events, epoch_us(min(ts)) AS first_us, "
       "epoch_us(max(ts)) AS last_us FROM events GROUP BY 1")
def b_stream_state(x: Inputs):
    """Custom state with a processing-time timeout."""
    running = stateful.activity(_arriving(x, "events"), "user_id", "ts")
    found = runner.run_update(running, ["key", "session"], conf=runner.NO_EMPTY_BATCHES)
    return stateful.activity_totals(found)


@query(f"""
    SELECT CAST(user_id AS VARCHAR) AS key, epoch_us(a) AS start_us,
        epoch_us(e) - epoch_us(a) AS duration_us, n AS events
    FROM (SELECT user_id, min(ts) AS a, count(*) AS n,
            CASE WHEN max_by(event_type, ts) = 'purchase' THEN max(ts)
                 ELSE max(ts) + INTERVAL 6 HOUR END AS e
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (
            SELECT user_id, ts, event_type,
                CASE WHEN lag(event_type) OVER w = 'purchase' THEN 1
                     WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
            FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)) f) g
        GROUP BY user_id, s) h
    WHERE e < date_trunc('millisecond', {FINAL})""")
def b_stream_closing_sessions(x: Inputs):
    """Sessions that end with a purchase or after six quiet hours."""
    return sessions.closing_sessions(
        _stream(x, "events"), "user_id", "ts", F.col("event_type") == "purchase", 6 * 3600, 600)


@query("""SELECT CAST(c_nationkey AS VARCHAR) AS nation, count(*) + coalesce(any_value(s.n), 0) AS n FROM customer
    LEFT JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) s ON s.k = c_nationkey GROUP BY 1""")
def b_stream_initial_state(x: Inputs):
    """Running count of customers per nation that starts from the suppliers' counts."""
    stored = x.tables["supplier"].groupBy(F.col("s_nationkey").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    running = stateful.running_counts(_arriving(x, "customer"), "c_nationkey", stored)
    return runner.run_update(running, ["key"], conf=runner.KEYED_STATE_STORE).withColumnRenamed("key", "nation")


@query("""SELECT p_brand, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem
    JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def b_stream_static_join(x: Inputs):
    """Stream joined to a stored table, each batch's totals sorted before the write."""
    part = x.tables["part"].select("p_partkey", "p_brand")
    part = F.broadcast(part) if fits_broadcast(part) else part
    totals = (
        _stream(x, "lineitem").select("l_partkey", F.col("l_quantity").cast("bigint").alias("q"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("quantity"))
    )
    return runner.run_complete(totals, shape=lambda b: b.orderBy(F.desc("quantity")))


WORDS_OF = "SELECT unnest(string_split_regex(text, '[ \\n]')) AS word FROM {t}"


_SAID = f"({WORDS_OF.format(t='conversations')}) w"
_EXCLUDED = f"({WORDS_OF.format(t='benchmark')})"


def _counted_words(x: Inputs, folder: str):
    """Words per micro-batch without those of a stored list, and how many were dropped."""
    listed = words(x.tables["benchmark"], "text").distinct().withColumn("listed", F.lit(True))
    listed = F.broadcast(listed) if fits_broadcast(listed) else listed
    said = words(_arriving(x, "conversations"), "text").join(listed, "word", "left")
    dropped = F.sum(F.when(F.col("listed"), 1).otherwise(0)).alias("dropped")
    return runner.run_counted(
        said, [dropped, F.count(F.lit(1)).alias("words")],
        lambda batch: batch.where("listed is null").groupBy("word").agg(F.count(F.lit(1)).alias("n")), folder)


@query(f"SELECT word, count(*) AS n FROM {_SAID} WHERE word NOT IN {_EXCLUDED} GROUP BY 1")
def b_stream_exclude_list(x: Inputs):
    """Word count without the words of a stored exclude list."""
    counts, _ = _counted_words(x, fresh_dir(x.spark, "exclude"))
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


@query(f"SELECT CAST(sum(CASE WHEN word IN {_EXCLUDED} THEN 1 ELSE 0 END) AS BIGINT) AS dropped, count(*) AS words FROM {_SAID}")
def b_stream_dropped_counter(x: Inputs):
    """How many words the exclude list dropped, counted while the batches were written."""
    _, counters = _counted_words(x, fresh_dir(x.spark, "dropped"))
    return counters.agg(F.sum("dropped").alias("dropped"), F.sum("words").alias("words"))


@query("SELECT role, count(*) AS n FROM conversations GROUP BY 1")
def b_stream_batch_sql(x: Inputs):
    """SQL text over each micro-batch."""

    def by_role(batch):
        return batch.sparkSession.sql(
            "SELECT role, count(*) AS n FROM {batch} GROUP BY role", batch=batch)

    _, batches = runner.run_batches(
        _stream(x, "conversations").select("role"), "append", shape=by_role)
    return batches.groupBy("role").agg(F.sum("n").alias("n"))


@query(f"""SELECT {_bucket("time_bucket(INTERVAL 1 DAY, ts)")} AS start,
    CAST(json_extract(props, '$.k') AS BIGINT) AS zone, count(*) AS hits,
    sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS error_rate
    FROM events GROUP BY 1, 2""")
def b_stream_error_rate(x: Inputs):
    """Share of errors per zone and day."""
    zone = F.from_json("props", "k bigint")["k"]
    error = F.when(F.col("event_type") == "error", 1).otherwise(0)
    rates = (
        _stream(x, "events").withWatermark("ts", LATE).groupBy(F.window("ts", "1 day").alias("w"), zone.alias("zone"))
        .agg(F.count(F.lit(1)).alias("hits"), F.sum(error).alias("errors"))
        .select(F.col("w.start").alias("start"), "zone", "hits",
                (F.col("errors") / F.col("hits")).alias("error_rate"))
    )
    return runner.run_update(rates, ["start", "zone"])


@query(f"""SELECT {_bucket("time_bucket(INTERVAL 1 HOUR, ts)")} AS start,
    count(DISTINCT user_id) AS active, count(*) AS hits FROM events
    WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= {FINAL} GROUP BY 1""")
def b_stream_active_users(x: Inputs):
    """Exact distinct users per hour from two chained aggregates."""
    return runner.run_append(
        windows.active_keys(_stream(x, "events"), "ts", "user_id", "1 hour", LATE))


@query("SELECT c_name, count(*) AS n FROM events JOIN customer ON user_id = c_custkey GROUP BY 1")
def b_stream_users_seen(x: Inputs):
    """Events of users that are in the stored customer table."""
    users = x.tables["customer"].select("c_custkey", "c_name")
    users = F.broadcast(users) if fits_broadcast(users) else users
    seen = (
        _stream(x, "events").select("user_id")
        .join(users, F.col("user_id") == F.col("c_custkey"))
        .groupBy("c_name").agg(F.count(F.lit(1)).alias("n"))
    )
    return runner.run_update(seen, ["c_name"])
