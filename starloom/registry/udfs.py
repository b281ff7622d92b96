"""Vectorized functions, table functions and typed aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import table_functions as tf
from starloom.functions import vectorized as vec
from starloom.operators.joins import lookup_join
from starloom.operators.timeline import as_of_join, merge_ordered
from starloom.plans.bindings import binding_sql
from starloom.registry.base import Inputs, Registry

REGISTRY = Registry()
query = REGISTRY.query


def cents():
    """The event value in whole cents, which sums exactly."""
    return F.round(F.col("value") * 100).cast("bigint")


CENTS_SQL = "CAST(round(value * 100) AS BIGINT)"


@query("SELECT p_partkey, p_partkey * p_size AS product FROM part")
def b_series_to_series(x: Inputs):
    return x.tables["part"].select(
        "p_partkey", (F.col("p_partkey") * F.col("p_size").cast("bigint")).alias("product"))


@query("SELECT c_custkey, split_part(c_name, '#', 1) AS head, split_part(c_name, '#', 2) AS tail "
       "FROM customer")
def b_series_to_frame(x: Inputs):
    return x.tables["customer"].select("c_custkey", vec.split_head("c_name").alias("s")).select(
        "c_custkey", "s.*")


@query("SELECT o_orderkey, o_custkey + 1 AS next FROM orders")
def b_iterator_to_iterator(x: Inputs):
    return x.tables["orders"].select("o_orderkey", (F.col("o_custkey") + 1).alias("next"))


@query("SELECT l_orderkey, l_linenumber, l_partkey * l_suppkey AS product FROM lineitem")
def b_iterator_of_columns(x: Inputs):
    return x.tables["lineitem"].select(
        "l_orderkey", "l_linenumber",
        (F.col("l_partkey") * F.col("l_suppkey")).alias("product"))


@query(f"SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n, CAST(sum({CENTS_SQL}) AS DOUBLE) "
       "/ count(*) AS mean FROM events GROUP BY 1")
def b_grouped_mean(x: Inputs):
    """User-defined mean: buffers per Arrow batch, merged after the shuffle."""
    return vec.grouped_mean(x.tables["events"], "user_id", cents())


def _means(x: Inputs, suffix: str):
    return (
        x.tables["events"].groupBy(F.col("user_id").alias(f"user{suffix}"))
        .agg((F.sum(cents()).cast("double") / F.count(F.lit(1))).alias("mean"))
    )


def _with_mean(x: Inputs):
    """Every event beside the mean of its user.

    Aggregate and join instead of an unbounded window, so that no task has to hold all rows
    of one user.
    """
    rows = x.tables["events"].select("event_id", "user_id", cents().alias("cents"))
    return lookup_join(rows, _means(x, "_m"), "user_id", "user_m", spread_by="event_id")


@query(f"SELECT event_id, user_id, {CENTS_SQL} AS cents, m.mean FROM events JOIN (SELECT user_id "
       f"AS u, CAST(sum({CENTS_SQL}) AS DOUBLE) / count(*) AS mean FROM events GROUP BY 1) m "
       "ON user_id = u")
def b_window_mean(x: Inputs):
    return _with_mean(x).select("event_id", "user_id", "cents", "mean")


@query(f"SELECT event_id, user_id, {CENTS_SQL} - m.mean AS centered FROM events JOIN (SELECT "
       f"user_id AS u, CAST(sum({CENTS_SQL}) AS DOUBLE) / count(*) AS mean FROM events GROUP BY 1)"
       " m ON user_id = u")
def b_subtract_mean(x: Inputs):
    """Grouped map that centers each group on its mean."""
    return _with_mean(x).select(
        "event_id", "user_id", (F.col("cents") - F.col("mean")).alias("centered"))


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type = 'purchase'")
def b_map_batches(x: Inputs):
    rows = x.tables["events"].select("event_id", "user_id", "event_type")
    return rows.where("event_type = 'purchase'")


DAILY = """SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS {name} FROM events
    WHERE event_type = '{kind}' GROUP BY 1, 2"""


@query(f"SELECT user_id, day, views, purchases FROM ({DAILY.format(name='views', kind='view')}) v "
       f"FULL JOIN ({DAILY.format(name='purchases', kind='purchase')}) p USING (user_id, day)")
def b_cogrouped_merge(x: Inputs):
    """Ordered merge of two daily series of each user."""

    def daily(kind, name):
        return (
            x.tables["events"].where(F.col("event_type") == kind)
            .groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
            .agg(F.count(F.lit(1)).alias(name))
        )

    return merge_ordered(
        daily("view", "views"), daily("purchase", "purchases"), ["user_id", "day"])


@query("""SELECT p.event_id, p.user_id, max(v.event_id) AS last_view FROM events p LEFT JOIN
    (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view') v
    ON v.user_id = p.user_id AND v.ts = (SELECT max(w.ts) FROM events w WHERE w.user_id = p.user_id
        AND w.event_type = 'view' AND w.ts <= p.ts)
    WHERE p.event_type = 'purchase' GROUP BY 1, 2""")
def b_as_of_merge(x: Inputs):
    """Each purchase with the last view of the same user at or before it."""
    events = x.tables["events"]
    left = events.where("event_type = 'purchase'").select("user_id", "ts", "event_id")
    right = events.where("event_type = 'view'").select(
        "user_id", "ts", F.col("event_id").alias("last_view"))
    return as_of_join(left, right, "user_id", "ts", "last_view").select(
        "event_id", "user_id", "last_view")


@query("SELECT c_custkey, length(c_name) AS plain, length(c_name) AS arrow FROM customer")
def b_arrow_row_function(x: Inputs):
    return x.tables["customer"].select(
        "c_custkey", F.length("c_name").alias("plain"), F.length("c_name").alias("arrow"))


@query("SELECT c_custkey, length(c_name) AS n FROM customer WHERE length(c_name) > 5 "
       "AND c_custkey + 1 > 10")
def b_registered_function(x: Inputs):
    return x.spark.sql(
        "SELECT c_custkey, length(c_name) AS n FROM {customer} "
        "WHERE length(c_name) > 5 AND c_custkey + 1 > 10", customer=x.tables["customer"])


@query("SELECT count(*) AS n FROM customer")
def b_nondeterministic_function(x: Inputs):
    """A random function is evaluated per row and never folded; all rows stay in range."""
    drawn = x.tables["customer"].select(F.rand().alias("r"))
    return drawn.where("r >= 0 AND r < 1").agg(F.count(F.lit(1)).alias("n"))


ENCOUNTERS = binding_sql("encounters")


@query(f"""SELECT ID, CASE WHEN h IS NULL THEN 'unknown' WHEN h < 6 THEN 'from 0 h' WHEN h < 24 THEN 'from 6 h'
    WHEN h < 48 THEN 'from 24 h' ELSE 'from 48 h' END AS band
    FROM (SELECT ID, (epoch(STOP) - epoch(START)) / 3600 AS h FROM ({ENCOUNTERS}) e) s""")
def b_vec_stay_band(x: Inputs):
    hours = (F.unix_timestamp("STOP") - F.unix_timestamp("START")) / 3600
    return x.enriched["encounters"].select("ID", vec.stay_band(hours).alias("band"))


@query("""SELECT o_orderkey, CAST((SELECT sum((o_orderkey // CAST(power(10, i) AS BIGINT)) % 10 * (1 + i % 9))
    FROM range(19) r(i)) % 11 AS BIGINT) AS digit FROM orders""")
def b_vec_check_digit(x: Inputs):
    return x.tables["orders"].select("o_orderkey", vec.check_digit("o_orderkey").alias("digit"))


@query(f"""SELECT ID, greatest(CAST(round(TOTAL_CLAIM_COST * 100) AS BIGINT)
    - coalesce(CAST(round(PAYER_COVERAGE * 100) AS BIGINT), 0), 0) AS cents FROM ({ENCOUNTERS}) e""")
def b_vec_patient_share(x: Inputs):
    cents = [F.round(F.col(c) * 100).cast("bigint") for c in ("TOTAL_CLAIM_COST", "PAYER_COVERAGE")]
    return x.enriched["encounters"].select("ID", vec.patient_share(*cents).alias("cents"))


@query("SELECT c_custkey, string_agg(p[1], '' ORDER BY i) AS initials FROM (SELECT c_custkey, unnest(w) AS p, "
       "generate_subscripts(w, 1) AS i FROM (SELECT c_custkey, list_filter(string_split(replace(c_name, '#', ' '), ' '), "
       "lambda x: x <> '') AS w FROM customer) s) t GROUP BY 1")
def b_vec_initials(x: Inputs):
    """A row function registered by name."""
    x.spark.udf.register("starloom_initials", vec.initials)
    return x.spark.sql("SELECT c_custkey, starloom_initials(c_name) AS initials FROM {customer}",
                       customer=x.tables["customer"])


@query(f"SELECT ID AS id, CASE WHEN STOP < START THEN 'reversed' ELSE 'over-covered' END AS fault "
       f"FROM (SELECT ID, START, STOP - INTERVAL 1 DAY AS STOP, TOTAL_CLAIM_COST AS claim, "
       f"PAYER_COVERAGE * 1.25 AS covered FROM ({ENCOUNTERS}) e) s WHERE STOP < START OR covered > claim")
def b_vec_faults(x: Inputs):
    """Batch map with a plausibility rule: stays of under a day or payments above the claim."""
    rows = x.enriched["encounters"].select(
        F.col("ID").alias("id"), F.unix_micros("START").alias("start_us"),
        F.unix_micros(F.expr("STOP - INTERVAL 1 DAY")).alias("stop_us"),
        F.col("TOTAL_CLAIM_COST").alias("claim"), (F.col("PAYER_COVERAGE") * 1.25).alias("covered"))
    return rows.mapInPandas(vec.with_faults, "id string, fault string")


@query(f"""SELECT event_type, sum({CENTS_SQL}) AS total, count(*) AS n,
    CAST(sum({CENTS_SQL}) AS DOUBLE) / count(*) AS mean, min({CENTS_SQL}) AS lowest,
    max({CENTS_SQL}) AS highest FROM events GROUP BY 1""")
def b_typed_aggregates(x: Inputs):
    return x.tables["events"].groupBy("event_type").agg(
        F.sum(cents()).alias("total"), F.count(F.lit(1)).alias("n"),
        (F.sum(cents()).cast("double") / F.count(F.lit(1))).alias("mean"),
        F.min(cents()).alias("lowest"), F.max(cents()).alias("highest"))


@query("SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1")
def b_arrow_batches(x: Inputs):
    """Rows to Arrow batches and back, without passing the driver."""

    def same(batches):
        yield from batches

    rows = x.tables["events"].select("user_id", "event_type")
    return rows.mapInArrow(same, rows.schema).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("event_type").alias("kinds"))


# --- table functions and generators ---------------------------------------------------------

def _lateral(x: Inputs, text: str, **tables):
    tf.register_all(x.spark)
    return x.spark.sql(text, **tables)


@query("""SELECT l_orderkey, l_partkey, CAST(i AS INTEGER) AS num, CAST(i * i AS INTEGER)
    AS squared FROM (SELECT l_orderkey, l_partkey, unnest(range(1, l_linenumber + 1)) AS i
    FROM lineitem) s""")
def b_udtf_squares(x: Inputs):
    numbers = F.explode(F.sequence(F.lit(1), F.col("l_linenumber").cast("int"))).alias("num")
    return x.tables["lineitem"].select("l_orderkey", "l_partkey", numbers).withColumn(
        "squared", F.col("num") * F.col("num"))


@query("SELECT item_id, trim(word) AS word FROM (SELECT item_id, unnest(string_split(text, ' ')) "
       "AS word FROM benchmark) b")
def b_udtf_words(x: Inputs):
    words = F.explode(F.split("text", " ")).alias("word")
    return x.tables["benchmark"].select("item_id", words).withColumn("word", F.trim("word"))


@query("SELECT p_partkey, p_size AS c1, p_size + 1 AS c2 FROM part")
def b_udtf_arrow(x: Inputs):
    return x.tables["part"].select("p_partkey", F.col("p_size").alias("c1"), (F.col("p_size") + 1).alias("c2"))


@query(f"""SELECT ID, strftime(unnest(generate_series(CAST(START AS DATE), CAST(STOP AS DATE),
    INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM (SELECT * FROM ({ENCOUNTERS}) e
    WHERE STOP IS NOT NULL) s""")
def b_udtf_days(x: Inputs):
    """Every day an encounter touches."""
    spans = x.enriched["encounters"].where("STOP IS NOT NULL")
    days = F.explode(F.sequence(F.to_date("START"), F.to_date("STOP"))).alias("day")
    return spans.select("ID", days).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("SELECT count(*) AS n FROM orders")
def b_udtf_terminate(x: Inputs):
    return x.tables["orders"].agg(F.count("o_orderkey").alias("n"))


@query("SELECT o_orderkey AS id FROM orders WHERE o_totalprice > 200000")
def b_udtf_table_argument(x: Inputs):
    return x.tables["orders"].where("o_totalprice > 200000").select(F.col("o_orderkey").alias("id"))


_CENTS = "CAST(round(TOTAL_CLAIM_COST * 100) AS BIGINT)"


@query(f"""WITH s AS (SELECT ID, CAST(START AS DATE) AS first, {_CENTS} AS cents,
        greatest(coalesce(date_diff('day', CAST(START AS DATE), CAST(STOP AS DATE)), 0), 0) + 1 AS days
        FROM ({ENCOUNTERS}) e),
    d AS (SELECT *, unnest(range(days)) AS n FROM s)
    SELECT ID, strftime(first + CAST(n AS INTEGER), '%Y-%m-%d') AS charge_day,
        cents // days + CASE WHEN n < cents % days THEN 1 ELSE 0 END AS charge_cents FROM d""")
def b_udtf_daily_charges(x: Inputs):
    """The cost of every encounter spread over its days."""
    rows = x.enriched["encounters"].select(
        "ID", F.date_format("START", "yyyy-MM-dd").alias("a"), F.date_format("STOP", "yyyy-MM-dd").alias("b"),
        F.round(F.col("TOTAL_CLAIM_COST") * 100).cast("bigint").alias("cents"))
    return _lateral(x, "SELECT ID, charge_day, charge_cents FROM {rows}, LATERAL daily_charges(a, b, cents)", rows=rows)


@query(f"""SELECT 'no patient' AS reason, count(*) FILTER (WHERE PATIENT IS NULL) AS rejected FROM ({ENCOUNTERS}) e
    UNION ALL SELECT 'no payer', count(*) FILTER (WHERE PAYER IS NULL) FROM ({ENCOUNTERS}) e
    UNION ALL SELECT 'still open', count(*) FILTER (WHERE STOP IS NULL) FROM ({ENCOUNTERS}) e""")
def b_udtf_reject_counts(x: Inputs):
    """Counted in every partition, summed over all."""
    return _reject_counts(x, x.enriched["encounters"].select("PATIENT", "PAYER", "STOP"))


def _reject_counts(x: Inputs, rows):
    """Every reason has a count, also where there are no rows."""
    reasons = ", ".join(f"'{reason}'" for reason in tf.RejectCounts.func.RULES)
    return _lateral(
        x, "SELECT reason, CAST(sum(rejected) AS BIGINT) AS rejected FROM (SELECT reason, rejected FROM "
        "reject_counts(TABLE(SELECT * FROM {rows})) UNION ALL "
        f"SELECT explode(array({reasons})), CAST(0 AS BIGINT)) c GROUP BY reason", rows=rows)


@query(f"""WITH e AS (SELECT PATIENT, CAST(START AS DATE) AS a, CAST(coalesce(STOP, START) AS DATE) AS b, START, ID
        FROM ({ENCOUNTERS}) s WHERE PATIENT IS NOT NULL),
    u AS (SELECT PATIENT, a, max(b) OVER (PARTITION BY PATIENT ORDER BY START, ID
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM e)
    SELECT PATIENT AS patient, strftime(until, '%Y-%m-%d') AS gap_from, CAST(date_diff('day', until, a) AS INTEGER) AS gap_days
    FROM u WHERE date_diff('day', until, a) >= 365""")
def b_udtf_care_gaps(x: Inputs):
    """Years without care; the function keeps one date per patient."""
    rows = x.enriched["encounters"].where("PATIENT IS NOT NULL").select("PATIENT", "START", "STOP", "ID")
    return _lateral(
        x, "SELECT patient, gap_from, gap_days FROM care_gaps(TABLE(SELECT * FROM {rows}) "
        "PARTITION BY PATIENT ORDER BY (START, ID), 365)", rows=rows)


@query("""SELECT account, entries, round(list_reduce(amounts, lambda a, b: greatest(0.0, least(500.0, a + b)), 0.0), 6) AS balance
    FROM (SELECT CAST(user_id AS VARCHAR) AS account, count(*) AS entries, list(value - 45.0 ORDER BY ts, event_id) AS amounts
        FROM events GROUP BY 1) e""")
def b_udtf_bounded_balance(x: Inputs):
    """A balance per user that stays between nought and 500; an Arrow table function."""
    rows = x.tables["events"].select(F.col("user_id").cast("string").alias("account"), (F.col("value") - 45.0).alias("amount"), "ts", "event_id")
    return _lateral(
        x, "SELECT account, entries, round(balance, 6) AS balance FROM bounded_balance(TABLE(SELECT * FROM {rows}) "
        "PARTITION BY account ORDER BY (ts, event_id), 0.0D, 500.0D)", rows=rows)
