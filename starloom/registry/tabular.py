"""DataFrame basics, file formats and options, word count, sort, log summary, metrics."""

from __future__ import annotations

from pyspark.sql import Observation, functions as F, types as T

from starloom.config import fresh_dir
from starloom.operators.joins import fits_broadcast, hot_keys
from starloom.registry.base import Inputs, Registry
from starloom.sources import readers, sinks

REGISTRY = Registry()
query = REGISTRY.query

MONEY = "decimal(18,2)"


# --- DataFrame and SQL basics ------------------------------------------------------------

@query("SELECT c_name, c_custkey + 1 AS next_key FROM customer WHERE c_acctbal > 5000")
def b_select_filter(x: Inputs):
    c = x.tables["customer"]
    return c.where(F.col("c_acctbal") > 5000).select(
        "c_name", (F.col("c_custkey") + 1).alias("next_key")
    )


@query("SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def b_group_count(x: Inputs):
    return x.tables["customer"].groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal < 0 GROUP BY 1")
def b_views(x: Inputs):
    """A session view and a global view, both read through SQL text."""
    x.tables["customer"].createOrReplaceTempView("starloom_customer")
    x.spark.sql(
        "SELECT * FROM starloom_customer WHERE c_acctbal < 0"
    ).createOrReplaceGlobalTempView("starloom_debtors")
    return x.spark.sql(
        "SELECT c_mktsegment, count(*) AS n FROM global_temp.starloom_debtors GROUP BY 1"
    )


PART_LINES = "SELECT p_partkey, p_brand, p_size FROM part"


def _part_lines(x: Inputs):
    part = x.tables["part"].select("p_partkey", "p_brand", "p_size")
    return part.select(F.to_csv(F.struct(*part.columns)).alias("line"))


@query(PART_LINES)
def b_programmatic_schema(x: Inputs):
    """Text lines to a relation with a schema put together at run time."""
    kinds = {"p_partkey": T.LongType(), "p_brand": T.StringType(), "p_size": T.IntegerType()}
    schema = T.StructType([T.StructField(n, t) for n, t in kinds.items()])
    parsed = F.from_csv("line", F.lit(schema.simpleString()[7:-1].replace(":", " ")))
    return _part_lines(x).select(parsed.alias("p")).select("p.*")


@query(PART_LINES)
def b_inferred_schema(x: Inputs):
    """Text lines to a relation whose types are inferred from the data."""
    path = fresh_dir(x.spark, "lines")
    _part_lines(x).write.text(path)
    names = ["p_partkey", "p_brand", "p_size"]
    return x.spark.read.option("inferSchema", True).csv(path).toDF(*names)


@query("""SELECT n_name, count(*) AS customers,
    CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 GROUP BY 1""")
def b_table_sql(x: Inputs):
    """Create a table, load it, then filter, join, group and order in SQL."""
    path = fresh_dir(x.spark, "customers")
    name = f"starloom_customers_{path.rsplit('-', 1)[-1]}"
    sinks.create_or_replace(x.tables["customer"], name, path)
    return x.spark.sql(
        f"""SELECT n_name, count(*) AS customers, sum(CAST(c_acctbal AS {MONEY})) AS balance
        FROM {name} JOIN {{nation}} ON c_nationkey = n_nationkey
        WHERE c_acctbal > 0 GROUP BY n_name ORDER BY n_name""",
        nation=x.tables["nation"],
    )


@query("""SELECT l_returnflag, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS day,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_quantity,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price
    FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2""")
def b_daily_averages(x: Inputs):
    """Filter, group by day, average two measures."""
    return (
        x.tables["lineitem"].where("l_linestatus = 'F'")
        .groupBy("l_returnflag", F.date_format("l_shipdate", "yyyyMMdd").cast("int").alias("day"))
        .agg(
            F.sum(F.col("l_quantity").cast(MONEY)).cast("double").alias("q"),
            F.sum(F.col("l_extendedprice").cast(MONEY)).cast("double").alias("p"),
            F.count(F.lit(1)).alias("n"),
        )
        .select("l_returnflag", "day", (F.col("q") / F.col("n")).alias("avg_quantity"),
                (F.col("p") / F.col("n")).alias("avg_price"))
    )


# --- files -------------------------------------------------------------------------------

EVENTS = "SELECT event_id, user_id, event_type FROM events"


def _events(x: Inputs):
    return x.tables["events"].select("event_id", "user_id", "event_type")


@query(EVENTS)
def b_file_selection(x: Inputs):
    """Recursive lookup, name filter and modification window pick the data files."""
    path = fresh_dir(x.spark, "nested")
    events = _events(x)
    events.where("event_type = 'click'").write.parquet(f"{path}/a/clicks")
    events.where("event_type <> 'click'").write.parquet(f"{path}/b/c/rest")
    events.write.json(f"{path}/b/copies")
    return readers.read_files(
        x.spark, path, "parquet", schema=events.schema, glob="*.parquet", recursive=True,
        modified_after="2020-01-01T00:00:00", modified_before="2100-01-01T00:00:00",
    )


@query(EVENTS)
def b_corrupt_files(x: Inputs):
    """Files that are not Parquet are passed over when asked to."""
    path = fresh_dir(x.spark, "partly_corrupt")
    events = _events(x)
    events.write.parquet(f"{path}/good")
    events.select(F.col("event_type")).write.text(f"{path}/bad")
    return readers.read_files(
        x.spark, [f"{path}/good", f"{path}/bad"], "parquet", schema=events.schema,
        ignore_corrupt=True,
    )


@query(EVENTS)
def b_partitioned_write(x: Inputs):
    path = fresh_dir(x.spark, "by_type")
    _events(x).write.partitionBy("event_type").parquet(path)
    return x.spark.read.parquet(path).select("event_id", "user_id", "event_type")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def b_bucketed_table(x: Inputs):
    """A table bucketed and sorted by user: grouping by user needs no shuffle."""
    path = fresh_dir(x.spark, "by_user")
    name = f"starloom_by_user_{path.rsplit('-', 1)[-1]}"
    sinks.create_or_replace(_events(x), name, path, bucket_by=(8, "user_id"))
    return x.spark.table(name).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query(EVENTS)
def b_orc_options(x: Inputs):
    """ORC with a bloom filter and dictionary hints."""
    path = fresh_dir(x.spark, "orc")
    (
        _events(x).write.option("orc.bloom.filter.columns", "event_type")
        .option("orc.dictionary.key.threshold", "1.0")
        .option("orc.column.encoding.direct", "user_id").orc(path)
    )
    return x.spark.read.orc(path)


@query(EVENTS)
def b_parquet_options(x: Inputs):
    """Parquet with a bloom filter on one column, then SQL directly on the files."""
    path = fresh_dir(x.spark, "bloom")
    (
        _events(x).write.option("parquet.bloom.filter.enabled#event_type", "true")
        .option("parquet.bloom.filter.expected.ndv#event_type", "1000")
        .option("parquet.enable.dictionary", "true").parquet(path)
    )
    return x.spark.sql(f"SELECT * FROM parquet.`{path}`")


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END "
       "AS o_orderpriority FROM orders")
def b_schema_merge(x: Inputs):
    """Two folders with different columns read as one relation."""
    path = fresh_dir(x.spark, "evolving")
    orders = x.tables["orders"]
    orders.where("o_orderstatus <> 'O'").select("o_orderkey", "o_custkey").write.parquet(
        f"{path}/part=1")
    orders.where("o_orderstatus = 'O'").select(
        "o_orderkey", "o_custkey", "o_orderpriority").write.parquet(f"{path}/part=2")
    merged = x.spark.read.option("mergeSchema", True).parquet(path)
    return merged.select("o_orderkey", "o_custkey", "o_orderpriority")


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n "
       "FROM events GROUP BY 1, 2")
def b_json_fields(x: Inputs):
    parsed = F.from_json("props", "k bigint")
    return x.tables["events"].groupBy("event_type", parsed["k"].alias("k")).agg(
        F.count(F.lit(1)).alias("n"))


@query(EVENTS)
def b_json_files(x: Inputs):
    path = fresh_dir(x.spark, "json")
    _events(x).write.json(path)
    return x.spark.read.schema(_events(x).schema).json(path)


@query("SELECT p_partkey, p_name, p_retailprice FROM part")
def b_csv_options(x: Inputs):
    """Another separator, a quote character and a null marker."""
    path = fresh_dir(x.spark, "csv")
    part = x.tables["part"].select("p_partkey", "p_name", "p_retailprice")
    options = {"sep": ";", "header": True, "quote": "'", "nullValue": "\\N"}
    part.write.options(**options).csv(path)
    return x.spark.read.schema(part.schema).options(**options).csv(path)


@query("SELECT length(line) AS size, count(*) AS n FROM "
       "(SELECT replace(text, chr(10), ' ') AS line FROM documents) d GROUP BY 1")
def b_text_gzip(x: Inputs):
    """One line per document, gzip-compressed, read back with an explicit separator."""
    path = fresh_dir(x.spark, "text")
    x.tables["documents"].select(F.replace("text", F.lit("\n"), F.lit(" "))).write.option(
        "compression", "gzip").option("lineSep", "\n").text(path)
    lines = x.spark.read.option("lineSep", "\n").text(path)
    return lines.groupBy(F.length("value").alias("size")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS lines FROM benchmark")
def b_text_whole(x: Inputs):
    """Each file as one value; files are kept to a thousand lines."""
    path = fresh_dir(x.spark, "whole")
    x.tables["benchmark"].select(F.replace("text", F.lit("\n"), F.lit(" "))).write.option(
        "maxRecordsPerFile", 1000).text(path)
    whole = x.spark.read.text(path, wholetext=True)
    return whole.agg(F.sum(F.size(F.split("value", "\n")) - 1).alias("lines"))


# --- jobs --------------------------------------------------------------------------------

@query("SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '[ \\n]')) "
       "AS word FROM documents) w GROUP BY 1")
def b_word_count(x: Inputs):
    words = x.tables["documents"].select(F.explode(F.split("text", "[ \\n]")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_custkey, o_orderkey FROM orders")
def b_sort(x: Inputs):
    """Total order over range partitions."""
    return x.tables["orders"].select("o_custkey", "o_orderkey").orderBy("o_custkey", "o_orderkey")


URL = r"^(https?)://([^/]+)/([a-z]*)/?"


@query(f"""SELECT regexp_extract(url, '{URL}', 2) AS host, regexp_extract(url, '{URL}', 3)
    AS section, count(*) AS hits, sum(strlen(html)) AS bytes FROM pages GROUP BY 1, 2""")
def b_log_summary(x: Inputs):
    """Parse a key from each request line, then hits and bytes per key."""
    host, section = (F.regexp_extract("url", URL, g) for g in (2, 3))
    return x.tables["pages"].groupBy(host.alias("host"), section.alias("section")).agg(
        F.count(F.lit(1)).alias("hits"), F.sum(F.octet_length("html")).alias("bytes"))


@query("SELECT count(DISTINCT l_partkey) AS keys, count(*) AS pairs FROM lineitem")
def b_group_by_keys(x: Inputs):
    """Number of groups; every task sends each of its keys once."""
    per_key = x.tables["lineitem"].groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("pairs"))


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def b_skewed_groups(x: Inputs):
    """Few, large groups: distinct users are made unique per (group, user) first."""
    per_user = x.tables["events"].groupBy("event_type", "user_id").agg(
        F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("event_type").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("users"))


@query("""SELECT l_returnflag AS hot FROM lineitem GROUP BY 1
    HAVING count(*) >= (SELECT count(*) FROM lineitem) / 1000.0""")
def b_hot_keys(x: Inputs):
    """Keys that own at least a thousandth of the rows."""
    return hot_keys(x.tables["lineitem"], "l_returnflag").withColumnRenamed("_hot", "hot")


@query("SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey "
       "GROUP BY 1")
def b_broadcast(x: Inputs):
    """Ship a small table to every task, but only when its size allows it."""
    nation = x.tables["nation"].select("n_nationkey", "n_name")
    small = F.broadcast(nation) if fits_broadcast(nation) else nation
    counts = x.tables["customer"].groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(small, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "n")


@query("""SELECT count(*) AS n_rows, sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS large,
    max(event_id) AS last_id FROM events""")
def b_observed_metrics(x: Inputs):
    """Counters collected while the rows are being written.

    Observed in a session of its own: a session that has observed anything can no longer
    ship binary classifiers, whose training summary drags the session along.
    """
    seen = Observation()
    path = fresh_dir(x.spark, "observed")
    readers.TableSet(x.spark.newSession(), x.folder)["events"].observe(
        seen, F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(F.col("value") > 50, 1).otherwise(0)).alias("large"),
        F.max("event_id").alias("last_id"),
    ).write.parquet(path)
    m = seen.get
    return x.spark.range(1).select(
        *[F.lit(m[k]).alias(k) for k in ("n_rows", "large", "last_id")])
