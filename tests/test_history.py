from pyspark.sql import functions as F

from starloom.functions.defaults import Attribute
from starloom.functions.keys import UNKNOWN_ID, UNKNOWN_KEY
from starloom.operators import dimensions, scd2
from tests.conftest import rows

ATTRS = [Attribute("ID", "Id", "string", UNKNOWN_ID), Attribute("C", "City", "string", "Unknown")]


def members(spark, data):
    return dimensions.members(spark.createDataFrame(data, "ID string, C string"), "Key", ATTRS)


def view(dim):
    return rows(dim.select(
        "Id", "City", F.date_format("Effective_Date", "yyyy").alias("a"),
        F.date_format("Expiration_Date", "yyyy").alias("z"), "Is_Current"))


def test_three_batches(spark):
    first = scd2.first_load(members(spark, [("1", "A"), ("2", "B")]), "Key", ATTRS)
    assert (UNKNOWN_ID, "Unknown", "1900", "9999", True) in view(first)
    second = scd2.apply_changes(
        first, members(spark, [("1", "A2"), ("3", "C")]), "Id", "Key", "2001-01-01 00:00:00")
    third = scd2.apply_changes(
        second, members(spark, [("1", "A2"), ("2", "B"), ("3", None)]), "Id", "Key",
        "2005-01-01 00:00:00")
    got = [r for r in view(third) if r[0] != UNKNOWN_ID]
    assert got == [
        ("1", "A", "1900", "2001", False), ("1", "A2", "2001", "9999", True),
        ("2", "B", "1900", "9999", True),
        ("3", "C", "1900", "2005", False), ("3", "Unknown", "2005", "9999", True),
    ]
    per_id = third.where("Is_Current").groupBy("Id").count().where("count <> 1")
    assert per_id.isEmpty()
    again = scd2.apply_changes(
        third, members(spark, [("1", "A2"), ("2", "B"), ("3", None)]), "Id", "Key",
        "2009-01-01 00:00:00")
    assert view(again) == view(third)


def test_as_of_lookup_picks_the_valid_version(spark):
    first = scd2.first_load(members(spark, [("1", "A")]), "Key", ATTRS)
    dim = scd2.apply_changes(first, members(spark, [("1", "B")]), "Id", "Key",
                             "2001-01-01 00:00:00")
    facts = spark.createDataFrame(
        [(1, "1", "2000-12-31 23:59:59"), (2, "1", "2001-01-01 00:00:00"), (3, "9", "2001-01-01"),
         (4, None, "2001-01-01")], "n int, pid string, t string").withColumn(
        "t", F.col("t").cast("timestamp"))
    found = scd2.as_of_lookup(facts, dim, "pid", "t", "Id", "Key", spread_by="n")
    keys = {r["City"]: r["Key"] for r in dim.collect()}
    assert rows(found.select("n", "Key")) == [
        (1, keys["A"]), (2, keys["B"]), (3, None), (4, None)]


def test_unknown_member_matches_columns_by_name(spark):
    df = spark.createDataFrame([(None, None)], "ID string, C string")
    dim = dimensions.code_dimension(df, "Key", ATTRS)
    keys = [r["Key"] for r in dim.collect()]
    assert UNKNOWN_KEY in keys and len(keys) == 2
    assert dimensions.code_dimension(df, "Key", ATTRS, require_any=True).count() == 1
