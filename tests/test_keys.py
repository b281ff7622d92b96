import hashlib

from pyspark.sql import functions as F

from starloom.functions.calendar import time_key, time_key_half_day
from starloom.functions.defaults import Attribute, any_present, null_defaulted
from starloom.functions.keys import UNKNOWN_KEY, fingerprint, group_key, md5_key, surrogate_key


def one(df):
    return df.first()[0]


def test_compat_fingerprint_collides_and_strict_does_not(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert df.select(fingerprint(df.columns, "compat")).distinct().count() == 1
    assert df.select(fingerprint(df.columns)).distinct().count() == 2


def test_strict_fingerprint_survives_separators_and_marks(spark):
    values = [("a|1:b", "c"), ("a", "1:b|c"), ("~", None), (None, "~"), ("", None), (None, "")]
    df = spark.createDataFrame(values, "x string, y string")
    assert df.select(fingerprint(df.columns)).distinct().count() == len(values)


def test_surrogate_key_is_the_digest_of_the_joined_text(spark):
    df = spark.createDataFrame([(7, "n")], "a bigint, b string")
    assert one(df.select(surrogate_key(["a", "b"]))) == hashlib.sha256(b"7|n").hexdigest()
    assert one(df.select(md5_key(["a", "b"]))) == hashlib.md5(b"7|n").hexdigest().upper()
    assert len(UNKNOWN_KEY) == 64


def test_group_key_of_a_missing_encounter_is_missing(spark):
    df = spark.createDataFrame([(None,)], "e string")
    assert one(df.select(group_key("e"))) is None


def test_default_replaces_null_after_the_cast(spark):
    df = spark.createDataFrame([(None, None), (2139, "8302-2")], "zip bigint, code string")
    attrs = [Attribute("zip", "Zip", "string", "Unknown"), Attribute("code", "Code", "string", "0")]
    got = [tuple(r) for r in df.select(*null_defaulted(attrs)).collect()]
    assert got == [("Unknown", "0"), ("2139", "8302-2")]


def test_default_text_may_hold_quotes(spark):
    df = spark.createDataFrame([(None,)], "a string")
    assert one(df.select(Attribute("a", "b", "string", "it's \\ so").project())) == "it's \\ so"


def test_any_present(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    assert df.where(any_present(["a", "b"])).count() == 1


def test_time_keys(spark):
    df = spark.createDataFrame(
        [("00:05:09",), ("11:01:01",), ("01:11:01",), ("13:05:09",)], "t string"
    ).select(F.concat(F.lit("2020-01-01 "), "t").cast("timestamp").alias("t"))
    full = [r[0] for r in df.select(time_key(F.col("t"))).collect()]
    half = [r[0] for r in df.select(time_key_half_day(F.col("t"))).collect()]
    assert full == [509, 110101, 11101, 130509]
    assert half == [120509, 110101, 11101, 10509]
