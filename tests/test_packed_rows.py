import os

from pyspark.sql import functions as F

from starloom.functions.keys import fingerprint
from starloom.operators import dedup
from starloom.registry.base import open_inputs
from starloom.registry.star import _extract
from tests.conftest import rows

ODD = """SELECT * FROM VALUES
    ('a', 1L, -0.0D, CAST('nan' AS double), DATE'1500-01-01', TIMESTAMP'2020-01-01 00:00:00.123456', true),
    ('a', 1L, 0.0D, CAST('nan' AS double), DATE'1500-01-01', TIMESTAMP'2020-01-01 00:00:00.123456', true),
    ('a', 1L, 0.0D, CAST('nan' AS double), DATE'1500-01-01', TIMESTAMP'2020-01-01 00:00:00.123456', true),
    (NULL, NULL, NULL, NULL, NULL, NULL, NULL), (NULL, NULL, NULL, NULL, NULL, NULL, NULL),
    ('', -9223372036854775808L, 0.002D, 1.7976931348623157E308D, DATE'9999-12-31', TIMESTAMP'0001-01-03 00:00:00', false),
    (chr(1), 2L, 1e23D, 4.9E-324D, NULL, TIMESTAMP'9999-12-30 23:59:59.999999', false),
    (concat(chr(1), chr(2)), 2L, 1D, 1D, NULL, NULL, NULL), (concat(chr(1), chr(3)), 2L, 1D, 1D, NULL, NULL, NULL),
    (chr(31), 2L, 1D, 1D, NULL, NULL, NULL), (concat(chr(31), chr(1), '~|1:', chr(1), chr(4)), 2L, 1D, 1D, NULL, NULL, NULL),
    (CAST(X'ff41c328' AS string), 2L, 1D, 1D, NULL, NULL, NULL), (CAST(X'ff41c329' AS string), 2L, 1D, 1D, NULL, NULL, NULL),
    ('  x ', 2L, 1D, 1D, NULL, NULL, NULL), ('ü', 2L, 1D, 1D, NULL, NULL, NULL) AS t(s, l, d, e, day, ts, b)"""


def _shown(df):
    return rows(df.select(
        F.hex("s"), "l", F.col("d").cast("string"), F.col("e").cast("string"), F.unix_date("day"), F.unix_micros("ts"), "b", "HASH"))


def test_packed_rows_come_back_as_they_were(spark):
    df = spark.sql(ODD)
    packed, plain = dedup.distinct_by_fingerprint(df, packed=True), dedup.distinct_by_fingerprint(df)
    assert packed.schema == plain.schema and plain.count() == 13
    assert _shown(packed) == _shown(plain)


def test_rows_that_cannot_be_packed_are_kept_whole(spark):
    df = spark.sql("SELECT array(id % 2) AS a, id % 2 AS b FROM range(6)")
    assert dedup.distinct_by_fingerprint(df, packed=True).count() == 2
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # an hour comes twice
        twice = spark.sql("SELECT timestamp_seconds(1635033600 + 3600 * id) AS t FROM range(24 * 14)")
        strict = twice.select(fingerprint(["t"])).distinct().count()
        assert dedup.distinct_by_fingerprint(twice, packed=True).count() == strict == 24 * 14 - 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def _exchanged(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Exchange" in line)
    return lines[at], lines[at + 1]


def test_an_extract_is_compressed_and_its_digest_stays_out_of_the_shuffle(spark, sf_dir, tmp_path):
    df = _extract(open_inputs(spark, sf_dir), "claims")
    assert all(f.endswith(".csv.gz") for f in df.inputFiles()) and df.inputFiles()
    assert "_packed" in _exchanged(df)[0] and "sha2" not in _exchanged(df)[1]
    folder = os.path.dirname(df.inputFiles()[0])
    assert df.count() == spark.read.option("header", True).csv(folder).distinct().count()
