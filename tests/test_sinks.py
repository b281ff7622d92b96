import pytest
from pyspark.sql import functions as F

from starloom.config import database_name
from starloom.operators import layout
from starloom.sources import sinks
from tests.conftest import rows


@pytest.fixture
def people(spark):
    """Local collection to relation."""
    return spark.createDataFrame([("Ann", 34), ("Bob", 45), ("Cid", 29)], ["name", "age"])


def test_replace_reads_the_table_it_replaces(spark, people, tmp_path):
    name = "people_replace"
    sinks.create_or_replace(people, name, str(tmp_path))
    older = spark.table(name).withColumn("age", F.col("age") + 1)
    sinks.create_or_replace(older, name, str(tmp_path))
    assert rows(spark.table(name)) == [("Ann", 35), ("Bob", 46), ("Cid", 30)]


def test_append_and_build_once(spark, people, tmp_path):
    name = "people_once"
    assert sinks.build_once(people, name, str(tmp_path))
    assert not sinks.build_once(people, name, str(tmp_path))
    sinks.append(people.where("age > 40"), name)
    assert spark.table(name).count() == 4


def test_a_bucketed_table_stays_bucketed_and_readable(spark, people, tmp_path):
    name, folder = "people_buckets", str(tmp_path)
    sinks.create_or_replace(people, name, folder, bucket_by=(3, "name"))
    for step in (1, 2, 3):
        older = spark.table(name).withColumn("age", F.col("age") + 1)
        sinks.create_or_replace(older, name, folder)
        assert rows(spark.table(name)) == [
            ("Ann", 34 + step), ("Bob", 45 + step), ("Cid", 29 + step)]
    described = {r["col_name"]: r["data_type"] for r in spark.sql(
        f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert described["Num Buckets"] == "3"
    # the version in use and the one before
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("v_")]) == 2


def test_range_layout_gives_disjoint_files(spark, tmp_path):
    df = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    layout.range_sorted(df, "k", 4).write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    spans = back.groupBy(F.input_file_name().alias("f")).agg(
        F.min("k").alias("a"), F.max("k").alias("z")).orderBy("a").collect()
    assert len(spans) > 1 and all(x["z"] < y["a"] for x, y in zip(spans, spans[1:]))


def test_database_name():
    assert database_name("main") == "main" and database_name("main", " extra ") == "extra"
