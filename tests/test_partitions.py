"""Partitions replaced by switching their location."""

import pytest
from pyspark.sql import functions as F

from starloom.operators import layout
from starloom.sources import partitions
from tests.conftest import rows

DDL = "name string, age int, part string"


def table(spark, name):
    return rows(spark.table(name).select("name", "age"))


@pytest.fixture
def parts(spark, tmp_path):
    name, path = f"parts_{tmp_path.name.replace('-', '_')}", str(tmp_path / "t")
    first = [("a1", 1, "a"), ("a2", 2, "a"), ("b1", 3, "b"), ("c1", 4, "c d='x'")]
    partitions.create(spark.createDataFrame(first, DDL), name, path, ["part"])
    yield name, path
    spark.sql(f"DROP TABLE {name}")


def test_groups_given_are_replaced_and_others_stay(spark, parts):
    name, path = parts
    later = [("a1", 9, "a"), ("d1", 7, "d"), ("c1", 5, "c d='x'")]
    partitions.replace_groups(spark.createDataFrame(later, DDL), name, path, "name")
    assert table(spark, name) == [("a1", 9), ("a2", 2), ("b1", 3), ("c1", 5), ("d1", 7)]
    partitions.replace_groups(spark.createDataFrame([], DDL), name, path, "name")
    assert len(table(spark, name)) == 5


def test_a_reader_planned_before_still_gets_the_old_rows(spark, parts):
    name, path = parts
    before = spark.table(name).select("name", "age")
    before._jdf.queryExecution().toRdd()  # its files are listed now
    partitions.replace(spark.createDataFrame([("a1", 50, "a")], DDL), name, path)
    assert rows(before) == [("a1", 1), ("a2", 2), ("b1", 3), ("c1", 4)]
    assert table(spark, name) == [("a1", 50), ("b1", 3), ("c1", 4)]


def test_a_job_that_dies_while_writing_leaves_the_table_as_it_was(spark, parts):
    name, path = parts
    bad = spark.createDataFrame([("a1", 50, "a"), ("b1", 0, "b")], DDL).withColumn(
        "age", F.when(F.col("age") == 0, F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("age")))
    with pytest.raises(Exception, match="broken"):
        partitions.replace(bad, name, path)
    assert table(spark, name) == [("a1", 1), ("a2", 2), ("b1", 3), ("c1", 4)]


def test_a_job_that_dies_among_the_switches_is_completed(spark, parts, monkeypatch):
    name, path = parts
    switch = partitions._switch

    def half(spark_, name_, places, known):
        switch(spark_, name_, dict(list(places.items())[:1]), known)
        raise RuntimeError("killed")

    monkeypatch.setattr(partitions, "_switch", half)
    later = spark.createDataFrame([("a9", 9, "a"), ("b9", 9, "b"), ("e9", 9, "e")], DDL)
    with pytest.raises(RuntimeError):
        partitions.replace(later, name, path, [{"part": "c d='x'"}])
    assert len(table(spark, name)) in (3, 4)
    monkeypatch.undo()
    assert partitions.recover(spark, name, path) == 1
    assert table(spark, name) == [("a9", 9), ("b9", 9), ("e9", 9)]
    assert partitions.recover(spark, name, path) == 0


def test_touched_partitions_without_rows_go(spark, parts):
    name, path = parts
    partitions.replace(spark.createDataFrame([("b2", 8, "b")], DDL), name, path, [{"part": "a"}, {"part": "none"}])
    assert table(spark, name) == [("b2", 8), ("c1", 4)]


def test_the_plan_may_read_the_table_it_replaces_and_old_files_go(spark, parts, tmp_path):
    name, path = parts
    for step in range(1, 5):
        older = spark.table(name).where("part = 'a'").withColumn("age", F.col("age") + 1)
        partitions.replace(older, name, path)
        assert table(spark, name) == [("a1", 1 + step), ("a2", 2 + step), ("b1", 3), ("c1", 4)]
    assert len(list((tmp_path / "t").glob("w_*/part=a"))) == 2
    assert len(list((tmp_path / "t").glob("w_*/part=b"))) == 1


def test_only_touched_partitions_are_scanned(spark, parts):
    name, _ = parts
    plan = partitions.within(spark.table(name), [{"part": "a"}])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_two_columns_of_other_types(spark, tmp_path):
    name, path = "parts_two", str(tmp_path / "t")
    made = lambda *r: spark.createDataFrame(list(r), "v int, month int, kind string")
    partitions.create(made((1, 202001, "x"), (2, 202002, "x"), (3, 202002, "y")), name, path, ["month", "kind"])
    partitions.replace_groups(made((2, 202002, "x"), (9, 202002, "y")), name, path, "v")
    assert rows(spark.table(name).select("v", "month", "kind")) == [
        (1, 202001, "x"), (2, 202002, "x"), (3, 202002, "y"), (9, 202002, "y")]
    assert dict(spark.table(name).dtypes)["month"] == "int"


def test_null_partition_values_are_refused(spark, parts):
    name, path = parts
    with pytest.raises(ValueError, match="null"):
        partitions.replace(spark.createDataFrame([("z", 1, None)], DDL), name, path)
    assert len(table(spark, name)) == 4


def test_a_group_with_most_rows(spark, tmp_path):
    """One group holds half of the rows of one partition."""
    name, path = "parts_hot", str(tmp_path / "t")
    all_ = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("name"), F.col("id").cast("int").alias("age"))
    part = layout.key_prefix("name", 1).alias("part")
    partitions.create(all_.select("*", part), name, path, ["part"])
    partitions.replace_groups(spark.createDataFrame([("hot", -1)], "name string, age int").select("*", part), name, path, "name")
    assert spark.table(name).count() == 10_001 and spark.table(name).where("name = 'hot'").count() == 1
