from hypothesis import HealthCheck, given, settings, strategies as st

from starloom.functions.keys import UNKNOWN_KEY
from starloom.operators import dedup, merges
from tests.conftest import rows

SCHEMA = "k int, v string"
table = st.dictionaries(st.integers(0, 5), st.sampled_from("abc"), max_size=6)
quick = settings(max_examples=8, deadline=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, d):
    return spark.createDataFrame(sorted(d.items()), SCHEMA)


@quick
@given(t=table, s=table)
def test_insert_only_keeps_the_target_and_is_idempotent(spark, t, s):
    target, source = frame(spark, t), frame(spark, s)
    once = merges.merge_insert_only(target, source, ["k"])
    assert rows(once) == sorted({**s, **t}.items())
    assert rows(merges.merge_insert_only(once, source, ["k"])) == rows(once)


@quick
@given(t=table, s=table)
def test_upsert_lets_the_source_win(spark, t, s):
    once = merges.merge_upsert(frame(spark, t), frame(spark, s), ["k"])
    assert rows(once) == sorted({**t, **s}.items())


def test_insert_only_inserts_a_repeated_new_key_once(spark):
    target = frame(spark, {1: "a"})
    source = spark.createDataFrame([(2, "x"), (2, "x"), (1, "z")], SCHEMA)
    assert rows(merges.merge_insert_only(target, source, ["k"])) == [(1, "a"), (2, "x")]


def pairs(spark, data):
    return spark.createDataFrame(data, "g string, m string")


def test_refresh_drops_the_sentinel_of_a_group_that_got_its_first_child(spark):
    target = pairs(spark, [("g1", UNKNOWN_KEY), ("g2", "m2"), ("g3", UNKNOWN_KEY)])
    source = pairs(spark, [("g1", "m1"), ("g2", "m2"), ("g2", "m3"), ("g3", UNKNOWN_KEY)])
    want = sorted([("g1", "m1"), ("g2", "m2"), ("g2", "m3"), ("g3", UNKNOWN_KEY)])
    once = merges.refresh_bridge(target, source, "g", "m")
    assert rows(once) == want
    assert rows(merges.refresh_bridge(once, source, "g", "m")) == want
    assert rows(merges.stale_sentinels(target, source, "g", "m")) == [
        ("g1", UNKNOWN_KEY), ("g3", UNKNOWN_KEY)]


def test_latest_version_breaks_ties_by_the_last_order_column(spark):
    df = spark.createDataFrame(
        [(1, 10, "a", None), (1, 10, "b", "x"), (2, 5, "c", None), (1, 9, "z", "y")],
        "id int, t int, h string, v string")
    assert rows(dedup.latest_version(df, ["id"], ["t", "h"])) == [
        (1, 10, "b", "x"), (2, 5, "c", None)]


def test_latest_version_combines_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t", "cast(id AS string) AS v")
    plan = dedup.latest_version(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_distinct_by_fingerprint_modes(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a", "b", None)],
                               "x string, y string, z string")
    assert dedup.distinct_by_fingerprint(df).count() == 2
    compat = dedup.distinct_by_fingerprint(df, "compat")
    assert compat.count() == 2 and compat.select("HASH").distinct().count() == 1


def test_upsert_refuses_a_key_twice(spark):
    import pytest

    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (3, "y")], "k int, v string")
    assert rows(merges.merge_upsert(target, source, ["k"])) == [(1, "x"), (2, "b"), (3, "y")]
    twice = source.unionByName(spark.createDataFrame([(1, "z")], "k int, v string"))
    with pytest.raises(Exception, match="a key twice"):
        merges.merge_upsert(target, twice, ["k"]).collect()
