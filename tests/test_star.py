import pytest
from pyspark.sql import functions as F

from starloom.functions.keys import UNKNOWN_KEY
from starloom.operators import bridges, facts, generated, joins, scd2
from starloom.plans import star
from starloom.plans.bindings import BoundEntities
from starloom.plans.recipes import BRIDGES, CODE_DIMENSIONS, ENTITY_DIMENSIONS, GROUP_TABLES
from starloom.registry import star as star_registry
from starloom.registry.base import open_inputs
from starloom.sources.readers import TableSet
from tests.conftest import rows


@pytest.fixture(scope="module")
def enriched(spark, sf_dir):
    return BoundEntities(TableSet(spark, sf_dir))


def test_inventory():
    assert len(CODE_DIMENSIONS) == 12 and len(BRIDGES) == 10
    assert len(GROUP_TABLES) == 10 and len(ENTITY_DIMENSIONS) == 4


def test_bridge_covers_every_encounter_and_uses_known_members(enriched):
    table = "bridge_medication_group"
    b = star.bridge(enriched, table)
    groups = star.group_dimension(enriched, "dim_medication_group")
    assert groups.join(b, "Medication_Group_Key", "leftanti").isEmpty()
    dim = star.code_dimension(enriched, "dim_medications")
    assert b.join(dim, "Medication_Key", "leftanti").isEmpty()
    mixed = b.groupBy("Medication_Group_Key").agg(
        F.max(F.col("Medication_Key") == UNKNOWN_KEY).alias("s"), F.count(F.lit(1)).alias("n"))
    assert mixed.where("s AND n > 1").isEmpty()


def test_children_without_encounter_make_no_group(spark):
    enc = spark.createDataFrame([("e1",), ("e2",)], "ID string")
    kids = spark.createDataFrame([(None, 1), ("e1", 1), ("e1", 1)], "ENCOUNTER string, CODE bigint")
    code = (CODE_DIMENSIONS["dim_care_plans"].attributes[0],)
    b = bridges.bridge(enc, "ID", kids, "ENCOUNTER", code, "g", "m")
    assert b.count() == 2 and b.where(F.col("m") == UNKNOWN_KEY).count() == 1


def test_fact_rows_and_keys(enriched):
    fact = star.encounter_fact(enriched)
    assert fact.count() == enriched["encounters"].count()
    for role, table in [("Patient", "dim_patients"), ("Provider", "dim_providers")]:
        dim = star.entity_dimension(enriched, table)
        assert fact.join(dim, f"{role}_Key", "leftanti").isEmpty()
    late = fact.where("is_late_arriving")
    assert not late.isEmpty()


def test_duration_is_positive_and_minus_one_when_open(spark, enriched):
    enc = enriched["encounters"].limit(1).select(
        "*").withColumn("START", F.lit("2020-01-01 23:00:00").cast("timestamp")).withColumn(
        "STOP", F.lit("2020-01-02 01:00:00").cast("timestamp"))
    dims = star.entity_lookups(enriched)
    row = facts.encounter_fact(enc, dims).first()
    assert (row["Duration"], row["Duration_Seconds"]) == (1, 7200)
    open_row = facts.encounter_fact(
        enc.withColumn("STOP", F.lit(None).cast("timestamp")), dims).first()
    assert (open_row["Duration"], open_row["Duration_Seconds"]) == (-1, -1)
    assert open_row["Stop_Date_Key"] == 99991231


def test_shuffled_lookup_equals_broadcast_lookup(enriched):
    dims = star.entity_lookups(enriched)
    small = star.facts.encounter_fact(enriched["encounters"], dims)
    large = star.facts.encounter_fact(enriched["encounters"], dims, broadcast_limit=0)
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_fact_with_hot_keys_equals_the_plain_fact(enriched, monkeypatch):
    dims = star.entity_lookups(enriched)
    small = star.facts.encounter_fact(enriched["encounters"], dims)
    monkeypatch.setattr(facts, "key_salts", lambda rows, keys: joins.key_salts(rows, keys, 40))
    large = star.facts.encounter_fact(enriched["encounters"], dims, broadcast_limit=0)
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_salted_join_with_one_hot_key(spark):
    left = spark.range(3000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col(
            "id")).alias("k"))
    right = spark.range(0, 3000, 2).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("v"))
    plain = left.join(right, F.col("k") == F.col("rk"), "left")
    salted = joins.lookup_join(left, right, "k", "rk", "n", broadcast_limit=0, rows_per_task=50)
    assert rows(salted) == rows(plain)
    inner = joins.lookup_join(left, right, "k", "rk", "n", "inner", broadcast_limit=0, rows_per_task=50)
    assert rows(inner) == rows(left.join(right, F.col("k") == F.col("rk")))
    assert joins.hot_keys(left, "k").first()[0] == 7


def test_salts_follow_the_rows_of_a_key(spark):
    # one key with half of the rows, fifty with a little less than the target each
    left = spark.range(10_000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 101).alias("k"))
    salts = {r["_hot"]: r["_salts"] for r in joins.key_salts(left, ["k"], 100).collect()}
    assert salts == {"-1": 50}
    right = spark.range(-1, 101).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("v"))
    joined = joins.lookup_join(left, right, "k", "rk", "n", broadcast_limit=0, rows_per_task=100)
    assert rows(joined) == rows(left.join(right, F.col("k") == F.col("rk"), "left"))
    placed = left.join(salts_of(spark, salts), F.col("k").cast("string") == F.col("hot"), "left").groupBy(
        "k", F.pmod(F.xxhash64("n"), F.coalesce("salts", F.lit(1)))).count()
    assert placed.agg(F.max("count")).first()[0] <= 150


def salts_of(spark, salts):
    return spark.createDataFrame(list(salts.items()), "hot string, salts int")


def test_lookup_join_refuses_its_own_column_names(spark):
    left = spark.range(3).select(F.col("id").alias("k"), F.lit(1).alias("_salt"))
    with pytest.raises(ValueError, match="_salt"):
        joins.lookup_join(left, spark.range(3).select(F.col("id").alias("rk")), "k", "rk", "k")


def test_fixed_calendar_and_clock(spark):
    days = generated.date_dimension(spark)
    assert days.count() == 12055
    assert days.where("Date_Key = 99991231").count() == 1
    exclusive = generated.days_between(generated.fixed_bounds(spark), include_end=False)
    assert exclusive.count() == 12053
    clock = generated.time_dimension(spark)
    assert clock.count() == 86400 and clock.select("Time_Key").distinct().count() == 86400
    compat = generated.time_dimension(spark, compat_key=True)
    assert compat.select("Time_Key").distinct().count() == 72050
    crossed = (
        spark.range(24).toDF("h").crossJoin(spark.range(60).toDF("m"))
        .crossJoin(spark.range(60).toDF("s")).selectExpr("CAST(h * 10000 + m * 100 + s AS INT) k"))
    assert crossed.exceptAll(clock.select("Time_Key")).isEmpty()


# --- plans -------------------------------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_the_star_and_pruned_scans(enriched):
    text = plan(star.encounter_fact(enriched))
    assert "Python" not in text and "BroadcastHashJoin" in text
    bridge = plan(star.bridge(enriched, "bridge_allergy_group"))
    assert "LeftAnti" in bridge and "l_extendedprice" not in bridge
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,A)" in bridge


def test_the_fact_scans_each_input_once(enriched):
    dims = star.entity_lookups(enriched)
    wide = facts.encounter_fact(enriched["encounters"], dims, broadcast_limit=0)
    assert plan(wide).count("FileScan") <= 12
    text = plan(star.encounter_fact(enriched))
    assert text.count("BroadcastHashJoin") == 4 and text.count("FileScan") <= 6
    one = star.encounter_fact(enriched, roles=["Patient"])
    assert "Provider_Key" not in one.columns and plan(one).count("BroadcastHashJoin") == 1


def test_current_filter_reaches_the_scan(spark, tmp_path, enriched):
    star.entity_dimension(enriched, "dim_organizations").write.parquet(str(tmp_path / "dim"))
    dim = scd2.current(spark.read.parquet(str(tmp_path / "dim"))).select("Organization_Key")
    text = plan(dim)
    assert "EqualTo(Is_Current,true)" in text
    assert "ReadSchema: struct<Organization_Key:string,Is_Current:boolean>" in text


def test_the_bridges_of_a_refresh_are_tables_of_small_parts(spark, sf_dir):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    inputs = open_inputs(spark, sf_dir)
    for made, plain in zip(star_registry._allergy_bridges(inputs), (None, star.bridge(inputs.enriched, "bridge_allergy_group"))):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan  # read, not made again for every use
        if plain is not None:
            assert rows(made) == rows(plain)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
