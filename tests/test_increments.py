"""The fact brought up to date by batches equals the fact built whole."""

import pytest
from pyspark.sql import functions as F

from starloom.operators import dedup
from starloom.operators.facts import encounter_fact
from starloom.plans import increments
from starloom.sources import partitions
from tests.conftest import rows

COLUMNS = ("ID string, START timestamp, STOP timestamp, PATIENT string, ORGANIZATION string, PROVIDER string, PAYER string, "
           "CODE bigint, ENCOUNTERCLASS string, DESCRIPTION string, REASONCODE bigint, REASONDESCRIPTION string, "
           "BASE_ENCOUNTER_COST double, TOTAL_CLAIM_COST double, PAYER_COVERAGE double, INGEST_TS timestamp, HASH string")


def encounters(spark, records, batch):
    """(id, start, patient, provider, cost) as one delivery."""
    made = spark.createDataFrame(records, "i string, s string, p string, r string, c double")
    return made.select(
        F.col("i").alias("ID"), F.col("s").cast("timestamp").alias("START"), F.lit(None).cast("timestamp").alias("STOP"),
        F.col("p").alias("PATIENT"), F.lit("o").alias("ORGANIZATION"), F.col("r").alias("PROVIDER"), F.lit("y").alias("PAYER"),
        F.lit(1).cast("bigint").alias("CODE"), F.lit("k").alias("ENCOUNTERCLASS"), F.lit("d").alias("DESCRIPTION"),
        F.lit(None).cast("bigint").alias("REASONCODE"), F.lit(None).cast("string").alias("REASONDESCRIPTION"),
        F.col("c").alias("BASE_ENCOUNTER_COST"), F.col("c").alias("TOTAL_CLAIM_COST"), F.col("c").alias("PAYER_COVERAGE"),
        F.lit(f"2024-01-0{batch}").cast("timestamp").alias("INGEST_TS"), F.concat_ws("|", "i", "s", "p", "r", "c").alias("HASH"))


def dims(spark, patients, providers):
    one = lambda role, ids: spark.createDataFrame(
        [(i, k, True) for i, k in ids.items()], f"{role}_Id string, {role}_Key string, Is_Current boolean")
    return {"Patient": one("Patient", patients), "Provider": one("Provider", providers),
            "Organization": one("Organization", {"o": "O"}), "Payer": one("Payer", {"y": "Y"})}


class Lake:
    def __init__(self, spark, folder, tag):
        self.spark, self.fact, self.notes = spark, f"fact_{tag}", f"notes_{tag}"
        self.at, self.notes_at, self.versions, self.dims = str(folder / "fact"), str(folder / "notes"), None, None

    def load(self, delivery, dims_, changed=None):
        first = self.versions is None
        self.versions, self.dims = delivery if first else self.versions.unionByName(delivery), dims_
        if first:
            increments.build_fact(self.fact, self.at, dedup.latest_version(delivery, ["ID"], increments.VERSION_ORDER), dims_)
            return []
        increments.note(self.notes, self.notes_at, {"Encounter": delivery.select("ID"), **(changed or {})})
        return self.update()

    def update(self):
        notes = increments.noted(self.spark, self.notes)
        months = increments.update_fact(self.fact, self.at, self.versions, self.dims, notes)
        increments.forget(self.spark, self.notes, self.notes_at, notes)
        return months

    def check(self):
        latest = dedup.latest_version(self.versions.where("ID is not null"), ["ID"], increments.VERSION_ORDER)
        whole = increments.with_month(encounter_fact(latest, self.dims))
        assert rows(self.spark.table(self.fact).select(*whole.columns)) == rows(whole)


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def test_three_batches_equal_the_whole_build(spark, tmp_path):
    lake = Lake(spark, tmp_path, "three")
    first = [(f"e{i}", f"2020-{i % 12 + 1:02d}-05", f"p{i % 5}", f"r{i % 3}", 1.0) for i in range(60)]
    patients, providers = {f"p{i}": f"P{i}" for i in range(4)}, {f"r{i}": f"R{i}" for i in range(3)}
    lake.load(encounters(spark, first, 1), dims(spark, patients, providers))
    lake.check()
    # one encounter moves from March to a new month, one is new, one has no start
    moved = [("e2", "2021-07-01", "p2", "r2", 2.0), ("e99", "2020-01-09", "p9", None, 3.0), ("e98", None, None, "r1", 4.0)]
    assert lake.load(encounters(spark, moved, 2), lake.dims) == [202001, 202003, 202107, 999912]
    lake.check()
    # a changed patient, one that arrives late (p4 was unknown), nothing of the encounters
    patients |= {"p0": "P0-new", "p4": "P4"}
    none = encounters(spark, [], 3)
    months = lake.load(none, dims(spark, patients, providers), {"Patient": ids(spark, "p0", "p4", None)})
    assert set(months) == {202000 + i % 12 + 1 for i in range(60) if i % 5 in (0, 4)}
    lake.check()
    # months that lose all rows go
    out = [(f"e{i}", "2022-02-02", "p1", "r1", 5.0) for i in range(60) if i % 12 == 5]
    lake.load(encounters(spark, out, 4), lake.dims)
    lake.check()
    assert not [s for s in partitions._known(spark, lake.fact) if s == (("Start_Month", "202006"),)]
    assert lake.update() == []


def test_a_patient_with_half_of_the_encounters(spark, tmp_path):
    lake = Lake(spark, tmp_path, "hot")
    first = [(f"e{i}", f"2020-{i % 12 + 1:02d}-05", "hot" if i % 2 else f"p{i}", "r", 1.0) for i in range(3000)]
    lake.load(encounters(spark, first, 1), dims(spark, {"hot": "H"}, {"r": "R"}))
    lake.load(encounters(spark, [], 2), dims(spark, {"hot": "H2", "p4": "P4"}, {"r": "R"}), {"Patient": ids(spark, "hot", "p4")})
    lake.check()
    assert spark.table(lake.fact).where("Patient_Key = 'H2'").count() == 1500


def test_only_touched_months_are_read_and_written(spark, tmp_path):
    lake = Lake(spark, tmp_path, "months")
    first = [(f"e{i}", f"2020-{i % 12 + 1:02d}-05", f"p{i}", "r", 1.0) for i in range(120)]
    lake.load(encounters(spark, first, 1), dims(spark, {}, {}))
    before = partitions._places(spark, lake.fact, partitions._known(spark, lake.fact))
    lake.load(encounters(spark, [("e0", "2020-01-05", "p0", "r", 9.0)], 2), lake.dims)
    after = partitions._places(spark, lake.fact, partitions._known(spark, lake.fact))
    assert len(before) == len(after) == 12
    assert [s for s in before if before[s] != after[s]] == [(("Start_Month", "202001"),)]
    plan = increments.untouched_rows(spark, lake.fact, [202001], ids(spark, "e0").toDF("ID"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Start_Month" in text and "202001" in text


def test_a_died_update_is_made_up_for(spark, tmp_path, monkeypatch):
    lake = Lake(spark, tmp_path, "died")
    first = [(f"e{i}", f"2020-{i % 12 + 1:02d}-05", f"p{i}", "r", 1.0) for i in range(24)]
    lake.load(encounters(spark, first, 1), dims(spark, {}, {}))

    def killed(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(partitions, "_switch", killed)
    with pytest.raises(RuntimeError):
        lake.load(encounters(spark, [("e0", "2020-05-05", "p0", "r", 9.0), ("e1", "2020-02-05", "p0", "r", 9.0)], 2), lake.dims)
    monkeypatch.undo()
    lake.load(encounters(spark, [("e3", "2020-04-05", "p0", "r", 7.0)], 3), lake.dims)
    lake.check()


def test_notes_of_later_batches_stay(spark, tmp_path):
    name, at = "notes_later", str(tmp_path)
    increments.note(name, at, {"Patient": ids(spark, "a", "a", None)})
    seen = increments.noted(spark, name)
    increments.note(name, at, {"Payer": ids(spark, "b")})
    increments.forget(spark, name, at, seen)
    assert [(r.role, r.id) for r in spark.table(name).collect()] == [("Payer", "b")]


def test_changed_ids(spark):
    dim = spark.createDataFrame([("a", "A", True), ("b", "B", True), ("a", "A0", False), ("c", "C", True)], "id string, key string, Is_Current boolean")
    members = spark.createDataFrame([("a", "A"), ("b", "B2"), ("d", "D")], "id string, key string")
    assert rows(increments.changed_ids(dim, members, "id", "key")) == [("b",), ("d",)]
