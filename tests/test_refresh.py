"""The whole lake from CSV extracts: first load, rerun, second batch."""

import datetime

import pytest
from pyspark.sql import functions as F

from starloom.config import LakeConfig, Layer, load_config
from starloom.functions.keys import UNKNOWN_KEY
from starloom.operators.joins import without_child
from starloom.plans import refresh
from starloom.schemas import RAW_FILES, RAW_LAYOUTS, raw_schema
from starloom.sources import readers

TS, DATE = "2020-03-01 10:00:00", "2020-03-01"


def value(field, n):
    kind = field.dataType.simpleString()
    return {"date": DATE, "timestamp": TS, "bigint": str(n), "double": f"{n}.5"}.get(
        kind, f"{field.name.lower()}{n}")


def write_extract(folder, entity, records):
    schema = raw_schema(entity)
    lines = [",".join(f.name for f in schema.fields)]
    for n, over in records:
        lines.append(",".join(
            over[f.name] if f.name in over else value(f, n) for f in schema.fields))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / RAW_FILES[entity]).write_text("\n".join(lines) + "\n", encoding="utf-8")


def write_batch(folder, city="Rome", with_new_child=False):
    for entity in RAW_LAYOUTS:
        over = {"ENCOUNTER": "e1", "PATIENT": "p1"}
        if entity == "encounters":
            over = {"PATIENT": "p1", "ORGANIZATION": "o1", "PROVIDER": "r1", "PAYER": "y1"}
            write_extract(folder, entity, [(1, {**over, "ID": "e1"}), (2, {**over, "ID": "e2"})])
            continue
        ids = {"patients": "p1", "organizations": "o1", "providers": "r1", "payers": "y1"}
        if entity in ids:
            over = {"ID": ids[entity], "CITY": city, "ZIP": "02134", "ORGANIZATION": "o1"}
        records = [(1, over), (1, over)]
        if with_new_child and "ENCOUNTER" in raw_schema(entity).names:
            records.append((2, {**over, "ENCOUNTER": "e2"}))
        write_extract(folder, entity, records)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    return base, LakeConfig(
        raw_path=str(base / "raw"), enriched=Layer(str(base / "enriched"), "enriched_t"),
        curated=Layer(str(base / "curated"), "curated_t"))


def snapshot(spark, cfg, tables):
    return {t: sorted(map(str, spark.table(refresh.curated_name(cfg, t)).collect())) for t in tables}


def test_three_runs(spark, lake):
    base, cfg = lake
    write_batch(base / "raw")
    built = refresh.load_and_refresh(spark, cfg, "2020-06-01 00:00:00")
    assert len(built) == 2 + 12 + 10 + 4 + 10 + 1
    small = [t for t in built if t not in ("dim_date", "dim_time")]
    first = snapshot(spark, cfg, small)
    assert len(first["fact_encounters"]) == 2
    assert spark.table("enriched_t.enriched_allergies").count() == 1

    # the same extracts again change nothing
    refresh.load_and_refresh(spark, cfg, "2020-07-01 00:00:00")
    assert snapshot(spark, cfg, small) == first

    # a changed city, and the first children of encounter e2
    write_batch(base / "raw", city="Oslo", with_new_child=True)
    refresh.load_and_refresh(spark, cfg, "2020-08-01 00:00:00")
    patients = spark.table("curated_t.dim_patients").where("Patient_Id = 'p1'")
    got = sorted((r["Patient_City"], r["Is_Current"], r["Patient_Zip"]) for r in patients.collect())
    assert got == [("Oslo", True, "02134"), ("Rome", False, "02134")]
    closed = patients.where("NOT Is_Current").first()["Expiration_Date"]
    assert closed == datetime.datetime(2020, 8, 1)
    bridge = spark.table("curated_t.bridge_allergy_group")
    assert bridge.where(F.col("Allergy_Key") == UNKNOWN_KEY).isEmpty() and bridge.count() == 2
    fact = spark.table("curated_t.fact_encounters")
    current = patients.where("Is_Current").first()["Patient_Key"]
    assert fact.count() == 2 and fact.where(F.col("Patient_Key") == current).count() == 2


def test_bucketed_tables_need_no_shuffle_for_the_anti_join(spark, lake, tmp_path):
    base, _ = lake
    cfg = LakeConfig(str(base / "raw"), Layer(str(tmp_path / "e"), "enriched_b"),
                     Layer(str(tmp_path / "c"), "curated_b"))
    refresh.create_databases(spark, cfg)
    for entity in ("encounters", "allergies"):
        refresh.ingest(spark, cfg, entity, "2020-06-01 00:00:00", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.table("enriched_b.enriched_encounters").select("ID").distinct()
        plan = without_child(ids, "ID", spark.table("enriched_b.enriched_allergies"), "ENCOUNTER")
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in text and "Exchange" not in text


def test_malformed_cells_become_null(spark, tmp_path):
    write_extract(tmp_path, "supplies", [(1, {"QUANTITY": "many", "DATE": "not a day"})])
    row = readers.read_extract(spark, str(tmp_path), "supplies").first()
    assert row["QUANTITY"] is None and row["DATE"] is None and row["CODE"] == 1


def test_layouts():
    assert len(RAW_LAYOUTS) == len(RAW_FILES) == 18
    assert [len(raw_schema(e).fields) for e in ("allergies", "claims", "claims_transactions",
                                               "patients", "payers")] == [15, 31, 33, 28, 22]
    assert raw_schema("patients")["ZIP"].dataType.simpleString() == "string"
    assert raw_schema("patients", False)["ZIP"].dataType.simpleString() == "bigint"


def test_job_file(tmp_path):
    path = tmp_path / "job.yaml"
    path.write_text(
        "application: {name: demo}\nspark:\n  config: {spark.x: 1, fs.s3a.secret.key: pw}\n"
        "metastore: {enriched: e, curated: c}\npaths: {raw: r, enriched: ep, curated: cp}\n")
    cfg = load_config(str(path))
    assert cfg.enriched == Layer("ep", "e") and cfg.spark_conf == {"spark.x": "1"}


def test_the_calendar_grows_with_the_encounters(spark):
    from starloom.plans.refresh import calendar_bounds

    def bounds(*spans):
        rows = spark.createDataFrame(list(spans), "START string, STOP string").selectExpr(
            "cast(START AS timestamp) START", "cast(STOP AS timestamp) STOP")
        return calendar_bounds(rows, ("1990-01-01", "2023-01-01"))

    assert bounds(("2000-05-01", "2001-01-01")) == ("1990-01-01", "2023-01-01")
    assert bounds(("1985-05-01", None), ("2024-03-01 10:00:00", "2025-01-02")) == ("1985-01-01", "2026-01-01")
    assert bounds((None, None)) == ("1990-01-01", "2023-01-01")
    assert calendar_bounds(None, ("a", "b")) == ("a", "b")
