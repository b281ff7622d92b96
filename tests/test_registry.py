"""Registered queries against their SQL checks, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check_queries import canonical
from starloom.sources.readers import TABLES

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()
CHECKED = [
    "scan_csv_typed", "scan_table", "enriched_fingerprint_strict", "merge_insert_only",
    "merge_upsert", "dim_unknown_member", "dim_observations", "dim_encounter_reason_codes",
    "dim_imaging_studies_md5", "dim_date", "dim_supply_group", "bridge_device_group",
    "bridge_care_plan_group_by_code", "bridge_refresh", "dim_providers", "dim_patients_decimal",
    "scd2_apply_dim_payers", "scd2_as_of_lookup", "scd2_latest_source", "fact_encounters",
    "fact_encounters_decimal", "incr_append", "incr_insert_overwrite", "star_rollup_region_nation",
    "b_file_selection", "b_schema_merge", "b_as_of_merge", "b_grouped_mean", "b_udtf_days",
    "b_stream_session_window", "b_top_ranked", "b_ml_string_indexer", "b_ml_chi_square",
]


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    rel = con.execute(SQL[name])
    columns = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == canonical(rel.fetchall(), columns)


def test_every_check_belongs_to_a_query():
    assert SQL.keys() <= QUERIES.keys()


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1500


def test_registry_needs_no_session_to_be_read():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; print(len(e.queries()) > 200, len(e.oracle_sql()) > 200)"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=60)
    assert done.stdout.strip().endswith("True True")
