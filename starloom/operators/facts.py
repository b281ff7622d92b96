"""The encounter fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from starloom.functions.calendar import date_key, seconds_between, time_key, time_key_half_day
from starloom.functions.defaults import any_present
from starloom.config import fresh_dir
from starloom.functions.keys import group_key, md5_key, surrogate_key, unknown_key
from starloom.operators.generated import OPEN_END, OPEN_END_SQL_TWIN
from starloom.operators.joins import (
    BROADCAST_LIMIT_BYTES, fits_broadcast, key_salts, lookup_join,
)
from starloom.operators.scd2 import current

# Entity roles of an encounter and its ten groups.
ROLES = {
    "Patient": "PATIENT",
    "Organization": "ORGANIZATION",
    "Provider": "PROVIDER",
    "Payer": "PAYER",
}
GROUPS = [
    "Allergy", "Care_Plan", "Condition", "Device", "Imaging_Study",
    "Immunization", "Medication", "Observation", "Procedure", "Supply",
]
MEASURES = {
    "Base_Encounter_Cost": "BASE_ENCOUNTER_COST",
    "Total_Claim_Cost": "TOTAL_CLAIM_COST",
    "Payer_Coverage": "PAYER_COVERAGE",
}
ENCOUNTER_CODE = ["CODE", "ENCOUNTERCLASS", "DESCRIPTION"]
REASON_CODE = ["REASONCODE", "REASONDESCRIPTION"]


def code_key(columns: list[str], make=surrogate_key):
    """Member key where any column is present, else the unknown key."""
    defaults = [F.coalesce(F.col(columns[0]), F.lit(0).cast("bigint"))]
    defaults += [F.coalesce(F.col(c), F.lit("Unknown")) for c in columns[1:]]
    return F.when(any_present(columns), make(defaults)).otherwise(unknown_key())


def with_entity_keys(
    encounters: DataFrame,
    dims: Mapping[str, DataFrame],
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Add ``<Role>_Key`` for each role in ``dims``, and whether some id was not found.

    ``dims`` maps a role to (current) dimension rows. A missing id and an id the dimension
    does not know yet both get the unknown key; only the latter counts as late arriving.
    The frequent ids of all roles are counted in one pass over the encounters, before any join.
    """
    out = encounters.withColumn("is_late_arriving", F.lit(False))
    roles = {role: column for role, column in ROLES.items() if role in dims}
    lookups = {
        role: dims[role].select(
            F.col(f"{role}_Id").alias(f"_{role}_id"), F.col(f"{role}_Key").alias(f"_{role}_key")
        )
        for role in roles
    }
    shuffled = [roles[r] for r, dim in lookups.items() if not fits_broadcast(dim, broadcast_limit)]
    salts = stored(key_salts(encounters, shuffled), "salts") if shuffled else None
    # at most one value per role
    salted = {r["role"] for r in salts.select("role").distinct().collect()} if shuffled else set()
    for role, column in roles.items():
        key, found = f"{role}_Key", f"_{role}_key"
        out = (
            lookup_join(
                out, lookups[role], column, f"_{role}_id", "ID",
                broadcast_limit=broadcast_limit, salts=salts if column in salted else False,
            )
            .withColumn(
                "is_late_arriving",
                F.col("is_late_arriving") | (F.col(column).isNotNull() & F.col(found).isNull()),
            )
            .withColumn(key, F.coalesce(F.col(found), unknown_key()))
            .drop(f"_{role}_id", found)
        )
    return out


def stored(rows: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared folder: the size of a table is known, that of a join or an
    aggregate is guessed."""
    path = fresh_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def encounter_fact(
    encounters: DataFrame,
    dims: Mapping[str, DataFrame],
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    half_day_clock: bool = False,
) -> DataFrame:
    """One row per encounter: keys of four entities, two codes, four calendar roles, ten
    groups, and the measures. ``encounters`` must hold one version per id. ``dims`` may name
    fewer roles where a consumer needs no more."""
    keyed = with_entity_keys(
        encounters, {role: current(dim) for role, dim in dims.items()}, broadcast_limit
    )
    open_end = F.lit(OPEN_END).cast("timestamp")
    start, stop = F.coalesce("START", open_end), F.coalesce("STOP", open_end)
    clock = time_key_half_day if half_day_clock else time_key
    known_span = F.col("START").isNotNull() & F.col("STOP").isNotNull()
    return keyed.select(
        F.col("ID").alias("Encounter_Id"),
        date_key(start).alias("Start_Date_Key"),
        clock(start).alias("Start_Time_Key"),
        date_key(stop).alias("Stop_Date_Key"),
        clock(stop).alias("Stop_Time_Key"),
        *[F.col(f"{role}_Key") for role in ROLES if role in dims],
        code_key(ENCOUNTER_CODE).alias("Encounter_Code_Key"),
        code_key(REASON_CODE).alias("Reason_Code_Key"),
        group_key("ID").alias("_group"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(name) for name, c in MEASURES.items()],
        F.when(known_span, F.datediff("STOP", "START")).otherwise(-1).alias("Duration"),
        F.when(known_span, seconds_between(F.col("START"), F.col("STOP")))
        .otherwise(-1).alias("Duration_Seconds"),
        "is_late_arriving",
    ).select(
        "Encounter_Id", "Start_Date_Key", "Start_Time_Key", "Stop_Date_Key", "Stop_Time_Key",
        *[f"{role}_Key" for role in ROLES if role in dims],
        "Encounter_Code_Key", "Reason_Code_Key",
        *[F.col("_group").alias(f"{g}_Group_Key") for g in GROUPS],
        *MEASURES, "Duration", "Duration_Seconds", "is_late_arriving",
    )


def encounter_fact_decimal(encounters: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """SQL-model twin: MD5 keys, two-digit decimals, duration in seconds, 2100 as open end."""
    keyed = with_entity_keys(encounters, dims)
    open_end = F.lit(OPEN_END_SQL_TWIN).cast("timestamp")
    start, stop = F.coalesce("START", open_end), F.coalesce("STOP", open_end)

    return keyed.select(
        F.col("ID").alias("Encounter_Id"),
        date_key(start).alias("Start_Date_Key"),
        time_key(start).alias("Start_Time_Key"),
        date_key(stop).alias("Stop_Date_Key"),
        time_key(stop).alias("Stop_Time_Key"),
        *[F.col(f"{role}_Key") for role in ROLES],
        code_key(ENCOUNTER_CODE, md5_key).alias("Encounter_Code_Key"),
        code_key(REASON_CODE, md5_key).alias("Reason_Code_Key"),
        *[md5_key(["ID"]).alias(f"{g}_Group_Key") for g in GROUPS],
        *[
            F.coalesce(F.col(c), F.lit(0.0)).cast("decimal(9,2)").alias(name)
            for name, c in MEASURES.items()
        ],
        seconds_between(start, stop).alias("Duration"),
    )
