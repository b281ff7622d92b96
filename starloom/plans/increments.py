"""Incremental maintenance of the encounter fact.

What may change a fact row is its encounter's latest version and the current versions of the
four entities it names. Loads and refreshes therefore note the ids that changed in a small table
(role, id, batch) before they change anything. An update of the fact looks up which encounters
the noted ids touch, takes the versions of just those, and writes the months anew in which any
of their versions starts, which is where their rows were or will be; other months are neither
read nor written. Notes go only after the fact is complete, so a job that dies is made up for by
the next one, and noting an id too much costs time but no correctness.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.functions.calendar import date_key
from starloom.operators import dedup
from starloom.operators.facts import ROLES, encounter_fact, stored
from starloom.operators.generated import OPEN_END
from starloom.operators.joins import fits_broadcast
from starloom.operators.scd2 import current
from starloom.sources import partitions, sinks

ENCOUNTER, MONTH = "Encounter", "Start_Month"
VERSION_ORDER = ["INGEST_TS", "HASH"]
FILES_OF_A_MONTH = 8
_NOTES = "role string, id string, batch string"


# --- notes -------------------------------------------------------------------------------

def note(name: str, base_path: str, ids: Mapping[str, DataFrame], fmt: str = "parquet") -> None:
    """Note changed ids, one column each, by role (``Encounter`` or an entity's role)."""
    batch = uuid.uuid4().hex
    for role, rows in ids.items():
        noted = rows.toDF("id").where("id is not null").distinct().select(
            F.lit(role).alias("role"), F.col("id").cast("string").alias("id"), F.lit(batch).alias("batch"))
        if sinks.table_exists(rows.sparkSession, name):
            sinks.append(noted, name)
        else:
            sinks.create_or_replace(noted, name, base_path, fmt)


def noted(spark: SparkSession, name: str) -> DataFrame:
    """The notes as they are now, in files of their own."""
    rows = spark.table(name) if sinks.table_exists(spark, name) else spark.createDataFrame([], _NOTES)
    return stored(rows, "notes")


def forget(spark: SparkSession, name: str, base_path: str, done: DataFrame, fmt: str = "parquet") -> None:
    """Drop the notes of the batches in ``done``; later ones stay."""
    if sinks.table_exists(spark, name):
        batches = [r["batch"] for r in done.select("batch").distinct().collect()]  # a few per refresh
        sinks.create_or_replace(spark.table(name).where(~F.col("batch").isin(batches)), name, base_path, fmt)


def changed_ids(dim: DataFrame, members: DataFrame, natural_id: str, key: str) -> DataFrame:
    """Ids whose current key will be another: changed ones and new ones."""
    now = current(dim).select(F.col(natural_id).alias("_id"), F.col(key).alias("_key"))
    same = (F.col(natural_id) == F.col("_id")) & (F.col(key) == F.col("_key"))
    return members.join(now, same, "leftanti").select(natural_id)


# --- the fact ----------------------------------------------------------------------------

def start_month(start: Column) -> Column:
    """The month an encounter is filed under: yyyymm of its start."""
    return F.floor(date_key(F.coalesce(start, F.lit(OPEN_END).cast("timestamp"))) / 100).cast("int")


def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn(MONTH, F.floor(F.col("Start_Date_Key") / 100).cast("int"))


def build_fact(name: str, base_path: str, encounters: DataFrame, dims: Mapping[str, DataFrame], fmt: str = "parquet") -> None:
    """The whole fact, filed by month; ``encounters`` holds one version per id."""
    partitions.create(_filed(with_month(encounter_fact(encounters, dims))), name, base_path, [MONTH], fmt)


def _filed(rows: DataFrame) -> DataFrame:
    """The files of a month come from a few tasks, also where one month has most of the rows."""
    return rows.repartition(F.col(MONTH), F.pmod(F.xxhash64("Encounter_Id"), F.lit(FILES_OF_A_MONTH)))


def touched_encounters(versions: DataFrame, notes: DataFrame) -> DataFrame:
    """(ID): encounters that are noted or of which some version names a noted entity.

    One pass over five narrow columns. Notes of a size to broadcast leave the encounters where
    they are; else pairs of role and id are shuffled, and adaptive execution splits hot ones.
    """
    roles = {ENCOUNTER: "ID", **ROLES}
    pairs = F.array(*[F.struct(F.lit(r).alias("role"), F.col(c).cast("string").alias("named")) for r, c in roles.items()])
    named = versions.select("ID", F.explode(pairs).alias("p")).select("ID", "p.role", "p.named")
    asked = notes.select("role", F.col("id").alias("named")).distinct()
    if fits_broadcast(notes):
        asked = F.broadcast(asked)
    return named.join(asked, ["role", "named"], "leftsemi").select("ID").where("ID is not null").distinct()


def update_fact(name: str, base_path: str, versions: DataFrame, dims: Mapping[str, DataFrame], notes: DataFrame, fmt: str = "parquet") -> list[int]:
    """Bring the fact up to date with the noted ids; the months that were written.

    ``versions`` holds every stored version of the encounters, ``dims`` the dimensions after
    their own refresh.
    """
    spark = versions.sparkSession
    ids = stored(touched_encounters(versions, notes), "touched")
    hint = F.broadcast if fits_broadcast(ids) else (lambda df: df)
    mine = stored(versions.join(hint(ids), "ID", "leftsemi"), "versions")
    months = [r[0] for r in mine.select(start_month(F.col("START"))).distinct().collect()]  # of the calendar
    if not months:
        partitions.recover(spark, name, base_path)
        return []
    latest = dedup.latest_version(mine, ["ID"], VERSION_ORDER)
    rows = with_month(encounter_fact(latest, dims))
    kept = untouched_rows(spark, name, months, ids)
    partitions.replace(_filed(rows.select(*kept.columns).unionByName(kept)), name, base_path, [{MONTH: m} for m in months], fmt)
    return sorted(months)


def untouched_rows(spark: SparkSession, name: str, months: list[int], ids: DataFrame) -> DataFrame:
    """Stored fact rows of the months whose encounters are not touched."""
    held = partitions.within(spark.table(name), [{MONTH: m} for m in months])
    return held.join(ids.withColumnRenamed("ID", "_touched"), F.col("Encounter_Id") == F.col("_touched"), "leftanti")
