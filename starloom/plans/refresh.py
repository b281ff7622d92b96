"""Load raw extracts into the enriched layer and refresh the star from it.

Every step is safe to repeat: increments are anti-joined against what is stored, and
replaced tables switch location only after their files are complete. The fact is brought up to
date by ``increments``: only the months that changed ids touch are written.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.config import LakeConfig, fresh_dir
from starloom.operators import dedup, generated, merges, scd2
from starloom.plans import increments, star
from starloom.plans.recipes import BRIDGES, CODE_DIMENSIONS, ENTITY_DIMENSIONS, GROUP_TABLES
from starloom.schemas import RAW_FILES, RAW_LAYOUTS
from starloom.sources import partitions, readers, sinks

# Entities whose rows are versions of an id; the others are plain event rows.
VERSIONED = ["encounters", "organizations", "patients", "payers", "providers"]
PARALLEL_WRITES = 4
FACT, NOTES = "fact_encounters", "fact_changes"
_NOTING = Lock()


def enriched_name(cfg: LakeConfig, entity: str) -> str:
    return f"{cfg.enriched.database}.enriched_{entity}"


def curated_name(cfg: LakeConfig, table: str) -> str:
    return f"{cfg.curated.database}.{table}"


def create_databases(spark: SparkSession, cfg: LakeConfig) -> None:
    for layer in (cfg.enriched, cfg.curated):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer.database}")


def ingest(
    spark: SparkSession, cfg: LakeConfig, entity: str, batch_time, mode: str = "strict",
    buckets: int = 0,
) -> None:
    """Raw extract to enriched table, insert-only on the fingerprint.

    ``buckets`` keeps the table bucketed on its encounter column, so that the bridges'
    distinct and anti joins need no shuffle.
    """
    raw = readers.read_extract(spark, cfg.raw_path, entity)
    rows = dedup.distinct_by_fingerprint(raw, mode).withColumn(
        "INGEST_TS", scd2.instant(batch_time)
    )
    name = enriched_name(cfg, entity)
    if sinks.table_exists(spark, name):
        delta = merges.insert_only_delta(spark.table(name), rows, ["HASH"])
        if entity == "encounters" and sinks.table_exists(spark, curated_name(cfg, FACT)):
            delta = staged(delta, "delta")
            _note(cfg, {increments.ENCOUNTER: delta.select("ID")})
        sinks.append(delta, name)
        return
    column = "ID" if entity == "encounters" else "ENCOUNTER"
    bucket_by = (buckets, column) if buckets and column in raw.columns else None
    sinks.create_or_replace(
        rows, name, f"{cfg.enriched.path}/enriched_{entity}", cfg.table_format, bucket_by
    )


def _note(cfg: LakeConfig, ids: dict[str, DataFrame]) -> None:
    increments.note(curated_name(cfg, NOTES), f"{cfg.curated.path}/{NOTES}", ids, cfg.table_format)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Rows computed once and kept in the shared folder for the many steps that read them."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def enriched_tables(spark: SparkSession, cfg: LakeConfig) -> dict[str, DataFrame]:
    """Enriched relations, entities reduced to their latest version, once per refresh."""
    tables = {}
    for entity in RAW_FILES:
        name = enriched_name(cfg, entity)
        if not sinks.table_exists(spark, name):
            continue
        df = spark.table(name)
        if entity in VERSIONED:
            df = staged(
                dedup.latest_version(
                    df.where(F.col("ID").isNotNull()), ["ID"], ["INGEST_TS", "HASH"]
                ),
                entity,
            )
        tables[entity] = df
    return tables


def _put_insert_only(spark, cfg, table: str, rows: DataFrame, keys: list[str]) -> None:
    name = curated_name(cfg, table)
    if sinks.table_exists(spark, name):
        sinks.append(merges.insert_only_delta(spark.table(name), rows, keys), name)
    else:
        _replace(cfg, table, rows)


def _replace(cfg, table: str, rows: DataFrame) -> None:
    sinks.create_or_replace(
        rows, curated_name(cfg, table), f"{cfg.curated.path}/{table}", cfg.table_format
    )


def _put_entity(spark, cfg, table: str, enriched, as_of) -> None:
    name = curated_name(cfg, table)
    if not sinks.table_exists(spark, name):
        _replace(cfg, table, star.entity_dimension(enriched, table))
        return
    r, dim = ENTITY_DIMENSIONS[table], spark.table(name)
    members = staged(star.entity_members(enriched, table), f"{table}-members")
    changed = staged(increments.changed_ids(dim, members, r.natural_id, r.key), f"{table}-changed")
    if changed.isEmpty():
        return
    role = next(role for role, of in star.ROLE_TABLES.items() if of == table)
    with _NOTING:  # one writer of the notes at a time
        _note(cfg, {role: changed})
    _replace(cfg, table, scd2.apply_changes(dim, members, r.natural_id, r.key, as_of))


def _put_bridge(spark, cfg, table: str, enriched) -> None:
    """Real pairs only ever grow, so they are appended; the sentinels are replaced.

    They live in two tables under one view. A refresh therefore never rewrites the real
    pairs to delete a few sentinels among them.
    """
    b = BRIDGES[table]
    real_name, sentinel_name = f"{table}_members", f"{table}_sentinels"
    real, sentinel = star.bridge_parts(enriched, table)
    stored = curated_name(cfg, sentinel_name)
    _put_insert_only(spark, cfg, real_name, real, [b.group, b.member])
    if sinks.table_exists(spark, stored):
        known = star.bridge_groups(enriched, table)
        untouched = spark.table(stored).join(known, b.group, "leftanti")
        sentinel = sentinel.unionByName(untouched.select(*sentinel.columns))
    _replace(cfg, sentinel_name, sentinel)
    spark.sql(
        f"CREATE OR REPLACE VIEW {curated_name(cfg, table)} AS "
        f"SELECT {b.group}, {b.member} FROM {curated_name(cfg, real_name)} UNION ALL "
        f"SELECT {b.group}, {b.member} FROM {stored}"
    )


def _put_fact(spark, cfg, enriched) -> None:
    dims = {
        role: spark.table(curated_name(cfg, f"dim_{entity}"))
        for role, entity in [
            ("Patient", "patients"), ("Organization", "organizations"),
            ("Provider", "providers"), ("Payer", "payers"),
        ]
    }
    name, path = curated_name(cfg, FACT), f"{cfg.curated.path}/{FACT}"
    notes = increments.noted(spark, curated_name(cfg, NOTES))
    if sinks.table_exists(spark, name) and not partitions.partition_columns(spark, name):
        spark.sql(f"DROP TABLE {name}")  # of an older layout: built anew, once
    if not sinks.table_exists(spark, name):
        increments.build_fact(name, path, enriched["encounters"], dims, cfg.table_format)
    else:
        versions = spark.table(enriched_name(cfg, "encounters"))
        increments.update_fact(name, path, versions, dims, notes, cfg.table_format)
    increments.forget(spark, curated_name(cfg, NOTES), f"{cfg.curated.path}/{NOTES}", notes, cfg.table_format)


def calendar_bounds(encounters: DataFrame | None, calendar: tuple[str, str]) -> tuple[str, str]:
    """``calendar``, stretched to the whole years the encounters touch."""
    if encounters is None:
        return calendar
    span = encounters.agg(
        F.min(F.least("START", "STOP")).alias("a"), F.max(F.greatest("START", "STOP")).alias("z")
    ).select(F.date_format(F.trunc("a", "year"), "yyyy-MM-dd").alias("a"),
             F.date_format(F.add_months(F.trunc("z", "year"), 12), "yyyy-MM-dd").alias("z")).first()
    return min(calendar[0], span["a"] or calendar[0]), max(calendar[1], span["z"] or calendar[1])


def refresh_star(
    spark: SparkSession, cfg: LakeConfig, as_of,
    calendar: tuple[str, str] = (generated.CALENDAR_START, generated.CALENDAR_END),
) -> list[str]:
    """All dimensions, groups and bridges, then the fact. One writer per table.

    The calendar covers ``calendar`` at least and grows with the encounters.
    """
    enriched = enriched_tables(spark, cfg)
    first, last = calendar_bounds(enriched.get("encounters"), calendar)
    steps = [
        lambda: _put_insert_only(
            spark, cfg, "dim_date", generated.date_dimension(spark, first, last), ["Date_Key"]),
        lambda: sinks.build_once(
            generated.time_dimension(spark), curated_name(cfg, "dim_time"),
            f"{cfg.curated.path}/dim_time", cfg.table_format),
    ]
    built = ["dim_date", "dim_time"]
    for table, r in CODE_DIMENSIONS.items():
        if r.entity in enriched:
            steps.append(lambda t=table, k=r.key: _put_insert_only(
                spark, cfg, t, star.code_dimension(enriched, t), [k]))
            built.append(table)
    for table, group in GROUP_TABLES.items():
        steps.append(lambda t=table, g=group: _put_insert_only(
            spark, cfg, t, star.group_dimension(enriched, t), [g]))
        built.append(table)
    for table in ENTITY_DIMENSIONS:
        steps.append(lambda t=table: _put_entity(spark, cfg, t, enriched, as_of))
        built.append(table)
    for table, b in BRIDGES.items():
        if b.entity in enriched:
            steps.append(lambda t=table: _put_bridge(spark, cfg, t, enriched))
            built.append(table)
    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()
    _put_fact(spark, cfg, enriched)
    return [*built, FACT]


def load_and_refresh(
    spark: SparkSession, cfg: LakeConfig, batch_time, entities=None, buckets: int = 0,
    calendar: tuple[str, str] = (generated.CALENDAR_START, generated.CALENDAR_END),
) -> list[str]:
    """One full run for one batch of raw extracts."""
    create_databases(spark, cfg)
    for entity in entities or RAW_LAYOUTS:
        ingest(spark, cfg, entity, batch_time, buckets=buckets)
    return refresh_star(spark, cfg, batch_time, calendar)
