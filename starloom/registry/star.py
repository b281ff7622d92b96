"""Ingestion, dimensions, bridges, fact, increments: the star on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.config import fresh_dir
from starloom.functions.defaults import default_member, null_defaulted
from starloom.functions.keys import UNKNOWN_KEY, fingerprint, group_key, md5_key
from starloom.operators import bridges, dedup, facts, generated, layout, merges, scd2
from starloom.operators.joins import without_child
from starloom.plans import increments, star
from starloom.plans.bindings import binding_sql
from starloom.plans.recipes import (
    BRIDGES, CODE_DIMENSIONS, ENTITY_DIMENSIONS, GROUP_TABLES,
)
from starloom.registry import check_sql as chk
from starloom.registry.base import Inputs, Registry
from starloom.schemas import RAW_FILES
from starloom.sources import partitions, readers, sinks
from starloom.streaming.runner import settings

REGISTRY = Registry()
query = REGISTRY.query

AS_OF = "2020-06-01 00:00:00"
ENCOUNTERS = binding_sql("encounters")


# --- scans and ingestion -----------------------------------------------------------------

ORDER_ROWS = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders"
)


@query(ORDER_ROWS)
def scan_csv_typed(x: Inputs):
    """Write the orders as a headered CSV folder and read them back with a fixed schema."""
    orders = x.tables["orders"]
    path = fresh_dir(x.spark, "orders_csv")
    orders.write.option("header", True).csv(path)
    return readers.read_csv_typed(x.spark, path, orders.schema)


@query(ORDER_ROWS)
def scan_table(x: Inputs):
    """Register the orders as an external table and read it by catalog name."""
    path = fresh_dir(x.spark, "orders_table")
    name = f"starloom_scan_{path.rsplit('-', 1)[-1]}"
    sinks.create_or_replace(x.tables["orders"], name, path)
    return readers.read_table(x.spark, name)


@query("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def exact_dedup(x: Inputs):
    return dedup.distinct_rows(
        x.tables["lineitem"].select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    )


EVENT_COLS = ["event_id", "user_id", "event_type", "props"]


@query(
    "SELECT DISTINCT event_id, user_id, event_type, props, "
    "concat_ws('|', event_id, user_id, event_type, props) AS HASH FROM events"
)
def enriched_fingerprint(x: Inputs):
    return dedup.distinct_by_fingerprint(x.tables["events"].select(*EVENT_COLS), "compat")


def _strict_sql(columns) -> str:
    parts = ", ".join(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')"
        for c in columns
    )
    return f"sha256(concat_ws('|', {parts}))"


ALLERGY_COLS = ["ENCOUNTER", "CODE", "DESCRIPTION", "SYSTEM"]


@query(
    f"SELECT DISTINCT {', '.join(ALLERGY_COLS)}, {_strict_sql(ALLERGY_COLS)} AS HASH "
    f"FROM ({binding_sql('allergies')}) a"
)
def enriched_fingerprint_strict(x: Inputs):
    return dedup.distinct_by_fingerprint(x.enriched["allergies"].select(*ALLERGY_COLS))


def _extract(x: Inputs, entity: str):
    """One extract: written as the headered file it arrives as, read with its layout, and
    reduced to distinct rows with their fingerprint."""
    from starloom.plans.extracts import extract_sql

    path = fresh_dir(x.spark, f"extract_{entity}")
    sinks.write_extract(x.tables.sql(extract_sql(entity)), path, entity)
    return dedup.distinct_by_fingerprint(readers.read_extract(x.spark, path, entity), packed=True)


def _extract_check(entity: str) -> str:
    from starloom.plans.extracts import columns, extract_check

    names = [name for name, _ in columns(entity)]
    shown = ", ".join(
        f"CAST({n} AS VARCHAR) AS {n}" if kind in ("date", "timestamp") else n
        for n, kind in columns(entity))
    return f"SELECT DISTINCT {shown}, {_strict_sql(names)} AS HASH FROM ({extract_check(entity)}) e"


for _entity in RAW_FILES:
    REGISTRY.add(f"enriched_{_entity}", lambda x, e=_entity: _extract(x, e), _extract_check(_entity))


@query(
    f"SELECT count(*) AS all_rows, count(DISTINCT concat_ws('|', {', '.join(ALLERGY_COLS)})) "
    f"AS compat_keys, count(DISTINCT {_strict_sql(ALLERGY_COLS)}) AS strict_keys "
    f"FROM (SELECT DISTINCT * FROM ({binding_sql('allergies')}) a) d"
)
def fingerprint_collisions(x: Inputs):
    """How many rows each fingerprint mode tells apart."""
    rows = dedup.distinct_rows(x.enriched["allergies"].select(*ALLERGY_COLS))
    return rows.select(
        fingerprint(ALLERGY_COLS, "compat").alias("c"), fingerprint(ALLERGY_COLS).alias("s")
    ).agg(
        F.count(F.lit(1)).alias("all_rows"),
        F.countDistinct("c").alias("compat_keys"),
        F.countDistinct("s").alias("strict_keys"),
    )


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query(f"SELECT {', '.join(ORDER_COLS)}, {_strict_sql(ORDER_COLS)} AS HASH FROM orders")
def merge_insert_only(x: Inputs):
    """Second delivery holds every order; only those unknown to the first are inserted."""
    orders = dedup.distinct_by_fingerprint(x.tables["orders"].select(*ORDER_COLS))
    return merges.merge_insert_only(orders.where("o_orderstatus <> 'P'"), orders, ["HASH"])


@query(
    "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN 'CLOSED' ELSE "
    "o_orderpriority END AS o_orderpriority FROM orders"
)
def merge_upsert(x: Inputs):
    orders = x.tables["orders"].select("o_orderkey", "o_orderstatus", "o_orderpriority")
    target = orders.where("o_orderstatus <> 'P'")
    source = orders.where("o_orderstatus <> 'F'").withColumn(
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "O", "CLOSED").otherwise(F.col("o_orderpriority")),
    )
    return merges.merge_upsert(target, source, ["o_orderkey"])


# --- code dimensions ---------------------------------------------------------------------

_ENCOUNTER_ATTRS = CODE_DIMENSIONS["dim_encounter_codes"].attributes


@query(f"SELECT ID, {chk.defaulted(_ENCOUNTER_ATTRS)} FROM ({ENCOUNTERS}) e")
def null_default_projection(x: Inputs):
    return x.enriched["encounters"].select("ID", *null_defaulted(_ENCOUNTER_ATTRS))


@query(
    f"SELECT '{UNKNOWN_KEY}' AS Encounter_Code_Key, CAST(0 AS BIGINT) AS Encounter_Code, "
    "'Unknown' AS Encounter_Class, 'Unknown' AS Encounter_Description, count(*) AS encounters "
    f"FROM ({ENCOUNTERS}) e WHERE CODE IS NULL AND ENCOUNTERCLASS IS NULL "
    "AND DESCRIPTION IS NULL"
)
def dim_unknown_member(x: Inputs):
    """The unknown member with the number of encounters that fall to it."""
    r = CODE_DIMENSIONS["dim_encounter_codes"]
    falls = (
        x.enriched["encounters"]
        .select(facts.code_key(facts.ENCOUNTER_CODE).alias(r.key))
        .groupBy(r.key)
        .agg(F.count(F.lit(1)).alias("encounters"))
    )
    return default_member(x.spark, r.key, UNKNOWN_KEY, r.attributes).join(falls, r.key)


for _table in CODE_DIMENSIONS:
    REGISTRY.add(
        _table, lambda x, t=_table: star.code_dimension(x.enriched, t), chk.code_dimension(_table)
    )
    REGISTRY.add(
        f"{_table}_md5",
        lambda x, t=_table: star.code_dimension(x.enriched, t, "md5"),
        chk.code_dimension(_table, "md5"),
    )


@query(
    f"SELECT DISTINCT {chk.code_key(['CODE', 'ENCOUNTERCLASS', 'DESCRIPTION'])} AS k FROM "
    f"({ENCOUNTERS}) e WHERE CODE IS NOT NULL OR ENCOUNTERCLASS IS NOT NULL "
    "OR DESCRIPTION IS NOT NULL"
)
def dim_code_any_present(x: Inputs):
    """Only keys of members with at least one known attribute, no unknown member."""
    from starloom.operators.dimensions import members

    r = CODE_DIMENSIONS["dim_encounter_codes"]
    rows = members(x.enriched["encounters"], r.key, r.attributes, require_any=True)
    return rows.select(F.col(r.key).alias("k")).distinct()


@query("SELECT DISTINCT upper(md5(concat_ws('|', p_brand, p_type, p_size))) AS part_key, "
       "p_brand, p_type, p_size FROM part")
def key_md5_upper(x: Inputs):
    part = x.tables["part"].select("p_brand", "p_type", "p_size").distinct()
    return part.select(md5_key(part.columns).alias("part_key"), "*")


# --- generated dimensions ----------------------------------------------------------------

_DATE_SQL = """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS Date_Key, CAST(d AS VARCHAR) AS Date,
        year(d) AS Year, month(d) AS Month_Number, strftime(d, '%b') AS Month_Name_Short,
        strftime(d, '%B') AS Month_Name_Long, dayofweek(d) + 1 AS Day_Of_Week_Number,
        strftime(d, '%A') AS Day_Of_Week, strftime(d, '%a') AS Day_Of_Week_Short,
        quarter(d) AS quarter, year(d) || '{q}' || quarter(d) AS Year_Quarter,
        CAST(last_day(d) AS VARCHAR) AS {last}
    FROM (SELECT CAST(unnest(generate_series(
            (SELECT min(o_orderdate) FROM orders), (SELECT max({end}) FROM {src}),
            INTERVAL 1 DAY)) AS DATE) AS d UNION ALL SELECT DATE '{open_end}') days
"""


def _calendar_bounds(x: Inputs, end_table: str, end_column: str):
    """First order day and last day of the given column; two map-side combined aggregates."""
    first = x.tables["orders"].agg(F.min("o_orderdate").cast("date").alias("start"))
    last = x.tables[end_table].agg(F.max(end_column).cast("date").alias("end"))
    return first.withColumn("end", last.scalar())


@query(_DATE_SQL.format(q="_Q", last="End_Of_Month", end="l_shipdate", src="lineitem",
                        open_end="9999-12-31"))
def dim_date(x: Inputs):
    """Calendar over the days the tables span, end included, plus the open-end day."""
    days = generated.days_between(_calendar_bounds(x, "lineitem", "l_shipdate"))
    return generated.calendar(generated.with_open_end(days))


@query(_DATE_SQL.format(q="_", last="last_date", open_end="2100-01-01", src="lineitem",
                        end="l_shipdate").replace(
    "max(l_shipdate)", "max(l_shipdate) - INTERVAL 1 DAY"))
def dim_date_spine_exclusive(x: Inputs):
    """SQL-model twin: the spine stops one day before its end date."""
    days = generated.days_between(_calendar_bounds(x, "lineitem", "l_shipdate"), False)
    return generated.calendar_sql_twin(
        generated.with_open_end(days, generated.OPEN_END_SQL_TWIN)
    )


_CLOCK_SQL = f"""
    WITH c AS (SELECT i, i // 3600 AS h, i % 3600 // 60 AS m, i % 60 AS s
               FROM (SELECT unnest(range(86400)) AS i) r),
    n AS (SELECT strftime(START, '%H:%M:%S') AS t, count(*) AS n
          FROM ({ENCOUNTERS}) e GROUP BY 1)
    SELECT KEY AS Time_Key, lpad(h::VARCHAR, 2, '0') || ':' || lpad(m::VARCHAR, 2, '0') || ':'
            || lpad(s::VARCHAR, 2, '0') AS Time, h AS Hour, m AS Minute, s AS Second,
        coalesce(n.n, 0) AS encounters
    FROM c LEFT JOIN n ON n.t = lpad(h::VARCHAR, 2, '0') || ':' || lpad(m::VARCHAR, 2, '0')
        || ':' || lpad(s::VARCHAR, 2, '0')
"""


def _clock(x: Inputs, compat_key: bool):
    """The clock with the number of encounters that start in each second."""
    starts = (
        x.enriched["encounters"]
        .groupBy(F.date_format("START", "HH:mm:ss").alias("Time"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        generated.time_dimension(x.spark, compat_key)
        .join(starts, "Time", "left")
        .select("Time_Key", "Time", "Hour", "Minute", "Second",
                F.coalesce("n", F.lit(0)).alias("encounters"))
    )


REGISTRY.add("dim_time", lambda x: _clock(x, False),
             _CLOCK_SQL.replace("KEY AS", "h * 10000 + m * 100 + s AS"))
REGISTRY.add("dim_time_compat", lambda x: _clock(x, True),
             _CLOCK_SQL.replace("KEY AS", "CAST(concat(h, m, s) AS INTEGER) AS"))


# --- groups and bridges ------------------------------------------------------------------

for _table, _group in GROUP_TABLES.items():
    REGISTRY.add(
        _table, lambda x, t=_table: star.group_dimension(x.enriched, t),
        f"SELECT DISTINCT sha256(ID) AS {_group} FROM ({ENCOUNTERS}) e",
    )
    REGISTRY.add(
        f"{_table}_md5", lambda x, t=_table: star.group_dimension(x.enriched, t, "md5"),
        f"SELECT DISTINCT upper(md5(ID)) AS {_group} FROM ({ENCOUNTERS}) e",
    )
for _table in BRIDGES:
    REGISTRY.add(_table, lambda x, t=_table: star.bridge(x.enriched, t), chk.bridge(_table))
    REGISTRY.add(
        f"{_table}_by_code", lambda x, t=_table: star.bridge_by_code(x.enriched, t),
        chk.bridge_by_code(_table),
    )


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def encounters_without_child(x: Inputs):
    return without_child(
        x.tables["orders"].select("o_orderkey"), "o_orderkey", x.tables["lineitem"], "l_orderkey"
    )


_ALLERGY = BRIDGES["bridge_allergy_group"]
_EARLY = binding_sql("allergies") + " AND l_shipdate < TIMESTAMP '1998-01-01 00:00:00'"


# keys and texts of pairs shrink much in files and shuffles, so their parts are kept small
SMALL_PARTS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m", "spark.sql.files.maxPartitionBytes": "32m"}


def _allergy_bridges(x: Inputs):
    """The allergy bridge after an early delivery, and the one of everything known now."""
    from starloom.plans.bindings import BINDINGS

    early = x.tables.sql(
        BINDINGS["allergies"] + " AND l_shipdate < TIMESTAMP '1998-01-01 00:00:00'"
    )
    b = _ALLERGY
    args = ("ENCOUNTER", b.attributes, b.group, b.member)
    target = bridges.bridge(x.enriched["encounters"], "ID", early, *args)
    # tables, as they are in a refresh: no task holds the making of a bridge and its mutation
    with settings(x.spark, SMALL_PARTS):
        return facts.stored(target, "target"), facts.stored(star.bridge(x.enriched, b.table), "source")


@query(f"""
    WITH t AS ({chk.bridge(_ALLERGY.table, _EARLY)}), s AS ({chk.bridge(_ALLERGY.table)})
    SELECT * FROM t WHERE Allergy_Key = '{UNKNOWN_KEY}'
        AND Allergy_Group_Key IN (SELECT Allergy_Group_Key FROM s)""")
def bridge_stale_sentinels(x: Inputs):
    target, source = _allergy_bridges(x)
    return merges.stale_sentinels(target, source, _ALLERGY.group, _ALLERGY.member)


@query(f"""
    WITH t AS ({chk.bridge(_ALLERGY.table, _EARLY)}), s AS ({chk.bridge(_ALLERGY.table)}),
    kept AS (SELECT * FROM t WHERE NOT (Allergy_Key = '{UNKNOWN_KEY}'
        AND Allergy_Group_Key IN (SELECT Allergy_Group_Key FROM s)))
    SELECT * FROM kept UNION SELECT * FROM s""")
def bridge_refresh(x: Inputs):
    target, source = _allergy_bridges(x)
    return merges.refresh_bridge(target, source, _ALLERGY.group, _ALLERGY.member)


# --- entity dimensions with history ------------------------------------------------------

for _table in ENTITY_DIMENSIONS:
    REGISTRY.add(
        _table, lambda x, t=_table: star.entity_dimension(x.enriched, t),
        f"SELECT {chk.entity_columns(_table)} FROM ({chk.entity_first_load(_table)}) f",
    )
    REGISTRY.add(
        f"scd2_apply_{_table}",
        lambda x, t=_table: star.entity_refresh(
            star.entity_dimension(x.enriched, t), x.second, t, AS_OF),
        f"SELECT {chk.entity_columns(_table)} FROM ({chk.entity_after_refresh(_table, AS_OF)}) h",
    )
    _decimals = star.decimal_attributes(ENTITY_DIMENSIONS[_table])
    _key = ENTITY_DIMENSIONS[_table].key
    REGISTRY.add(
        f"{_table}_decimal",
        lambda x, t=_table: star.entity_dimension_decimal(x.enriched, t),
        f"SELECT {', '.join([_key, *[chk.shown(a.name, a.dtype) for a in _decimals]])} FROM ("
        f"{chk.entity_members(_table, False, _decimals, 'md5')} UNION ALL "
        f"{chk.unknown(_key, _decimals)}) u",
    )


@query("""
    SELECT user_id, event_id, CAST(date_trunc('second', ts) AS VARCHAR) AS ts, event_type, value
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
          FROM events) e WHERE r = 1""")
def scd2_latest_source(x: Inputs):
    """Events as versions of their user: the latest per user."""
    events = x.tables["events"].select("user_id", "event_id", "ts", "event_type", "value")
    latest = dedup.latest_version(events, ["user_id"], ["ts", "event_id"])
    return latest.withColumn("ts", F.date_trunc("second", "ts"))


@query(f"""
    SELECT n.Patient_Key, n.Patient_Id, n.Patient_Marital
    FROM ({chk.entity_members('dim_patients', True)}) n
    JOIN ({chk.entity_members('dim_patients')}) o ON n.Patient_Id = o.Patient_Id
    WHERE n.Patient_Key <> o.Patient_Key""")
def scd2_changed_rows(x: Inputs):
    return scd2.changed_members(
        star.entity_dimension(x.enriched, "dim_patients"),
        star.entity_members(x.second, "dim_patients"), "Patient_Id", "Patient_Key",
    ).select("Patient_Key", "Patient_Id", "Patient_Marital")


def _patient_history(x: Inputs):
    return star.entity_refresh(
        star.entity_dimension(x.enriched, "dim_patients"), x.second, "dim_patients", AS_OF
    )


@query(f"SELECT Patient_Key, Patient_Id FROM ({chk.entity_after_refresh('dim_patients', AS_OF)}) "
       "h WHERE Is_Current")
def scd2_current(x: Inputs):
    return scd2.current(_patient_history(x)).select("Patient_Key", "Patient_Id")


MID = "1998-06-01 00:00:00"


@query(f"""
    SELECT e.ID, h.Patient_Key FROM ({ENCOUNTERS}) e
    LEFT JOIN ({chk.entity_after_refresh('dim_patients', MID)}) h ON e.PATIENT = h.Patient_Id
        AND e.START >= h.Effective_Date AND e.START < h.Expiration_Date""")
def scd2_as_of_lookup(x: Inputs):
    """Patient version valid when the encounter started; the change falls mid-history."""
    history = star.entity_refresh(
        star.entity_dimension(x.enriched, "dim_patients"), x.second, "dim_patients", MID
    )
    rows = x.enriched["encounters"].select("ID", "PATIENT", "START")
    return scd2.as_of_lookup(
        rows, history, "PATIENT", "START", "Patient_Id", "Patient_Key", spread_by="ID"
    ).select("ID", "Patient_Key")


@query(f"SELECT {chk.entity_columns('dim_organizations')} FROM "
       f"({chk.entity_after_refresh('dim_organizations', AS_OF)}) h")
def snapshot_check(x: Inputs):
    """Snapshot of the organizations: natural id as unique key, digest as checked column."""
    return scd2.snapshot_check(
        star.entity_dimension(x.enriched, "dim_organizations"),
        star.entity_members(x.second, "dim_organizations"),
        "Organization_Id", "Organization_Key", AS_OF,
    )


@query(f"SELECT ID, NAME, ORGANIZATION, ORG_NAME, ORG_STATE, ORG_ZIP FROM "
       f"({chk.entity_rows('dim_providers')}) p")
def dim_provider_denorm(x: Inputs):
    return star.provider_rows(x.enriched).select(
        "ID", "NAME", "ORGANIZATION", "ORG_NAME", "ORG_STATE", "ORG_ZIP"
    )


# --- fact --------------------------------------------------------------------------------

@query(f"""
    SELECT ID, {chk.code_key(['CODE', 'ENCOUNTERCLASS', 'DESCRIPTION'])} AS Encounter_Code_Key,
        {chk.code_key(['REASONCODE', 'REASONDESCRIPTION'])} AS Reason_Code_Key
    FROM ({ENCOUNTERS}) e""")
def fact_code_keys(x: Inputs):
    return x.enriched["encounters"].select(
        "ID", facts.code_key(facts.ENCOUNTER_CODE).alias("Encounter_Code_Key"),
        facts.code_key(facts.REASON_CODE).alias("Reason_Code_Key"),
    )


@query(chk.encounter_fact())
def fact_encounters(x: Inputs):
    return star.encounter_fact(x.enriched)


_DECIMALS = {t: star.decimal_attributes(r) for t, r in ENTITY_DIMENSIONS.items()}


@query(chk.encounter_fact_decimal(_DECIMALS))
def fact_encounters_decimal(x: Inputs):
    return star.encounter_fact_decimal(x.enriched)


def _dangling(x: Inputs, fact, style: str):
    """Code keys of the fact that their dimension does not have, per dimension."""
    out = None
    for key, table in (("Encounter_Code_Key", "dim_encounter_codes"),
                       ("Reason_Code_Key", "dim_encounter_reason_codes")):
        r = CODE_DIMENSIONS[table]
        dim = star.code_dimension(x.enriched, table, style).select(F.col(r.key).alias(key))
        missing = fact.select(key).distinct().join(dim, key, "leftanti").agg(
            F.lit(key).alias("key"), F.count(F.lit(1)).alias("missing"))
        out = missing if out is None else out.unionByName(missing)
    return out


_NONE_MISSING = ("SELECT key, count(o_orderkey) AS missing FROM (VALUES ('Encounter_Code_Key'), "
                 "('Reason_Code_Key')) k(key) LEFT JOIN orders ON o_orderkey < 0 GROUP BY key")


@query(_NONE_MISSING)
def fact_dangling_keys(x: Inputs):
    return _dangling(x, star.encounter_fact(x.enriched, roles=()), "sha2")


@query(_NONE_MISSING)
def fact_dangling_keys_decimal(x: Inputs):
    encounters = x.enriched["encounters"]
    return _dangling(x, encounters.select(
        facts.code_key(facts.ENCOUNTER_CODE, md5_key).alias("Encounter_Code_Key"),
        facts.code_key(facts.REASON_CODE, md5_key).alias("Reason_Code_Key")), "md5")


@query(f"""
    SELECT ID, CAST(strftime(START, '%I%M%S') AS INTEGER) AS Start_Time_Key_12h,
        -date_diff('day', CAST(START AS DATE), CAST(coalesce(STOP,
            TIMESTAMP '9999-12-31 00:00:00') AS DATE)) AS Duration_Start_Minus_Stop
    FROM ({ENCOUNTERS}) e""")
def fact_compat_columns(x: Inputs):
    """The 12-hour time key and the start-minus-stop day count of older extracts."""
    from starloom.functions.calendar import time_key_half_day

    stop = F.coalesce("STOP", F.lit(generated.OPEN_END).cast("timestamp"))
    return x.enriched["encounters"].select(
        "ID", time_key_half_day(F.col("START")).alias("Start_Time_Key_12h"),
        F.datediff("START", stop).alias("Duration_Start_Minus_Stop"),
    )


# --- increments and layout ---------------------------------------------------------------

def _write_and_append(x: Inputs):
    """First load, append of the new members, then the same append again (which adds none)."""
    path = fresh_dir(x.spark, "dim_medications")
    name = f"starloom_dim_{path.rsplit('-', 1)[-1]}"
    r = CODE_DIMENSIONS["dim_medications"]
    dim = facts.stored(star.code_dimension(x.enriched, "dim_medications", "md5"), "medications")
    sinks.create_or_replace(dim.where(F.col(r.attributes[2].name) < 1500), name, path)
    for _ in range(2):
        sinks.append(merges.insert_only_delta(x.spark.table(name), dim, [r.key]), name)
    return x.spark.table(name)


REGISTRY.add("incr_append", _write_and_append, chk.code_dimension("dim_medications", "md5"))


# Later deliveries of encounters: some start 40 days later, then some cost twice as much.
_MOVED = "ENCOUNTERCLASS = 'O' AND CAST(ID AS BIGINT) % 7 = 0"
_DEARER = "CAST(ID AS BIGINT) % 11 = 0"
_THREE_DELIVERIES = f"""
    SELECT * REPLACE (
        CASE WHEN {_MOVED} THEN START + INTERVAL '40' DAY ELSE START END AS START,
        CASE WHEN {_DEARER} THEN TOTAL_CLAIM_COST * 2 ELSE TOTAL_CLAIM_COST END AS TOTAL_CLAIM_COST)
    FROM ({binding_sql('encounters')}) first_delivery"""


@query(f"""
    SELECT *, CAST(Start_Date_Key // 100 AS INTEGER) AS Start_Month
    FROM ({chk.encounter_fact(_THREE_DELIVERIES, ('dim_patients', 'dim_providers'))}) f""")
def incr_fact(x: Inputs):
    """Three deliveries, each as an increment: most encounters; the rest, some that moved to
    another month, and changed patients; some with another cost, and changed providers."""
    path = fresh_dir(x.spark, "fact")
    tag = path.rsplit("-", 1)[-1]
    fact, notes = f"starloom_fact_{tag}", f"starloom_notes_{tag}"
    whole = x.enriched["encounters"]
    moved = whole.withColumn("START", F.expr(f"CASE WHEN {_MOVED} THEN START + INTERVAL '40' DAY ELSE START END"))
    dearer = moved.withColumn("TOTAL_CLAIM_COST", F.col("TOTAL_CLAIM_COST") * 2)
    late = "CAST(ID AS BIGINT) % 3 = 0"
    deliveries = [
        (whole.where(f"NOT ({late})"), {}),
        (moved.where(f"({late}) OR ({_MOVED})"), {"Patient": "dim_patients"}),
        (dearer.where(_DEARER), {"Provider": "dim_providers"}),
    ]
    dims = star.entity_lookups(x.enriched)
    for n, (rows, changed) in enumerate(deliveries):
        rows = facts.stored(
            rows.select("*", F.lit(f"2024-0{n + 1}-01").cast("timestamp").alias("INGEST_TS"), fingerprint(rows.columns).alias("HASH")), "delivery")
        if n == 0:
            versions = rows
            increments.build_fact(fact, f"{path}/fact", dedup.latest_version(versions, ["ID"], increments.VERSION_ORDER), dims)
            continue
        versions = versions.unionByName(rows)
        increments.note(notes, f"{path}/notes", {increments.ENCOUNTER: rows.select("ID")})
        for role, table in changed.items():
            r = ENTITY_DIMENSIONS[table]
            members = facts.stored(star.entity_members(x.second, table), table)
            ids = facts.stored(increments.changed_ids(dims[role], members, r.natural_id, r.key), "changed")
            increments.note(notes, f"{path}/notes", {role: ids})
            narrow = scd2.open_versions(members.select(r.natural_id, r.key)).select(*dims[role].columns)
            gone = dims[role].join(members.select(r.natural_id), r.natural_id, "leftanti")
            dims[role] = facts.stored(narrow.unionByName(gone), role)
        pending = increments.noted(x.spark, notes)
        increments.update_fact(fact, f"{path}/fact", versions, dims, pending)
        increments.forget(x.spark, notes, f"{path}/notes", pending)
    return x.spark.table(fact)


@query(f"""
    WITH t AS (SELECT DISTINCT * FROM ({chk.bridge(_ALLERGY.table, _EARLY)}) a),
    s AS (SELECT DISTINCT * FROM ({chk.bridge(_ALLERGY.table)}) b)
    SELECT Allergy_Group_Key, Allergy_Key, substr(Allergy_Group_Key, 1, 1) AS part FROM (
        SELECT * FROM s WHERE substr(Allergy_Group_Key, 2, 1) < '8'
        UNION ALL SELECT * FROM t WHERE substr(Allergy_Group_Key, 2, 1) >= '8') m""")
def incr_insert_overwrite(x: Inputs):
    """Bridge partitioned by key prefix. The later delivery has half of the groups of every
    partition: those are replaced, the other half stays as it was."""
    target, source = _allergy_bridges(x)
    prefix = layout.key_prefix(_ALLERGY.group, 1).alias("part")
    path = fresh_dir(x.spark, "bridge_parts")
    name = f"starloom_parts_{path.rsplit('-', 1)[-1]}"
    later = source.where(F.substring(_ALLERGY.group, 2, 1) < "8")
    partitions.create(target.select("*", prefix), name, path, ["part"])
    partitions.replace_groups(later.select("*", prefix), name, path, _ALLERGY.group)
    out = x.spark.table(name)
    return out.select(_ALLERGY.group, _ALLERGY.member, "part")


@query(chk.bridge(_ALLERGY.table))
def sorted_layout(x: Inputs):
    """The bridge laid out in key ranges, written and read back."""
    path = fresh_dir(x.spark, "bridge_sorted")
    layout.range_sorted(star.bridge(x.enriched, _ALLERGY.table), _ALLERGY.group).write.parquet(
        path
    )
    return x.spark.read.parquet(path)


@query(chk.code_dimension("dim_conditions"))
def view_materialization(x: Inputs):
    """A model kept as a view instead of a table."""
    path = fresh_dir(x.spark, "view")
    name = f"starloom_view_{path.rsplit('-', 1)[-1]}"
    sinks.create_view(star.code_dimension(x.enriched, "dim_conditions"), name)
    return x.spark.sql(f"SELECT * FROM {name}")


# --- consumers of the star ---------------------------------------------------------------

@query(f"""
    SELECT coalesce(c_mktsegment, 'Unknown') AS segment,
        CAST(strftime(START, '%Y%m') AS INTEGER) AS month, count(*) AS encounters,
        CAST(sum(CAST(TOTAL_CLAIM_COST AS DECIMAL(18,2))) AS DOUBLE) AS cost
    FROM ({ENCOUNTERS}) e LEFT JOIN customer ON PATIENT = CAST(c_custkey AS VARCHAR)
    GROUP BY 1, 2""")
def star_cost_by_segment_month(x: Inputs):
    """Fact to patient dimension on the surrogate key, grouped by segment and month.

    Summed per key and month before the join, so that the unknown patient, who may own a
    large share of the fact, enters it as one row per month.
    """
    dim = star.entity_dimension(x.enriched, "dim_patients").select(
        "Patient_Key", F.col("Patient_Gender").alias("segment")
    )
    month = F.expr("Start_Date_Key div 100").cast("int").alias("month")
    per_key = (
        star.encounter_fact(x.enriched, roles=["Patient"])
        .groupBy("Patient_Key", month)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("Total_Claim_Cost").cast("decimal(18,2)")).alias("c"),
        )
    )
    return (
        per_key.join(dim, "Patient_Key")
        .groupBy("segment", "month")
        .agg(F.sum("n").alias("encounters"), F.sum("c").alias("cost"))
    )


@query(f"""
    SELECT d.Allergy_Code, d.Allergy_Description, count(*) AS encounters
    FROM ({chk.bridge(_ALLERGY.table)}) b
    JOIN ({chk.code_dimension('dim_allergies')}) d ON b.Allergy_Key = d.Allergy_Key
    GROUP BY 1, 2""")
def star_group_profile(x: Inputs):
    """Fact to bridge to member: encounters per allergy code and description."""
    fact = x.enriched["encounters"].select(group_key("ID").alias(_ALLERGY.group))
    pairs = star.bridge(x.enriched, _ALLERGY.table)
    known = pairs.join(fact, _ALLERGY.group, "leftsemi")
    per_member = known.groupBy(_ALLERGY.member).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_member.join(star.code_dimension(x.enriched, "dim_allergies"), _ALLERGY.member)
        .groupBy("Allergy_Code", "Allergy_Description")
        .agg(F.sum("n").alias("encounters"))
    )


@query(f"""
    SELECT region, nation, count(*) AS encounters,
        CAST(sum(CAST(TOTAL_CLAIM_COST AS DECIMAL(18,2))) AS DOUBLE) AS cost
    FROM (SELECT e.*, coalesce(r_name, 'Unknown') AS region, coalesce(n_name, 'Unknown') AS nation
        FROM ({ENCOUNTERS}) e LEFT JOIN nation ON ORGANIZATION = CAST(n_nationkey AS VARCHAR)
        LEFT JOIN region ON n_regionkey = r_regionkey) j GROUP BY ROLLUP (region, nation)""")
def star_rollup_region_nation(x: Inputs):
    """Totals per organization state and name, with subtotals; pre-summed per key."""
    dim = star.entity_dimension(x.enriched, "dim_organizations").select(
        "Organization_Key", F.col("Organization_State").alias("region"),
        F.col("Organization_Name").alias("nation"),
    )
    per_key = (
        star.encounter_fact(x.enriched, roles=["Organization"])
        .groupBy("Organization_Key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("Total_Claim_Cost").cast("decimal(18,2)")).alias("c"),
        )
    )
    return (
        per_key.join(dim, "Organization_Key")
        .rollup("region", "nation")
        .agg(F.sum("n").alias("encounters"), F.sum("c").alias("cost"))
    )
