"""SQL text for the checks: the same tables written in plain SQL, without the library."""

from __future__ import annotations

from starloom.plans.bindings import binding_sql
from starloom.plans.recipes import BRIDGES, CODE_DIMENSIONS, ENTITY_DIMENSIONS

ZERO_KEY = "0" * 64
ZERO_ID = "00000000-0000-0000-0000-000000000000"


def literal(a) -> str:
    text = str(a.default).replace("'", "''")
    return f"CAST('{text}' AS {a.dtype})"


def shown(name: str, dtype: str) -> str:
    if dtype in ("date", "timestamp"):
        return f"CAST({name} AS VARCHAR) AS {name}"
    if dtype.startswith("decimal"):
        return f"CAST({name} AS DOUBLE) AS {name}"
    return name


def digest(names, style: str = "sha2") -> str:
    joined = f"concat_ws('|', {', '.join(names)})"
    return f"sha256({joined})" if style == "sha2" else f"upper(md5({joined}))"


def defaulted(attributes) -> str:
    return ", ".join(
        f"coalesce(CAST({a.source} AS {a.dtype}), {literal(a)}) AS {a.name}" for a in attributes
    )


def members(source: str, key: str, attributes, require_any=False, style="sha2") -> str:
    names = [a.name for a in attributes]
    where = ""
    if require_any:
        where = " WHERE " + " OR ".join(f"{a.source} IS NOT NULL" for a in attributes)
    return (
        f"SELECT {digest(names, style)} AS {key}, {', '.join(names)} FROM "
        f"(SELECT DISTINCT {defaulted(attributes)} FROM ({source}) src{where}) d"
    )


def unknown(key: str, attributes) -> str:
    return f"SELECT '{ZERO_KEY}' AS {key}, " + ", ".join(
        f"{literal(a)} AS {a.name}" for a in attributes
    )


def code_dimension(table: str, style: str = "sha2") -> str:
    r = CODE_DIMENSIONS[table]
    cols = ", ".join([r.key, *[shown(a.name, a.dtype) for a in r.attributes]])
    rows = members(binding_sql(r.entity), r.key, r.attributes, r.require_any, style)
    return f"SELECT {cols} FROM ({rows} UNION ALL {unknown(r.key, r.attributes)}) u"


def entity_rows(table: str, second: bool = False) -> str:
    r = ENTITY_DIMENSIONS[table]
    if table != "dim_providers":
        return binding_sql(r.entity, second)
    org = ("NAME", "ADDRESS", "CITY", "STATE", "ZIP", "LAT", "LON", "PHONE")
    joined = ", ".join(f"o.{c} AS ORG_{c}" for c in org)
    return (
        f"SELECT p.*, {joined} FROM ({binding_sql('providers', second)}) p LEFT JOIN "
        f"({binding_sql('organizations', second)}) o ON p.ORGANIZATION = o.ID"
    )


def entity_members(table: str, second: bool = False, attributes=None, style="sha2") -> str:
    r = ENTITY_DIMENSIONS[table]
    return members(entity_rows(table, second), r.key, attributes or r.attributes, style=style)


def entity_first_load(table: str) -> str:
    r = ENTITY_DIMENSIONS[table]
    return (
        "SELECT *, TIMESTAMP '1900-01-01 00:00:00' AS Effective_Date, "
        "TIMESTAMP '9999-12-31 00:00:00' AS Expiration_Date, TRUE AS Is_Current "
        f"FROM ({entity_members(table)} UNION ALL {unknown(r.key, r.attributes)}) m"
    )


def entity_columns(table: str) -> str:
    r = ENTITY_DIMENSIONS[table]
    return ", ".join(
        [r.key, *[shown(a.name, a.dtype) for a in r.attributes],
         shown("Effective_Date", "timestamp"), shown("Expiration_Date", "timestamp"),
         "Is_Current"]
    )


def entity_after_refresh(table: str, as_of: str) -> str:
    """History after the second delivery, as four disjoint sets of versions."""
    r = ENTITY_DIMENSIONS[table]
    o_names = ", ".join(f"o.{a.name}" for a in r.attributes)
    n_names = ", ".join(f"n.{a.name}" for a in r.attributes)
    end, start = "TIMESTAMP '9999-12-31 00:00:00'", "TIMESTAMP '1900-01-01 00:00:00'"
    return f"""
        WITH o AS ({entity_first_load(table)}), n AS ({entity_members(table, True)})
        SELECT o.{r.key}, {o_names}, o.Effective_Date,
            CASE WHEN n.{r.key} <> o.{r.key} THEN TIMESTAMP '{as_of}' ELSE o.Expiration_Date END
                AS Expiration_Date,
            n.{r.key} IS NULL OR n.{r.key} = o.{r.key} AS Is_Current
        FROM o LEFT JOIN n ON o.{r.natural_id} = n.{r.natural_id}
        UNION ALL
        SELECT n.{r.key}, {n_names},
            CASE WHEN o.{r.key} IS NULL THEN {start} ELSE TIMESTAMP '{as_of}' END, {end}, TRUE
        FROM n LEFT JOIN o ON o.{r.natural_id} = n.{r.natural_id}
        WHERE o.{r.key} IS NULL OR o.{r.key} <> n.{r.key}
    """


def bridge(table: str, children: str | None = None) -> str:
    b = BRIDGES[table]
    children = children or binding_sql(b.entity)
    names = [a.name for a in b.attributes]
    return f"""
        SELECT DISTINCT sha256(ENCOUNTER) AS {b.group}, {digest(names)} AS {b.member}
        FROM (SELECT ENCOUNTER, {defaulted(b.attributes)} FROM ({children}) c
              WHERE ENCOUNTER IS NOT NULL) d
        UNION ALL
        SELECT sha256(CAST(o_orderkey AS VARCHAR)), '{ZERO_KEY}' FROM orders
        WHERE CAST(o_orderkey AS VARCHAR) NOT IN
            (SELECT ENCOUNTER FROM ({children}) c WHERE ENCOUNTER IS NOT NULL)
    """


def bridge_by_code(table: str) -> str:
    b = BRIDGES[table]
    dim = next(t for t, r in CODE_DIMENSIONS.items() if r.key == b.member)
    a = b.attributes[0]
    children = binding_sql(b.entity)
    return f"""
        WITH c AS (SELECT DISTINCT ENCOUNTER,
                coalesce(CAST({a.source} AS {a.dtype}), {literal(a)}) AS code
            FROM ({children}) s WHERE ENCOUNTER IS NOT NULL),
        e AS (SELECT * FROM c UNION ALL
            SELECT CAST(o_orderkey AS VARCHAR), {literal(a)} FROM orders
            WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT ENCOUNTER FROM c)),
        d AS ({code_dimension(dim, 'md5')})
        SELECT upper(md5(ENCOUNTER)) AS {b.group}, d.{b.member}
        FROM e JOIN d ON e.code = d.{a.name}
    """


ROLES = [
    ("Patient", "dim_patients"), ("Organization", "dim_organizations"),
    ("Provider", "dim_providers"), ("Payer", "dim_payers"),
]
GROUPS = [b.group for b in BRIDGES.values()]


def code_key(columns) -> str:
    present = " OR ".join(f"{c} IS NOT NULL" for c in columns)
    first = f"coalesce({columns[0]}, 0)"
    rest = ", ".join(f"coalesce({c}, 'Unknown')" for c in columns[1:])
    return (
        f"CASE WHEN {present} THEN sha256(concat_ws('|', {first}, {rest})) "
        f"ELSE '{ZERO_KEY}' END"
    )


def _day_key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER)"


def _second_key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%H%M%S') AS INTEGER)"


def encounter_fact(encounters: str | None = None, second=()) -> str:
    """``encounters`` may stand for the binding; the dimensions in ``second`` are those of the
    second delivery."""
    end = "TIMESTAMP '9999-12-31 00:00:00'"
    start, stop = f"coalesce(START, {end})", f"coalesce(STOP, {end})"
    joins = " ".join(
        f"LEFT JOIN (SELECT {role}_Id, {role}_Key AS k_{role} FROM ({entity_members(table, table in second)}) m) "
        f"d_{role} ON e.{role.upper()} = d_{role}.{role}_Id"
        for role, table in ROLES
    )
    keys = ", ".join(f"coalesce(k_{role}, '{ZERO_KEY}') AS {role}_Key" for role, _ in ROLES)
    late = " OR ".join(f"(e.{role.upper()} IS NOT NULL AND k_{role} IS NULL)" for role, _ in ROLES)
    groups = ", ".join(f"sha256(ID) AS {g}" for g in GROUPS)
    return f"""
        SELECT ID AS Encounter_Id,
            {_day_key(start)} AS Start_Date_Key, {_second_key(start)} AS Start_Time_Key,
            {_day_key(stop)} AS Stop_Date_Key, {_second_key(stop)} AS Stop_Time_Key,
            {keys},
            {code_key(['CODE', 'ENCOUNTERCLASS', 'DESCRIPTION'])} AS Encounter_Code_Key,
            {code_key(['REASONCODE', 'REASONDESCRIPTION'])} AS Reason_Code_Key,
            {groups},
            coalesce(BASE_ENCOUNTER_COST, 0.0) AS Base_Encounter_Cost,
            coalesce(TOTAL_CLAIM_COST, 0.0) AS Total_Claim_Cost,
            coalesce(PAYER_COVERAGE, 0.0) AS Payer_Coverage,
            CASE WHEN START IS NOT NULL AND STOP IS NOT NULL
                THEN date_diff('day', CAST(START AS DATE), CAST(STOP AS DATE)) ELSE -1 END
                AS Duration,
            CASE WHEN START IS NOT NULL AND STOP IS NOT NULL
                THEN date_diff('second', START, STOP) ELSE -1 END AS Duration_Seconds,
            {late} AS is_late_arriving
        FROM ({encounters or binding_sql('encounters')}) e {joins}
    """


def encounter_fact_decimal(decimal_attributes) -> str:
    """``decimal_attributes`` maps a dimension table to its decimal attribute list."""
    end = "TIMESTAMP '2100-01-01 00:00:00'"
    start, stop = f"coalesce(START, {end})", f"coalesce(STOP, {end})"
    joins = " ".join(
        f"LEFT JOIN (SELECT {role}_Id, {role}_Key AS k_{role} FROM "
        f"({entity_members(table, False, decimal_attributes[table], 'md5')}) m) "
        f"d_{role} ON e.{role.upper()} = d_{role}.{role}_Id"
        for role, table in ROLES
    )
    keys = ", ".join(f"coalesce(k_{role}, '{ZERO_KEY}') AS {role}_Key" for role, _ in ROLES)

    def md5_code(columns):
        return code_key(columns).replace("sha256(concat_ws", "upper(md5(concat_ws").replace(
            ") ELSE", ")) ELSE")

    groups = ", ".join(f"upper(md5(ID)) AS {g}" for g in GROUPS)

    def money(column):
        return f"CAST(CAST(coalesce({column}, 0.0) AS DECIMAL(9,2)) AS DOUBLE)"

    return f"""
        SELECT ID AS Encounter_Id,
            {_day_key(start)} AS Start_Date_Key, {_second_key(start)} AS Start_Time_Key,
            {_day_key(stop)} AS Stop_Date_Key, {_second_key(stop)} AS Stop_Time_Key,
            {keys},
            {md5_code(['CODE', 'ENCOUNTERCLASS', 'DESCRIPTION'])} AS Encounter_Code_Key,
            {md5_code(['REASONCODE', 'REASONDESCRIPTION'])} AS Reason_Code_Key,
            {groups},
            {money('BASE_ENCOUNTER_COST')} AS Base_Encounter_Cost,
            {money('TOTAL_CLAIM_COST')} AS Total_Claim_Cost,
            {money('PAYER_COVERAGE')} AS Payer_Coverage,
            date_diff('second', {start}, {stop}) AS Duration
        FROM ({binding_sql('encounters')}) e {joins}
    """
