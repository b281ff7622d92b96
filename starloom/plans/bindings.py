"""Clinical-shaped relations over the TPC-H-like test tables.

Each binding is one portable SELECT, so the same text feeds Spark and the SQL check.
Nulls, missing references and spare ids are produced on purpose: no test column has any.
"""

from __future__ import annotations

from starloom.sources.readers import TableSet

_CHILD = """
    CASE WHEN l_discount = CAST(0.1 AS DOUBLE) AND l_tax = CAST(0.08 AS DOUBLE) THEN NULL
         ELSE CAST(l_orderkey AS STRING) END AS ENCOUNTER,
    CASE WHEN l_discount > 0 THEN l_partkey END AS CODE,
    CASE WHEN l_tax > 0 AND l_discount > 0 THEN 'Item ' || CAST(l_partkey AS STRING) END AS DESCRIPTION
"""
_COST = "l_quantity * 100 AS BASE_COST"


def _child(where: str, *extra: str) -> str:
    return f"SELECT {', '.join([_CHILD.strip(), *extra])} FROM {{lineitem}} WHERE {where}"


_START = "o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 37) % 86400)"
_SPAN = "INTERVAL '1' SECOND * ((o_custkey * 61) % 200000)"

BINDINGS = {
    "encounters": f"""
        SELECT CAST(o_orderkey AS STRING) AS ID,
            {_START} AS START,
            CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                 ELSE {_START} + {_SPAN} END AS STOP,
            CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN NULL
                 ELSE CAST(o_custkey AS STRING) END AS PATIENT,
            CAST(o_custkey % 30 AS STRING) AS ORGANIZATION,
            CAST(o_orderkey % 120 AS STRING) AS PROVIDER,
            CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                 ELSE CAST(o_custkey % 28 AS STRING) END AS PAYER,
            nullif(o_orderstatus, 'P') AS ENCOUNTERCLASS,
            CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                 ELSE CAST(substr(o_orderpriority, 1, 1) AS BIGINT) END AS CODE,
            nullif(substr(o_orderpriority, 3), 'NOT SPECIFIED') AS DESCRIPTION,
            o_totalprice AS BASE_ENCOUNTER_COST,
            o_totalprice AS TOTAL_CLAIM_COST,
            CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS PAYER_COVERAGE,
            CASE WHEN o_orderstatus = 'O' THEN o_custkey % 12 END AS REASONCODE,
            CASE WHEN o_orderstatus = 'O' OR o_orderpriority = '1-URGENT'
                 THEN 'Reason ' || CAST(o_custkey % 12 AS STRING) END AS REASONDESCRIPTION
        FROM {{orders}}""",
    "allergies": _child(
        "l_returnflag = 'A'", "CASE WHEN l_linestatus = 'O' THEN 'SNOMED-CT' END AS SYSTEM"),
    "careplans": _child("l_returnflag = 'N'"),
    "conditions": _child("l_returnflag = 'R'"),
    "devices": _child(
        "l_linestatus = 'F'", "CASE WHEN l_discount > 0 THEN 'udi-' || CAST(l_suppkey AS STRING) END AS UDI"),
    "imaging_studies": """
        SELECT CASE WHEN l_discount = CAST(0.1 AS DOUBLE) AND l_tax = CAST(0.08 AS DOUBLE)
                    THEN NULL ELSE CAST(l_orderkey AS STRING) END AS ENCOUNTER,
            CASE WHEN l_discount > 0 THEN l_suppkey END AS BODYSITE_CODE,
            CASE WHEN l_tax > 0 AND l_discount > 0 THEN 'Site ' || CAST(l_suppkey AS STRING) END
                AS BODYSITE_DESCRIPTION,
            nullif(l_returnflag, 'R') AS MODALITY_CODE,
            CASE l_returnflag WHEN 'A' THEN 'Digital' WHEN 'N' THEN 'Computed' END
                AS MODALITY_DESCRIPTION
        FROM {lineitem} WHERE l_linestatus = 'O'""",
    "immunizations": _child("l_quantity <= 10", _COST),
    "medications": _child("l_quantity > 10 AND l_quantity <= 20", _COST),
    "observations": """
        SELECT CASE WHEN l_discount = CAST(0.1 AS DOUBLE) AND l_tax = CAST(0.08 AS DOUBLE)
                    THEN NULL ELSE CAST(l_orderkey AS STRING) END AS ENCOUNTER,
            CASE WHEN l_discount > 0 THEN CAST(l_partkey AS STRING) || '-'
                || CAST(l_linenumber AS STRING) END AS CODE,
            nullif(l_linestatus, 'F') AS CATEGORY,
            CASE WHEN l_tax > 0 AND l_discount > 0 THEN 'Reading ' || CAST(l_partkey AS STRING) END AS DESCRIPTION
        FROM {lineitem} WHERE l_quantity > 20 AND l_quantity <= 30""",
    "procedures": _child("l_quantity > 30 AND l_quantity <= 40", _COST),
    "supplies": _child("l_quantity > 40", "CAST(l_quantity AS BIGINT) AS QUANTITY"),
    "organizations": """
        SELECT CAST(n_nationkey AS STRING) AS ID, n_name AS NAME,
            CAST(n_nationkey AS STRING) || ' Main Street' AS ADDRESS, n_name AS CITY,
            r_name AS STATE,
            CASE WHEN n_regionkey > 0 THEN lpad(CAST(n_nationkey * 37 AS STRING), 5, '0') END
                AS ZIP,
            n_nationkey + CAST(0.5 AS DOUBLE) AS LAT,
            CASE WHEN n_regionkey > 1 THEN -n_nationkey - CAST(0.25 AS DOUBLE) END AS LON,
            CAST(NULL AS STRING) AS PHONE, CAST(n_nationkey * 1000 AS DOUBLE) AS REVENUE,
            CAST(n_nationkey * 7 AS BIGINT) AS UTILIZATION
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "patients": """
        SELECT CAST(c_custkey AS STRING) AS ID,
            DATE '1940-01-01' + CAST(c_custkey % 20000 AS INT) AS BIRTHDATE,
            CASE WHEN c_acctbal < 0 THEN DATE '2001-01-01' + CAST(c_custkey % 3000 AS INT) END
                AS DEATHDATE,
            lpad(CAST(c_custkey AS STRING), 9, '0') AS SSN,
            CASE WHEN c_acctbal > 5000 THEN 'D' || CAST(c_custkey AS STRING) END AS DRIVERS,
            CAST(NULL AS STRING) AS PASSPORT, CAST(NULL AS STRING) AS PREFIX,
            c_name AS FIRST, CAST(NULL AS STRING) AS MIDDLE, c_name AS LAST,
            CAST(NULL AS STRING) AS SUFFIX, CAST(NULL AS STRING) AS MAIDEN,
            nullif(c_mktsegment, 'FURNITURE') AS MARITAL, 'R' || CAST(c_nationkey AS STRING)
                AS RACE,
            CAST(NULL AS STRING) AS ETHNICITY, c_mktsegment AS GENDER,
            CAST(NULL AS STRING) AS BIRTHPLACE,
            CAST(c_custkey AS STRING) || ' Oak Road' AS ADDRESS,
            'City ' || CAST(c_nationkey AS STRING) AS CITY, CAST(NULL AS STRING) AS STATE,
            CAST(NULL AS STRING) AS COUNTY,
            CASE WHEN c_nationkey > 2 THEN lpad(CAST(c_nationkey AS STRING), 5, '0') END AS FIPS,
            lpad(CAST(c_custkey % 90000 AS STRING), 5, '0') AS ZIP,
            c_nationkey + CAST(0.125 AS DOUBLE) AS LAT,
            CAST(NULL AS DOUBLE) AS LON, c_acctbal AS HEALTHCARE_EXPENSES,
            CASE WHEN c_acctbal > 0 THEN c_acctbal END AS HEALTHCARE_COVERAGE,
            CASE WHEN c_nationkey > 4 THEN (c_custkey % 100000) * 3 END AS INCOME
        FROM {customer}""",
    "payers": """
        SELECT CAST(c_nationkey AS STRING) AS ID,
            'Payer ' || CAST(c_nationkey AS STRING) AS NAME,
            CASE WHEN c_nationkey > 9 THEN 'PRIVATE' END AS OWNERSHIP,
            CAST(NULL AS STRING) AS ADDRESS, CAST(NULL AS STRING) AS CITY,
            'ST' || CAST(c_nationkey AS STRING) AS STATE_HEADQUARTERED,
            CAST(NULL AS STRING) AS ZIP, CAST(NULL AS STRING) AS PHONE,
            max(c_acctbal) AS AMOUNT_COVERED, min(c_acctbal) AS AMOUNT_UNCOVERED,
            CAST(NULL AS DOUBLE) AS REVENUE, count(*) AS COVERED_ENCOUNTERS,
            max(c_custkey) AS UNCOVERED_ENCOUNTERS, min(c_custkey) AS COVERED_MEDICATIONS,
            CAST(NULL AS BIGINT) AS UNCOVERED_MEDICATIONS, count(*) * 2 AS COVERED_PROCEDURES,
            CAST(NULL AS BIGINT) AS UNCOVERED_PROCEDURES,
            CAST(NULL AS BIGINT) AS COVERED_IMMUNIZATIONS,
            CAST(NULL AS BIGINT) AS UNCOVERED_IMMUNIZATIONS,
            count(DISTINCT c_custkey) AS UNIQUE_CUSTOMERS,
            CAST(c_nationkey AS DOUBLE) / 4 AS QOLS_AVG, count(*) * 12 AS MEMBER_MONTHS
        FROM {customer} GROUP BY c_nationkey""",
    "providers": """
        SELECT CAST(s_suppkey AS STRING) AS ID,
            CAST(CASE WHEN s_acctbal < 0 THEN s_nationkey + 100 ELSE s_nationkey END AS STRING)
                AS ORGANIZATION,
            s_name AS NAME, CASE WHEN s_acctbal > 3000 THEN 'F' END AS GENDER,
            'Speciality ' || CAST(s_nationkey AS STRING) AS SPECIALITY,
            CAST(NULL AS STRING) AS ADDRESS, CAST(NULL AS STRING) AS CITY,
            CAST(NULL AS STRING) AS STATE, lpad(CAST(s_suppkey AS STRING), 5, '0') AS ZIP,
            s_nationkey + CAST(0.5 AS DOUBLE) AS LAT, CAST(NULL AS DOUBLE) AS LON,
            s_suppkey * 5 AS ENCOUNTERS
        FROM {supplier}""",
}

# A second delivery of the base tables: some rows changed, some ids are new.
SECOND_DELIVERY = {
    "customer": """
        SELECT c_custkey, c_name, c_nationkey, c_acctbal,
            CASE WHEN c_acctbal < 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment
        FROM {customer}
        UNION ALL
        SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, 'BUILDING'
        FROM {supplier}""",
    "nation": """
        SELECT n_nationkey, CASE WHEN n_regionkey = 2 THEN 'NEW ' || n_name ELSE n_name END
            AS n_name, n_regionkey FROM {nation}
        UNION ALL
        SELECT n_nationkey + 1000, n_name, n_regionkey FROM {nation} WHERE n_regionkey = 3""",
    "supplier": """
        SELECT s_suppkey, CASE WHEN s_acctbal < 1000 THEN 'Dr ' || s_name ELSE s_name END
            AS s_name, s_nationkey, s_acctbal FROM {supplier}
        UNION ALL
        SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal FROM {supplier}
        WHERE s_acctbal > 8000""",
}


class SecondDelivery(TableSet):
    """The test tables as they would arrive the second time."""

    def __init__(self, first: TableSet):
        super().__init__(first.spark, first.folder)
        self.first = first

    def __getitem__(self, name: str):
        if name in SECOND_DELIVERY:
            return self.first.sql(SECOND_DELIVERY[name])
        return self.first[name]


class BoundEntities:
    """Mapping from entity name to its binding over one set of test tables."""

    def __init__(self, tables: TableSet):
        self.tables = tables

    def __getitem__(self, entity: str):
        return self.tables.sql(BINDINGS[entity])

    def __contains__(self, entity: str) -> bool:
        return entity in BINDINGS


_BASE = ("orders", "lineitem", "nation", "region", "customer", "supplier")


def binding_sql(entity: str, second: bool = False) -> str:
    """The binding with plain table names, for a SQL engine that has them as views."""
    plain = {n: n for n in _BASE}
    if not second:
        return BINDINGS[entity].format(**plain)
    again = {n: f"({SECOND_DELIVERY[n].format(**plain)}) {n}_2" if n in SECOND_DELIVERY else n
             for n in _BASE}
    return BINDINGS[entity].format(**again)
