"""All columns of the eighteen raw extracts, filled from the line items.

The layouts name columns and types; a rule over the column's number and type gives every value,
with nulls in between and whole rows repeated, so that reading, distinct and fingerprint are
exercised on each layout as it is.
"""

from __future__ import annotations

from starloom.schemas import POSTAL_COLUMNS, RAW_LAYOUTS


def columns(entity: str) -> list[tuple[str, str]]:
    """Names and types of a layout, postal codes as text; needs no session."""
    pairs = [column.split() for column in RAW_LAYOUTS[entity].split(",")]
    return [(name, "string" if name in POSTAL_COLUMNS else kind) for name, kind in pairs]


def _value(number: int, name: str, kind: str) -> str:
    base = f"(l_orderkey * {2 * number + 3} + l_linenumber * {number + 1})"
    made = {
        "string": f"'{name.lower()} ' || CAST({base} % {50 + 7 * number} AS VARCHAR(20))",
        "bigint": f"CAST({base} % 100000 AS BIGINT)",
        "double": f"CAST({base} % 9973 AS DOUBLE) + CAST(0.25 AS DOUBLE)",
        "date": f"DATE '1995-01-01' + CAST({base} % 3000 AS INT)",
        "timestamp": f"TIMESTAMP '1995-01-01 00:00:00' + INTERVAL '1' SECOND * CAST({base} % 90000000 AS INT)",
    }[kind]
    return f"CASE WHEN {base} % {5 + number % 7} > 0 THEN {made} END AS {name}"


def _select(entity: str, table: str) -> str:
    values = ", ".join(_value(n, name, kind) for n, (name, kind) in enumerate(columns(entity)))
    # every fourth row twice, as a later delivery would have it again
    return (f"SELECT {values} FROM (SELECT l_orderkey, l_linenumber FROM {table} "
            f"UNION ALL SELECT l_orderkey, l_linenumber FROM {table} WHERE l_orderkey % 4 = 0) t")


def extract_sql(entity: str) -> str:
    return _select(entity, "{lineitem}")


def extract_check(entity: str) -> str:
    return _select(entity, "lineitem")
