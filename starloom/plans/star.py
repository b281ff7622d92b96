"""Build the tables of the star from enriched relations.

``Enriched`` is any mapping from entity name to DataFrame. Nothing here writes.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, functions as F

from starloom.functions.defaults import Attribute
from starloom.functions.keys import group_key
from starloom.operators import bridges, dimensions, facts, scd2
from starloom.plans.recipes import (
    BRIDGES, CODE_DIMENSIONS, DECIMAL_TWIN, ENTITY_DIMENSIONS, GROUP_TABLES, TWIN_DEFAULTS,
    EntityDimension,
)

Enriched = Mapping[str, DataFrame]


def code_dimension(enriched: Enriched, table: str, key_style: str = "sha2") -> DataFrame:
    r = CODE_DIMENSIONS[table]
    return dimensions.code_dimension(
        enriched[r.entity], r.key, r.attributes, r.require_any, key_style
    )


def group_dimension(enriched: Enriched, table: str, key_style: str = "sha2") -> DataFrame:
    return dimensions.group_dimension(
        enriched["encounters"], "ID", GROUP_TABLES[table], key_style
    )


def bridge(enriched: Enriched, table: str) -> DataFrame:
    b = BRIDGES[table]
    return bridges.bridge(
        enriched["encounters"], "ID", enriched[b.entity], "ENCOUNTER",
        b.attributes, b.group, b.member,
    )


def bridge_parts(enriched: Enriched, table: str) -> tuple[DataFrame, DataFrame]:
    """The bridge's real pairs and its sentinels, which together are the bridge."""
    b = BRIDGES[table]
    children = enriched[b.entity]
    return (
        bridges.real_pairs(children, "ENCOUNTER", b.attributes, b.group, b.member),
        bridges.sentinel_pairs(
            enriched["encounters"], "ID", children, "ENCOUNTER", b.group, b.member),
    )


def bridge_groups(enriched: Enriched, table: str) -> DataFrame:
    """Every group the bridge mentions, without building its members."""
    b = BRIDGES[table]
    refs = enriched[b.entity].select(F.col("ENCOUNTER").alias("_ref"))
    ids = enriched["encounters"].select(F.col("ID").alias("_ref"))
    return refs.unionByName(ids).distinct().select(group_key("_ref").alias(b.group))


def bridge_by_code(enriched: Enriched, table: str) -> DataFrame:
    b = BRIDGES[table]
    dim_table = next(t for t, r in CODE_DIMENSIONS.items() if r.key == b.member)
    return bridges.bridge_by_code(
        enriched["encounters"], "ID", enriched[b.entity], "ENCOUNTER", b.attributes[0],
        code_dimension(enriched, dim_table, "md5"), b.group, b.member,
    )


def provider_rows(enriched: Enriched) -> DataFrame:
    """Providers with their organization's columns; one version of each side."""
    return dimensions.denormalized(
        enriched["providers"], "ID", enriched["organizations"], "ORGANIZATION", "ID", "ORG_"
    )


def entity_members(
    enriched: Enriched, table: str, attributes=None, key_style: str = "sha2"
) -> DataFrame:
    """Members of an entity dimension. Rows without an id are the unknown member itself."""
    r = ENTITY_DIMENSIONS[table]
    rows = provider_rows(enriched) if table == "dim_providers" else enriched[r.entity]
    return dimensions.members(
        rows.where(F.col("ID").isNotNull()), r.key, attributes or r.attributes,
        key_style=key_style,
    )


def entity_dimension(enriched: Enriched, table: str) -> DataFrame:
    """First load of a history-keeping dimension."""
    r = ENTITY_DIMENSIONS[table]
    return scd2.first_load(entity_members(enriched, table), r.key, r.attributes)


def entity_refresh(dim: DataFrame, enriched: Enriched, table: str, as_of) -> DataFrame:
    r = ENTITY_DIMENSIONS[table]
    return scd2.apply_changes(dim, entity_members(enriched, table), r.natural_id, r.key, as_of)


def decimal_attributes(recipe: EntityDimension) -> tuple:
    """The recipe's attributes with the decimal types and defaults of the SQL-model twin."""
    out = []
    for a in recipe.attributes:
        suffix = a.name.split("_", 1)[1]
        dtype = DECIMAL_TWIN.get(suffix, "decimal(18,2)" if a.dtype == "double" else a.dtype)
        default = TWIN_DEFAULTS.get(suffix, a.default)
        if dtype == "bigint":
            default = int(default)
        out.append(Attribute(a.source, a.name, dtype, default))
    return tuple(out)


def entity_dimension_decimal(enriched: Enriched, table: str) -> DataFrame:
    """SQL-model twin of an entity dimension: decimals, MD5 key, no history columns."""
    r = ENTITY_DIMENSIONS[table]
    attributes = decimal_attributes(r)
    rows = provider_rows(enriched) if table == "dim_providers" else enriched[r.entity]
    return dimensions.code_dimension(
        rows.where(F.col("ID").isNotNull()), r.key, attributes, key_style="md5"
    )


ROLE_TABLES = {
    "Patient": "dim_patients", "Organization": "dim_organizations",
    "Provider": "dim_providers", "Payer": "dim_payers",
}


def entity_lookups(enriched: Enriched, roles=tuple(ROLE_TABLES)) -> dict[str, DataFrame]:
    """Ids, keys and currency of the entity dimensions, written once so that the fact knows
    their sizes."""

    def lookup(role: str) -> DataFrame:
        dim = entity_dimension(enriched, ROLE_TABLES[role])
        return facts.stored(dim.select(f"{role}_Id", f"{role}_Key", "Is_Current"), role)

    return _side_by_side(lookup, list(roles))


def _side_by_side(make, roles) -> dict[str, DataFrame]:
    """Small tables written at the same time: each alone would leave most of the cluster idle."""
    with ThreadPoolExecutor(max(1, len(roles))) as pool:
        return dict(zip(roles, pool.map(make, roles)))


def encounter_fact(
    enriched: Enriched, dims: Mapping[str, DataFrame] | None = None, roles=tuple(ROLE_TABLES)
) -> DataFrame:
    return facts.encounter_fact(
        enriched["encounters"], dims or entity_lookups(enriched, roles)
    )


def encounter_fact_decimal(enriched: Enriched) -> DataFrame:

    def lookup(role: str) -> DataFrame:
        dim = entity_dimension_decimal(enriched, ROLE_TABLES[role])
        return facts.stored(dim.select(f"{role}_Id", f"{role}_Key"), role)

    dims = _side_by_side(lookup, list(ROLE_TABLES))
    return facts.encounter_fact_decimal(enriched["encounters"], dims)
