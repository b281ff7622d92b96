"""Many-to-many bridges between encounter groups and dimension members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.functions.defaults import Attribute, null_defaulted
from starloom.functions.keys import group_key, joined_text, md5_key, unknown_key
from starloom.operators.joins import lookup_join, without_child


def real_pairs(
    children: DataFrame, child_ref: str, attributes: Sequence[Attribute], group: str, member: str
) -> DataFrame:
    """Distinct (group, member) pairs of the child table.

    Pairs are made distinct on the undigested texts, then digested, so both digests run once
    per pair instead of once per child row. Children without an encounter belong to no group.
    """
    names = [a.name for a in attributes]
    return (
        children.where(F.col(child_ref).isNotNull())
        .select(F.col(child_ref).alias("_ref"), *null_defaulted(attributes))
        .select("_ref", joined_text(names).alias("_text"))
        .distinct()
        .select(group_key("_ref").alias(group), F.sha2("_text", 256).alias(member))
    )


def sentinel_pairs(
    encounters: DataFrame,
    encounter_id: str,
    children: DataFrame,
    child_ref: str,
    group: str,
    member: str,
) -> DataFrame:
    """(group, unknown member) for every encounter without a child."""
    ids = encounters.select(F.col(encounter_id).alias("_id")).where("_id is not null").distinct()
    return without_child(ids, "_id", children, child_ref).select(
        group_key("_id").alias(group), unknown_key().alias(member)
    )


def bridge(
    encounters: DataFrame,
    encounter_id: str,
    children: DataFrame,
    child_ref: str,
    attributes: Sequence[Attribute],
    group: str,
    member: str,
) -> DataFrame:
    return real_pairs(children, child_ref, attributes, group, member).unionByName(
        sentinel_pairs(encounters, encounter_id, children, child_ref, group, member)
    )


def bridge_by_code(
    encounters: DataFrame,
    encounter_id: str,
    children: DataFrame,
    child_ref: str,
    code: Attribute,
    dim: DataFrame,
    group: str,
    member: str,
) -> DataFrame:
    """Twin that resolves members by code alone.

    A code with several members yields several rows; encounters without a child meet the
    members of the default code, which makes that code hot. Both are part of the definition.
    """
    known = (
        children.where(F.col(child_ref).isNotNull())
        .select(F.col(child_ref).alias("_ref"), code.project().alias("_code"))
        .distinct()
    )
    ids = encounters.select(F.col(encounter_id).alias("_id")).where("_id is not null").distinct()
    missing = without_child(ids, "_id", children, child_ref).select(
        F.col("_id").alias("_ref"), code.default_column().alias("_code")
    )
    by_code = dim.select(F.col(code.name).alias("_dim_code"), F.col(member))
    return lookup_join(
        known.unionByName(missing), by_code, "_code", "_dim_code", spread_by="_ref", how="inner"
    ).select(md5_key(["_ref"]).alias(group), member)
