"""Code dimensions, entity dimensions and group dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.functions.defaults import Attribute, any_present, default_member, null_defaulted
from starloom.functions.keys import UNKNOWN_KEY, group_key, md5_key, surrogate_key
from starloom.operators.joins import lookup_join

KEY_STYLES = {"sha2": surrogate_key, "md5": md5_key}


def members(
    source: DataFrame,
    key_name: str,
    attributes: Sequence[Attribute],
    require_any: bool = False,
    key_style: str = "sha2",
) -> DataFrame:
    """Distinct null-defaulted attribute rows with their surrogate key.

    Distinct runs before the digest, so the digest is computed once per member.
    """
    if require_any:
        source = source.where(any_present([a.source for a in attributes]))
    names = [a.name for a in attributes]
    return (
        source.select(*null_defaulted(attributes))
        .dropDuplicates()
        .select(KEY_STYLES[key_style](names).alias(key_name), *names)
    )


def code_dimension(
    source: DataFrame,
    key_name: str,
    attributes: Sequence[Attribute],
    require_any: bool = False,
    key_style: str = "sha2",
) -> DataFrame:
    """Members plus the unknown member, matched by column name."""
    unknown = default_member(source.sparkSession, key_name, UNKNOWN_KEY, attributes)
    return members(source, key_name, attributes, require_any, key_style).unionByName(unknown)


def group_dimension(
    encounters: DataFrame, encounter_id: str, key_name: str, key_style: str = "sha2"
) -> DataFrame:
    """One row per encounter, holding only its group key."""
    key = md5_key(["_id"]) if key_style == "md5" else group_key("_id")
    return (
        encounters.select(F.col(encounter_id).cast("string").alias("_id"))
        .distinct()
        .select(key.alias(key_name))
    )


def denormalized(
    rows: DataFrame,
    row_id: str,
    parent: DataFrame,
    row_ref: str,
    parent_id: str,
    prefix: str = "parent_",
) -> DataFrame:
    """Left join a parent's columns, renamed with ``prefix``, onto each row."""
    renamed = parent.select(*[F.col(c).alias(prefix + c) for c in parent.columns])
    return lookup_join(rows, renamed, row_ref, prefix + parent_id, spread_by=row_id)
