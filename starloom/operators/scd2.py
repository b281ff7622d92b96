"""History-keeping (type 2) dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.functions.defaults import default_member
from starloom.functions.keys import UNKNOWN_KEY
from starloom.operators.joins import lookup_join

# Open interval ends of the validity columns.
FIRST_INSTANT = "1900-01-01 00:00:00"
LAST_INSTANT = "9999-12-31 00:00:00"

VALIDITY = ["Effective_Date", "Expiration_Date", "Is_Current"]


def instant(value) -> Column:
    """A timestamp literal, or a timestamp column unchanged."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def open_versions(members: DataFrame, effective=FIRST_INSTANT) -> DataFrame:
    """Give every row an open validity interval starting at ``effective``."""
    return members.select(
        "*",
        instant(effective).alias("Effective_Date"),
        instant(LAST_INSTANT).alias("Expiration_Date"),
        F.lit(True).alias("Is_Current"),
    )


def first_load(members: DataFrame, key_name: str, attributes) -> DataFrame:
    """First content: every member valid since the first instant, plus the unknown member."""
    unknown = default_member(members.sparkSession, key_name, UNKNOWN_KEY, attributes)
    return open_versions(members.unionByName(unknown))


def current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("Is_Current"))


def changed_members(dim: DataFrame, members: DataFrame, natural_id: str, key: str) -> DataFrame:
    """Source members whose current version carries another key."""
    now = current(dim).select(F.col(natural_id).alias("_id"), F.col(key).alias("_key"))
    return (
        members.alias("source")
        .join(now, F.col(f"source.{natural_id}") == F.col("_id"))
        .where(F.col(f"source.{key}") != F.col("_key"))
        .select("source.*")
    )


def apply_changes(
    dim: DataFrame, members: DataFrame, natural_id: str, key: str, as_of
) -> DataFrame:
    """Close versions that changed, open their successors, insert new ids.

    ``members`` must hold one row per natural id (see ``dedup.latest_version``). History is
    passed through unread by the join: only the current versions are matched, once, by a
    full outer join whose two sides are each unique on the id, so no key can be hot.
    """
    as_of = instant(as_of)
    cols = dim.columns
    history = dim.where(~F.col("Is_Current"))
    old = current(dim).select(F.struct(*cols).alias("old"), F.col(natural_id).alias("_old_id"))
    new = open_versions(members, as_of).select(
        F.struct(*cols).alias("new"), F.col(natural_id).alias("_new_id")
    )
    both = old.join(new, F.col("_old_id") == F.col("_new_id"), "fullouter")
    changed = (
        F.col("old").isNotNull() & F.col("new").isNotNull()
        & (F.col(f"old.{key}") != F.col(f"new.{key}"))
    )
    brand_new = F.col("old").isNull()
    closed = F.struct(
        *[
            as_of.alias(c) if c == "Expiration_Date"
            else F.lit(False).alias(c) if c == "Is_Current"
            else F.col(f"old.{c}").alias(c)
            for c in cols
        ]
    )
    first_seen = F.struct(
        *[
            instant(FIRST_INSTANT).alias(c) if c == "Effective_Date" else F.col(f"new.{c}").alias(c)
            for c in cols
        ]
    )
    versions = both.select(
        F.explode(
            F.when(changed, F.array(closed, F.col("new")))
            .when(brand_new, F.array(first_seen))
            .otherwise(F.array(F.col("old")))
        ).alias("v")
    ).select("v.*")
    return history.unionByName(versions)


def snapshot_check(
    history: DataFrame, members: DataFrame, unique_key: str, check: str, as_of
) -> DataFrame:
    """Snapshot with the check strategy: a new version whenever ``check`` differs."""
    return apply_changes(history, members, unique_key, check, as_of)


def as_of_lookup(
    rows: DataFrame,
    dim: DataFrame,
    row_id: str,
    row_time: str,
    natural_id: str,
    key: str,
    spread_by: str,
) -> DataFrame:
    """Key of the version valid at ``row_time``; equi join on the id, interval as residual.

    The versions of one id tile the time line, so each row keeps at most one match.
    """
    versions = dim.select(
        F.col(natural_id).alias("_vid"), F.col(key),
        F.col("Effective_Date").alias("_from"), F.col("Expiration_Date").alias("_until"),
    )
    valid = (F.col(row_time) >= F.col("_from")) & (F.col(row_time) < F.col("_until"))
    return lookup_join(
        rows, versions, row_id, "_vid", spread_by, condition=valid
    ).drop("_vid", "_from", "_until")
