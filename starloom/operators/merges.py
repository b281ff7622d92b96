"""Table mutations as functions from (target, source) to rows.

``*_delta`` functions return only the rows to append; the others return the whole new
content. Neither writes anything, see ``starloom.sources.sinks``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.functions.keys import UNKNOWN_KEY


def insert_only_delta(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is new. Only the key columns of the target are read."""
    fresh = source.dropDuplicates(list(keys))
    return fresh.join(target.select(*keys), list(keys), "leftanti").select(*target.columns)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.unionByName(insert_only_delta(target, source, keys))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    source_keys: DataFrame | None = None,
) -> DataFrame:
    """Matched rows take every column of the source, unmatched source rows are inserted.

    ``source_keys`` may name the source's keys more cheaply than its full plan does. A source
    with two rows of one key says nothing certain about it: the job fails, when it runs.
    """
    named = source.select(*keys) if source_keys is None else source_keys.select(*keys)
    counted = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    checked = counted.where(
        F.when(F.col("_n") > 1, F.raise_error(F.lit("merge source has a key twice")).cast("boolean"))
        .otherwise(F.lit(True))
    ).drop("_n")
    kept = target.join(checked, list(keys), "leftanti")
    return source.select(*target.columns).unionByName(kept.select(*target.columns))


def stale_sentinels(target: DataFrame, source: DataFrame, group: str, member: str) -> DataFrame:
    """Sentinel rows of the target whose group occurs in the source."""
    groups = source.select(group).distinct()
    return target.where(F.col(member) == UNKNOWN_KEY).join(groups, group, "leftsemi")


def refresh_bridge(target: DataFrame, source: DataFrame, group: str, member: str) -> DataFrame:
    """Drop sentinels the source has news about, then insert unknown (group, member) pairs.

    Every group of the source has all its pairs there, its own sentinel included. The result
    is therefore the distinct union of the real target pairs and the source, plus the
    sentinels of groups the source does not mention: one hash aggregate, and an anti join
    that only sentinels enter.
    """
    is_sentinel = F.col(member) == UNKNOWN_KEY
    pairs = target.where(~is_sentinel).select(group, member).unionByName(
        source.select(group, member)
    ).distinct()
    groups = source.select(F.col(group).alias("_g")).distinct()
    kept = target.where(is_sentinel).join(groups, F.col(group) == F.col("_g"), "leftanti")
    return pairs.unionByName(kept.select(group, member))
