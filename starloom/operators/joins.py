"""Key lookups that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Estimates are of compressed columns and narrow strings, so a table may be several times larger
# in memory; the limit leaves room for that.
BROADCAST_LIMIT_BYTES = 16 * 1024 * 1024
# A task joins about this many rows of one key at most; rows without a key go to so many places.
ROWS_PER_TASK = 2_000_000
NULL_SALTS = 256
HOT_SHARE = 1_000
OWN_COLUMNS = {"_hot", "_salts", "_salt", "_lhot", "_lsalts", "_lsalt"}


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return estimated_bytes(df) <= limit


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """Keys owning at least ``1/share`` of the rows: never more than ``share`` of them.

    Counting combines map-side, so a hot key reaches the shuffle as one row per task.
    """
    total = df.agg((F.count(F.lit(1)) / F.lit(share)).alias("_cut"))
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).count()
    return counts.where(F.col("count") >= total.scalar()).select("_hot")


def key_salts(rows: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(role, _hot, _salts): for each key column the values with more than ``rows_per_task``
    rows and over how many tasks their rows go. One pass over ``rows`` for all columns, counted
    map-side; there are at most rows / ``rows_per_task`` such values per column."""
    roles = F.array(*[F.struct(F.lit(k).alias("role"), F.col(k).cast("string").alias("_hot")) for k in keys])
    counts = rows.select(F.explode(roles).alias("_r")).select("_r.*").where("_hot is not null")
    counts = counts.groupBy("role", "_hot").agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > rows_per_task).select(
        "role", "_hot", F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    row_key: str,
    lookup_key: str,
    spread_by: str,
    how: str = "left",
    condition: Column | None = None,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    salts: DataFrame | bool | None = None,
) -> DataFrame:
    """Join many ``rows`` to a ``lookup`` with few rows per ``lookup_key`` (left or inner).

    A lookup below the limit is broadcast and nothing is shuffled. Otherwise both sides are
    shuffled on the key plus a salt. Only keys with more than ``rows_per_task`` rows get more
    than one salt, as many as their rows ask for; the lookup rows of just these are repeated.
    ``salts`` may name them (``key_salts`` of an earlier, narrower form of ``rows``), so that
    ``rows`` is not computed a second time for the counts; False says that there are none. Rows without a key match nothing
    and are spread by ``spread_by``. Column names of the two sides must differ.
    """
    if clash := OWN_COLUMNS & {*rows.columns, *lookup.columns}:
        raise ValueError(f"columns named as the join's own: {sorted(clash)}")
    extra = F.lit(True) if condition is None else condition
    if fits_broadcast(lookup, broadcast_limit):
        on = (F.col(row_key) == F.col(lookup_key)) & extra
        return rows.join(F.broadcast(lookup), on, how)
    if salts is False:
        spread, repeated = rows.withColumn("_salts", F.lit(1)), lookup.withColumn("_lsalt", F.lit(0))
    else:
        salts = key_salts(rows, [row_key], rows_per_task) if salts is None else salts
        hot = salts.where(F.col("role") == row_key).drop("role")
        spread = rows.join(F.broadcast(hot), F.col(row_key).cast("string") == F.col("_hot"), "left")
        repeated = lookup.join(
            F.broadcast(hot.select(F.col("_hot").alias("_lhot"), F.col("_salts").alias("_lsalts"))),
            F.col(lookup_key).cast("string") == F.col("_lhot"),
            "left",
        ).withColumn("_lsalt", F.explode(F.sequence(F.lit(0), F.coalesce("_lsalts", F.lit(1)) - 1)))
    places = F.when(F.col(row_key).isNull(), F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = spread.withColumn("_salt", F.pmod(F.xxhash64(F.col(spread_by)), places).cast("int"))
    on = (F.col(row_key) == F.col(lookup_key)) & (F.col("_salt") == F.col("_lsalt")) & extra
    return salted.join(repeated, on, how).drop(*OWN_COLUMNS)


def without_child(parents: DataFrame, parent_id: str, children: DataFrame, child_ref: str):
    """Parents no child refers to.

    The child side is first reduced to its distinct references, which combines map-side, so
    a parent with very many children does not skew the anti join.
    """
    refs = children.select(F.col(child_ref).alias("_ref")).where("_ref is not null").distinct()
    return parents.join(refs, parents[parent_id] == refs["_ref"], "leftanti")
