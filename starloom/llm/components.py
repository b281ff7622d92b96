"""Connected components of links, as DataFrame rounds: a distributed union-find.

Every round hangs each node's larger neighbours under its least neighbour (large star), then its
smaller ones (small star); paths shorten by half or more. Nodes may be of any type with an
order. Each round is written to the shared folder, and rounds go on until every node hangs under
a root. While the counted nodes are few, the least neighbours are broadcast, so that no edge is
moved to meet them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.llm.arrow import discard, stored, together


#: nodes of which the least neighbours may be broadcast (two numbers each)
BROADCAST_NODES = 500_000


def _looked_at(edges: DataFrame) -> tuple[int, int]:
    """Nodes of the edges, and those that hang under several or under one that hangs itself."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"))))
    nodes = edges.select(ends.alias("e")).select("e.*").groupBy("node").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
    loose = (F.col("up") > 0) & (F.col("n") > 1)
    return tuple(nodes.agg(F.count(F.lit(1)), F.count(F.when(loose, 1))).first())


def _stars(edges: DataFrame, few: bool) -> DataFrame:
    hint = F.broadcast if few else lambda df: df
    both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    large = both.join(hint(least), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    large = large.where("u <> v")
    if not few:  # both uses below read what was moved here; a few edges may stay equal till the end
        large = large.distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(hint(least), "u").select(
        F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    small = small.select("e.*").where("u > v").distinct()
    return together(small) if few else small


def components(links: DataFrame, a: str = "a", b: str = "b", few: bool = False) -> DataFrame:
    """``id`` and ``root`` (least node reachable) of every linked node but the roots themselves.

    Loops, repeated links and nulls in either end are ignored; no links give no rows. ``few`` tells
    that the caller counted few links.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u > v").distinct()
    edges = stored(together(edges) if few else edges, "links")
    nodes, loose = _looked_at(edges)
    while loose:
        last, edges = edges, stored(_stars(edges, nodes <= BROADCAST_NODES), "stars")
        discard(last)
        nodes, loose = _looked_at(edges)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
