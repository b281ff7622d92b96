"""Iterative graph jobs on edge relations with ``src`` and ``dst``.

Each round is one plan whose result is written to the shared folder, so the lineage stays one
round long and lost executors cost one round at most. Joins from edges to per-vertex rows go
through ``lookup_join`` because hubs make edge keys hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.config import fresh_dir
from starloom.operators.joins import lookup_join


def cut(df: DataFrame, label: str = "round") -> DataFrame:
    """Write the rows and go on from the written table."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pairs(df: DataFrame, *picks: tuple[str, str], names=("src", "dst")) -> DataFrame:
    """One row per pick, each pick naming the columns that become ``names``."""
    made = [F.struct(F.col(a).alias(names[0]), F.col(b).alias(names[1])) for a, b in picks]
    return df.select(F.explode(F.array(*made)).alias("_p")).select("_p.*")


def both_ways(edges: DataFrame) -> DataFrame:
    """Each edge in both directions, from one pass over the edges."""
    return _pairs(edges, ("src", "dst"), ("dst", "src"))


def undirected(edges: DataFrame) -> DataFrame:
    """Each pair once, smaller id first, no loops."""
    return (
        edges.where("src <> dst")
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .distinct()
    )


# --- rank --------------------------------------------------------------------------------

def _linked(edges: DataFrame) -> DataFrame:
    """Distinct edges with the out-degree of their source."""
    edges = edges.select("src", "dst").distinct()
    degree = edges.groupBy(F.col("src").alias("_d")).agg(F.count(F.lit(1)).alias("degree"))
    return lookup_join(edges, degree, "src", "_d", spread_by="dst", how="inner").drop("_d")


def _inflow(links: DataFrame, ranks: DataFrame) -> DataFrame:
    """Rank each vertex receives; summed map-side before the shuffle."""
    ranked = lookup_join(links, ranks, "src", "id", spread_by="dst", how="inner")
    return ranked.groupBy(F.col("dst").alias("id")).agg(
        F.sum(F.col("rank") / F.col("degree")).alias("inflow")
    )


def page_rank(edges: DataFrame, rounds: int) -> DataFrame:
    """Fixed number of rounds; ranks start at one and only linked-to vertices keep a rank."""
    links = cut(_linked(edges), "links")
    ranks = links.select(F.col("src").alias("id")).distinct().withColumn("rank", F.lit(1.0))
    for _ in range(rounds):
        ranks = cut(
            _inflow(links, ranks).select("id", (F.col("inflow") * 0.85 + 0.15).alias("rank")),
            "ranks",
        )
    return ranks


def page_rank_until(edges: DataFrame, tolerance: float) -> DataFrame:
    """Rounds until no rank moves by ``tolerance`` or more; every vertex keeps a rank.

    A round shrinks the largest move to at most 0.85 of the one before, so it always ends.
    """
    if tolerance <= 0:
        raise ValueError("ranks come arbitrarily close to their limit but need not reach it")
    links = cut(_linked(edges), "links")
    vertices = both_ways(links).select(F.col("src").alias("id")).distinct()
    ranks = cut(vertices.withColumn("rank", F.lit(0.15)), "ranks")
    while True:
        inflow = _inflow(links, ranks).withColumnRenamed("id", "_to")
        moved = ranks.join(inflow, F.col("id") == F.col("_to"), "left").select(
            "id", (F.coalesce("inflow", F.lit(0.0)) * 0.85 + 0.15).alias("rank"),
            F.col("rank").alias("_before"),
        )
        step = cut(moved, "ranks")
        largest = step.agg(F.max(F.abs(F.col("rank") - F.col("_before")))).first()[0]
        ranks = step.select("id", "rank")
        if largest is None or largest < tolerance:
            break
    return ranks


def top_ranked(edges: DataFrame, vertices: DataFrame, rounds: int, top: int) -> DataFrame:
    """Rank the subgraph induced by ``vertices`` (id, name) and report its first vertices."""
    ids = vertices.select(F.col("id").alias("_v"))
    inside = lookup_join(edges, ids, "src", "_v", spread_by="dst", how="inner").drop("_v")
    inside = lookup_join(inside, ids, "dst", "_v", spread_by="src", how="inner").drop("_v")
    ranks = page_rank(inside, rounds).withColumnRenamed("id", "_id")
    named = vertices.join(ranks, F.col("id") == F.col("_id"), "left").select(
        "id", "name", F.coalesce("rank", F.lit(0.0)).alias("rank")
    )
    return named.orderBy(F.desc(F.round("rank", 6)), "id").limit(top)


# --- components --------------------------------------------------------------------------

def _toward_min(pairs: DataFrame) -> DataFrame:
    """Add to each (u, v) the smallest id around u, including u."""
    least = pairs.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
    near = lookup_join(pairs, least, "u", "_u", spread_by="v", how="inner")
    return near.select("u", "v", F.least("u", "_m").alias("m"))


def _marked(pairs: DataFrame) -> tuple[DataFrame, tuple]:
    """The pairs, written, and a mark that tells sets of them apart. Not observed while they are
    written: a session that has observed anything can no longer ship binary classifiers."""
    written = cut(pairs)
    return written, tuple(written.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest vertex id of each vertex's component.

    Alternating large-star and small-star contraction until nothing moves: the number of rounds
    grows with the logarithm of the graph, not with its diameter. Leaves, vertices whose one
    neighbour is smaller, are settled by it: they are set aside before and take its component
    afterwards.
    """
    ids = both_ways(edges).select(F.col("src").alias("id")).distinct()
    whole = cut(undirected(edges).select(F.col("dst").alias("u"), F.col("src").alias("v")), "pairs")
    leaves = cut(
        _pairs(whole, ("u", "v"), ("v", "u"), names=("u", "v"))
        .groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("v"))
        .where("n = 1 AND v < u").select(F.col("u").alias("_leaf"), F.col("v").alias("_at")), "leaves")
    pairs, mark = _marked(whole.join(leaves, F.col("u") == F.col("_leaf"), "leftanti"))
    while True:
        around = _pairs(pairs, ("u", "v"), ("v", "u"), names=("u", "v"))
        large = (
            _toward_min(around).where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        # written, not only planned: the size of a table is known, that of a join is guessed
        down = _toward_min(
            cut(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        )
        small = _pairs(down, ("v", "m"), ("u", "m"), names=("u", "v")).where("u <> v").distinct()
        pairs, after = _marked(small)
        if after == mark:
            break
        mark = after
    roots = pairs.select(F.col("u").alias("_u"), F.col("v").alias("_root"))
    settled = lookup_join(leaves, roots, "_at", "_u", spread_by="_leaf")
    roots = roots.unionByName(settled.select(F.col("_leaf").alias("_u"), F.coalesce("_root", "_at").alias("_root")))
    return ids.join(roots, F.col("id") == F.col("_u"), "left").select(
        "id", F.coalesce("_root", "id").alias("component")
    )


# --- triangles ---------------------------------------------------------------------------

def wedges(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(arcs, wedges): every edge once, from its end of lower degree to that of higher; and every
    pair of arcs that leave one vertex, as (u, v, w) with v before w in that order.

    A vertex has at most sqrt(2 * edges) arcs that leave it, so no key of the join is hot: a hub
    has nearly all its edges coming in.
    """
    pairs = cut(undirected(edges), "pairs")
    degree = both_ways(pairs).groupBy(F.col("src").alias("_d")).agg(F.count(F.lit(1)).alias("n"))
    degree = cut(degree, "degree")
    ends = lookup_join(
        pairs, degree.select(F.col("_d").alias("_a"), F.col("n").alias("_na")),
        "src", "_a", spread_by="dst", how="inner")
    ends = lookup_join(
        ends, degree.select(F.col("_d").alias("_b"), F.col("n").alias("_nb")),
        "dst", "_b", spread_by="src", how="inner")
    low, high = F.struct(F.col("_na").alias("n"), F.col("src").alias("id")), F.struct(F.col("_nb").alias("n"), F.col("dst").alias("id"))
    arcs = cut(ends.select(F.least(low, high).alias("low"), F.greatest(low, high).alias("high")).select(
        F.col("low.id").alias("src"), F.col("high.id").alias("dst"), F.col("high.n").alias("n")), "arcs")
    one = arcs.select(F.col("src").alias("u"), F.col("dst").alias("v"), F.col("n").alias("_nv"))
    two = arcs.select(F.col("src").alias("_u"), F.col("dst").alias("w"), F.col("n").alias("_nw"))
    before = (F.col("_nv") < F.col("_nw")) | ((F.col("_nv") == F.col("_nw")) & (F.col("v") < F.col("w")))
    return arcs, one.join(two, (F.col("u") == F.col("_u")) & before).select("u", "v", "w")


def triangle_counts(edges: DataFrame) -> DataFrame:
    """Triangles through each vertex that has any: wedges whose open side is an arc too.

    What is shuffled grows with the wedges; the closing arcs are unique, so a side that closes
    very many wedges is split by adaptive execution.
    """
    arcs, open_ = wedges(edges)
    closing = arcs.select(F.col("src").alias("_s"), F.col("dst").alias("_t"))
    closed = open_.join(closing, (F.col("v") == F.col("_s")) & (F.col("w") == F.col("_t")), "leftsemi")
    return closed.select(F.explode(F.array("u", "v", "w")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("triangles"))


# --- paths -------------------------------------------------------------------------------

def shortest_paths(edges: DataFrame, source) -> DataFrame:
    """Least total ``weight`` from ``source`` to each vertex it reaches.

    Only vertices whose distance improved in the last round send messages; rounds end when none
    did. Weights must not be negative, or a cycle could improve distances for ever.
    """
    spark = edges.sparkSession
    weights = cut(edges.groupBy("src", "dst").agg(F.min("weight").alias("weight")), "weights")
    known = cut(
        spark.range(1).select(F.lit(source).cast("bigint").alias("id"),
                              F.lit(0).cast("bigint").alias("distance"), F.lit(True).alias("fresh")),
        "distances")
    if not weights.where("weight < 0").isEmpty():
        raise ValueError("negative weights")
    while True:
        frontier = known.where("fresh").select("id", "distance")
        sent = lookup_join(weights, frontier, "src", "id", spread_by="dst", how="inner")
        best = sent.groupBy(F.col("dst").alias("_to")).agg(
            F.min(F.col("distance") + F.col("weight")).alias("_new"))
        known = cut(
            known.join(best, F.col("id") == F.col("_to"), "fullouter").select(
                F.coalesce("id", "_to").alias("id"), F.least("distance", "_new").alias("distance"),
                (F.col("_new").isNotNull()
                 & (F.col("distance").isNull() | (F.col("_new") < F.col("distance")))
                 ).alias("fresh")),
            "distances")
        if known.where("fresh").isEmpty():
            break
    return known.select("id", "distance")


def transitive_closure(edges: DataFrame) -> DataFrame:
    """All (src, dst) with a path. A round extends only the pairs the last round found, and
    writes only what it finds; the result has one row per pair by definition."""
    spark, folder = edges.sparkSession, fresh_dir(edges.sparkSession, "closure")

    def keep(pairs: DataFrame, n: int) -> DataFrame:
        path = f"{folder}/round={n}"
        pairs.write.parquet(path)
        return spark.read.schema(pairs.schema).parquet(path)

    found, n = keep(edges.select("src", "dst").distinct(), 0), 0
    nexts = found.select(F.col("src").alias("_via"), F.col("dst").alias("_end"))
    while not found.isEmpty():
        longer = (
            lookup_join(found, nexts, "dst", "_via", spread_by="src", how="inner")
            .select("src", F.col("_end").alias("dst")).distinct()
        )
        known = spark.read.schema(found.schema).parquet(*[f"{folder}/round={i}" for i in range(n + 1)])
        n += 1
        found = keep(longer.join(known, ["src", "dst"], "leftanti"), n)
    return spark.read.schema(found.schema).parquet(*[f"{folder}/round={i}" for i in range(n + 1)])


def older_followers(edges: DataFrame, ages: DataFrame) -> DataFrame:
    """Per vertex: number and mean age of the followers older than it.

    ``ages`` has ``id`` and ``age``; messages are summed map-side.
    """
    here = ages.select(F.col("id").alias("_s"), F.col("age").alias("_sa"))
    there = ages.select(F.col("id").alias("_t"), F.col("age").alias("_ta"))
    both = lookup_join(edges, here, "src", "_s", spread_by="dst", how="inner")
    both = lookup_join(both, there, "dst", "_t", spread_by="src", how="inner")
    return both.where("_sa > _ta").groupBy(F.col("dst").alias("id")).agg(
        F.count(F.lit(1)).alias("followers"),
        (F.sum("_sa").cast("double") / F.count(F.lit(1))).alias("mean_age"),
    )
