"""Graph jobs. Part and supplier numbers share one id space, so the line items form a general
graph; orders and customers form another."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.graphs import algorithms as g
from starloom.registry.base import Inputs, Registry

REGISTRY = Registry()
query = REGISTRY.query


def _supply(x: Inputs):
    return x.tables["lineitem"].select(
        F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


SUPPLY = "SELECT DISTINCT l_partkey AS src, l_suppkey AS dst FROM lineitem"


def _rank_sql(edges: str, rounds: int) -> str:
    steps = [f"e AS ({edges})", "d AS (SELECT src, count(*) AS degree FROM e GROUP BY 1)",
             "r0 AS (SELECT src AS id, CAST(1 AS DOUBLE) AS rank FROM d)"]
    for i in range(rounds):
        steps.append(
            f"r{i + 1} AS (SELECT e.dst AS id, sum(r.rank / d.degree) * 0.85::DOUBLE "
            f"+ 0.15::DOUBLE AS rank FROM e JOIN d ON d.src = e.src JOIN r{i} r ON r.id = e.src "
            "GROUP BY 1)")
    return "WITH " + ", ".join(steps)


@query(_rank_sql(SUPPLY, 4) + " SELECT id, round(rank, 6) AS rank FROM r4")
def b_page_rank(x: Inputs):
    return g.page_rank(_supply(x), 4).select("id", F.round("rank", 6).alias("rank"))


@query()
def b_page_rank_until(x: Inputs):
    """Until no rank moves by a twentieth; compared with an independent loop in the tests."""
    return g.page_rank_until(_supply(x), 0.05).select("id", F.round("rank", 1).alias("rank"))


@query(_rank_sql("SELECT DISTINCT src, dst FROM (" + SUPPLY + ") a JOIN supplier s ON s.s_suppkey "
                 "= a.src JOIN supplier t ON t.s_suppkey = a.dst WHERE s.s_acctbal > 0 AND "
                 "t.s_acctbal > 0", 3)
       + " SELECT s_suppkey AS id, s_name AS name, round(coalesce(rank, 0), 6) AS rank FROM supplier"
       " LEFT JOIN r3 ON r3.id = s_suppkey WHERE s_acctbal > 0 "
       "ORDER BY round(coalesce(rank, 0), 6) DESC, 1 LIMIT 5")
def b_top_ranked(x: Inputs):
    """Vertices with a name and a positive balance; the five highest ranks among them."""
    vertices = x.tables["supplier"].where("s_acctbal > 0").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return g.top_ranked(_supply(x), vertices, 3, 5).withColumn("rank", F.round("rank", 6))


@query("""
    WITH RECURSIVE e AS (SELECT o_orderkey AS a, o_custkey AS b FROM orders
            UNION SELECT o_custkey, o_orderkey FROM orders),
    cc(id, component) USING KEY (id) AS (
        SELECT DISTINCT a, a FROM e
        UNION
        (SELECT u.id, min(v.component) FROM recurring.cc u JOIN e ON e.a = u.id
            JOIN cc v ON v.id = e.b WHERE v.component < u.component GROUP BY u.id))
    SELECT id, component FROM cc""")
def b_connected_components(x: Inputs):
    edges = x.tables["orders"].select(
        F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst"))
    return g.connected_components(edges)


@query(f"""
    WITH p AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM ({SUPPLY}) s
        WHERE src <> dst),
    t AS (SELECT x.a AS i, x.b AS j, y.b AS k FROM p x JOIN p y ON y.a = x.b
        JOIN p z ON z.a = x.a AND z.b = y.b)
    SELECT id, count(*) AS triangles FROM (SELECT i AS id FROM t UNION ALL SELECT j FROM t
        UNION ALL SELECT k FROM t) u GROUP BY 1""")
def b_triangle_count(x: Inputs):
    return g.triangle_counts(_supply(x))


@query("""
    WITH RECURSIVE w AS (SELECT a, b, min(q) AS q FROM (
            SELECT l_partkey AS a, l_suppkey AS b, CAST(l_quantity AS BIGINT) AS q FROM lineitem
            UNION ALL SELECT l_suppkey, l_partkey, CAST(l_quantity AS BIGINT) FROM lineitem) l
        GROUP BY 1, 2),
    s(id, distance) USING KEY (id) AS (
        SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT)
        UNION
        (SELECT w.b, min(c.distance + w.q) FROM s c JOIN w ON w.a = c.id
            LEFT JOIN recurring.s k ON k.id = w.b
            WHERE k.id IS NULL OR c.distance + w.q < k.distance GROUP BY w.b))
    SELECT id, distance FROM s""")
def b_shortest_paths(x: Inputs):
    """Cheapest way from vertex 0 over supply links in either direction."""
    links = x.tables["lineitem"].select(
        F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"),
        F.col("l_quantity").cast("bigint").alias("weight"))
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    return g.shortest_paths(links.unionByName(back), 0)


TREE = """SELECT 'o' || o_orderkey AS src, 'c' || o_custkey AS dst FROM orders
    UNION SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
    UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation"""


@query(f"""WITH RECURSIVE e AS ({TREE}), t AS (SELECT src, dst FROM e UNION
    SELECT t.src, e.dst FROM t JOIN e ON e.src = t.dst) SELECT src, dst FROM t""")
def b_transitive_closure(x: Inputs):
    """Everything above an order, a customer or a nation."""

    def named(table, child, parent):
        return x.tables[table].select(
            F.concat(F.lit(child[0]), F.col(child[1]).cast("string")).alias("src"),
            F.concat(F.lit(parent[0]), F.col(parent[1]).cast("string")).alias("dst"))

    edges = (
        named("orders", ("o", "o_orderkey"), ("c", "o_custkey"))
        .unionByName(named("customer", ("c", "c_custkey"), ("n", "c_nationkey")))
        .unionByName(named("nation", ("n", "n_nationkey"), ("r", "n_regionkey")))
    )
    return g.transitive_closure(edges)


@query(f"""SELECT e.dst AS id, count(*) AS followers, CAST(sum(a.p_size) AS DOUBLE) / count(*)
    AS mean_age FROM ({SUPPLY}) e JOIN part a ON a.p_partkey = e.src
    JOIN part b ON b.p_partkey = e.dst WHERE a.p_size > b.p_size GROUP BY 1""")
def b_older_followers(x: Inputs):
    ages = x.tables["part"].select(F.col("p_partkey").alias("id"), F.col("p_size").alias("age"))
    return g.older_followers(_supply(x).distinct(), ages)
