"""Graph jobs against plain Python on small random graphs."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starloom.graphs import algorithms as g
from tests.conftest import rows

RNG = random.Random(5)
EDGES = sorted({(RNG.randrange(30), RNG.randrange(30)) for _ in range(45)})


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "src bigint, dst bigint")


def test_components(edges):
    root = {v: v for e in EDGES for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in EDGES:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert rows(g.connected_components(edges)) == sorted(
        ((v, find(v)) for v in root), key=lambda t: str(t[0]))


def test_components_of_a_long_chain(spark):
    chain = spark.range(200).selectExpr("id AS src", "id + 1 AS dst")
    out = g.connected_components(chain)
    assert out.count() == 201 and out.select("component").distinct().count() == 1


def test_triangles(edges):
    near = defaultdict(set)
    for a, b in EDGES:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    want = {v: sum(1 for a in near[v] for b in near[v] if a < b and b in near[a]) for v in near}
    got = dict(rows(g.triangle_counts(edges)))
    assert got == {v: n for v, n in want.items() if n}


def test_wedges_stay_few_at_a_hub(spark):
    """A hub with half of all edges, and a clique: the hub's pairs of neighbours are never made."""
    n = 3000
    made = [(0, i) for i in range(1, n)] + [(a, b) for a in range(n, n + 40) for b in range(n, a)] + [(1, 2)]
    edges = spark.createDataFrame(made, "src long, dst long")
    arcs, open_ = g.wedges(edges)
    assert arcs.groupBy("src").count().agg(F.max("count")).first()[0] <= (2 * len(made)) ** 0.5
    assert open_.count() <= 40 * 39 * 38 // 6 + 3
    got = dict(rows(g.triangle_counts(edges)))
    assert got == {0: 1, 1: 1, 2: 1, **{v: 39 * 38 // 2 for v in range(n, n + 40)}}


def test_rank_until_stable(edges):
    out = defaultdict(set)
    ids = {v for e in EDGES for v in e}
    for a, b in EDGES:
        out[a].add(b)
    rank = dict.fromkeys(ids, 0.15)
    for _ in range(200):
        inflow = defaultdict(float)
        for a, targets in out.items():
            for b in targets:
                inflow[b] += rank[a] / len(targets)
        rank = {v: 0.15 + 0.85 * inflow[v] for v in ids}
    got = dict(rows(g.page_rank_until(edges, 0.01)))
    assert got.keys() == ids and all(abs(got[v] - rank[v]) < 0.1 for v in ids)


def test_shortest_paths(spark):
    weighted = [(a, b, 1 + (a * 7 + b) % 9) for a, b in EDGES]
    best = {0: 0}
    for _ in range(40):
        for a, b, w in weighted:
            if a in best and best[a] + w < best.get(b, 10**9):
                best[b] = best[a] + w
    df = spark.createDataFrame(weighted, "src bigint, dst bigint, weight bigint")
    assert dict(rows(g.shortest_paths(df, 0))) == best


def test_closure(edges):
    paths = set(EDGES)
    while True:
        more = {(a, d) for a, b in paths for c, d in EDGES if b == c} - paths
        if not more:
            break
        paths |= more
    assert {tuple(r) for r in g.transitive_closure(edges).collect()} == paths


def test_long_chains_are_followed_to_their_end(spark):
    chain = spark.createDataFrame([(i, i + 1, 1) for i in range(45)], "src long, dst long, weight long")
    components = {tuple(r) for r in g.connected_components(chain).collect()}
    assert components == {(i, 0) for i in range(46)}
    paths = {tuple(r) for r in g.shortest_paths(chain.where("src < 14"), 0).collect()}
    assert paths == {(i, i) for i in range(15)}
    closure = g.transitive_closure(chain.where("src < 12").select("src", "dst"))
    assert {tuple(r) for r in closure.collect()} == {(a, b) for a in range(13) for b in range(a + 1, 13)}
