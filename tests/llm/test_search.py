"""Searches against brute force, and the pipeline."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import neighbours, topk
from tests.llm.fixtures import ODD_TEXTS, documents, prose
from tests.llm.test_near import words


def brute_bm25(texts, queries, k):
    tf = [Counter(words(t)) for t in texts]
    mean = sum(sum(c.values()) for c in tf) / len(tf)
    df = Counter(w for c in tf for w in c)
    out = {}
    for q in queries:
        scored = []
        for d, c in enumerate(tf):
            dl = sum(c.values())
            s = [math.log1p((len(tf) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * dl / mean)) for w in tf[q] if w in c]
            if s:
                scored.append((-round(sum(s), 6), d))
        out.update({(q, i + 1): (d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])})
    return out


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_WORDS", 3000)  # many shards
    monkeypatch.setattr(topk, "BLOCK", 4)
    monkeypatch.setattr(topk, "OPENED", 2)
    texts = [prose(s, 20 + s, 60 if s % 2 else 3000) for s in range(150)] + [prose(20, 40, 60)] * 15 + ODD_TEXTS
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in topk.search(documents(spark, texts)).collect()}
    want = brute_bm25(texts, [i for i in range(len(texts)) if i % 20 == 0], topk.K)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 2e-6 for k in want)


def test_top_k_of_odd_tables(spark):
    assert topk.search(documents(spark, ["x"]).limit(0)).count() == 0
    assert topk.search(documents(spark, [None, "", "  "])).count() == 0
    rows = [(0, "a b"), (None, "a b"), (1, "a"), (1, "a"), (20, None)]
    got = topk.search(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["query_id"], r["rank"], r["doc_id"]) for r in got) == [(0, 1, 0), (0, 2, 1), (0, 3, 1)]


def common_and_rare(n):
    """Texts of few common words, each in a third of them, and of some rare ones."""
    rng = random.Random(5)
    return [" ".join([f"c{j}" for j in rng.sample(range(60), 20)] * rng.randrange(1, 3) + [f"r{rng.randrange(n)}" for _ in range(3)]) for _ in range(n)]


@pytest.mark.parametrize("few", [0, 2])  # all queries through the product, none
def test_top_k_with_common_words(spark, monkeypatch, few):
    for name, value in {"FEW": few, "BLOCK": 4, "SHARD_WORDS": 1500, "QUERY_TERMS": 200, "SCORES": 500, "OPENED": 50}.items():
        monkeypatch.setattr(topk, name, value)
    texts = common_and_rare(300)
    texts += [texts[20]] * 15 + ["alone", "c1", "", None]
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in topk.search(documents(spark, texts)).collect()}
    want = brute_bm25(texts, [i for i in range(len(texts)) if i % 20 == 0], topk.K)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 2e-6 for k in want)


def test_common_words_are_not_opened_in_every_document(spark, monkeypatch):
    opened, places = [], topk._places
    monkeypatch.setattr(topk, "_places", lambda start, size: opened.append(int(size.sum())) or places(start, size))
    texts = common_and_rare(2000)
    part = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    term, row, _, _ = topk._terms(part)
    known, n = np.unique(term, return_counts=True)
    common = known[n * topk.COMMON_IN >= len(texts)]
    stats = topk.Statistics(len(texts), 33.0, common, np.zeros(0))
    stats.weights = stats.weight(n[n * topk.COMMON_IN >= len(texts)].astype(float))
    shard = topk.Shard(stats, 10)
    shard.add(part)
    shard.close()
    mine = row < 100
    term, row = term[mine], row[mine]
    is_common = np.isin(term, common)
    first = [np.append(0, np.cumsum(np.bincount(row[of], minlength=100))) for of in (~is_common, is_common)]
    queries = topk.Queries(term[~is_common], n[np.searchsorted(known, term[~is_common])], first[0], np.searchsorted(common, term[is_common]), first[1])
    row, _, _ = shard.search(queries, np.zeros(100))
    assert np.bincount(row).tolist() == [10] * 100
    # every posting of every word would be 20 words in a third of 2,000 documents for each query
    assert sum(opened) < 0.1 * 100 * 20 * 2000 / 3


def test_later_shards_have_to_reach_the_best_so_far():
    best = topk.Best(2, 2)
    best.add(np.array([0, 0, 1]), [5, 7, 9], np.array([1.0, 3.0, 2.0]))
    assert best.least.tolist() == [1.0, 0.0]
    best.add(np.array([0, 0, 1]), [4, 3, 1], np.array([1.0, 0.5, 2.0]))
    assert (best.row.tolist(), best.ids, best.score.tolist()) == ([0, 0, 1, 1], [7, 4, 1, 9], [3.0, 1.0, 2.0, 2.0])
    assert best.least.tolist() == [1.0, 2.0]


def vectors(n, size=24, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(12, size))[rng.integers(0, 12, n)] + 0.7 * rng.normal(size=(n, size))).astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "z", 1.0) for i, v in rows], "vec_id long, embedding array<float>, raw string, score double")


def brute_neighbours(rows, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for at in np.flatnonzero(ids % 50 == 0):
        score = np.round(x @ x[at], 12)
        score[at] = -9
        out[int(ids[at])] = [(int(ids[j]), score[j]) for j in np.lexsort((ids, -score))[: min(k, len(ids) - 1)]]
    return out


def test_neighbours_recall(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 60)  # every list is split
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    monkeypatch.setattr(neighbours, "MOST_LISTS", 12)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(3000))]
    want = brute_neighbours(rows)
    got = {}
    for r in neighbours.search(frame(spark, rows)).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert got.keys() == want.keys() and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    x = {i: np.array(v, np.float64) for i, v in rows}
    for q, g in got.items():
        ranked = [g[r] for r in sorted(g)]
        assert ranked == sorted(ranked, key=lambda p: (-p[1], p[0]))
        for v, s in ranked:
            assert abs(s - x[q] @ x[v] / np.linalg.norm(x[q]) / np.linalg.norm(x[v])) < 1e-12


def test_neighbours_with_a_hot_vector_and_ties(spark):
    rng = random.Random(1)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(400))]
    hot = rows[7][1]
    rows = [(i, hot if rng.random() < 0.4 or i == 50 else v) for i, v in rows]
    want = brute_neighbours(rows)
    got = {}
    for r in neighbours.search(frame(spark, rows)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [v for v, _ in w] for q, w in want.items()}


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 0.0]), (50, [0.0, 0.0]), (100, None), (1, [2.0, 0.0])]
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in neighbours.search(frame(spark, rows)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 0.0)]
    assert neighbours.search(frame(spark, rows).limit(0)).count() == 0
    assert neighbours.search(frame(spark, rows).where(F.col("vec_id") == 3)).count() == 0


def test_posting_lists_hold_every_vector():
    x = vectors(2000).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = neighbours.fit(x, 100)
    graph = neighbours.CentroidGraph(centres)
    rows, lists = graph.lists_of(x)
    assert set(rows.tolist()) == set(range(len(x))) and len(rows) <= neighbours.REPLICAS * len(x)
    assert np.bincount(lists, minlength=100).max() < 12 * len(rows) / 100
    near, _ = graph.search(x, 1)
    assert np.mean(near[:, 0] == (x @ centres.T).argmax(1)) > 0.95


def test_lists_opened_grow_with_the_lists():
    # vectors without clusters: no list is much nearer than the next
    x = np.random.default_rng(4).normal(size=(20_000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = neighbours.CentroidGraph(neighbours.fit(x, 2048, rounds=3))
    queries = np.arange(0, 20_000, 400)
    score = x[queries] @ x.T
    score[np.arange(len(queries)), queries] = -9
    want = np.argsort(-score, axis=1)[:, :5]
    opened = [set() for _ in queries]
    for q, at in zip(*graph.visited(x[queries])):
        opened[q].add(at)
    assert max(map(len, opened)) > 64
    held = {v: set() for v in want.ravel().tolist()}
    names = np.array(sorted(held))
    for v, at in zip(*graph.lists_of(x[names])):
        held[int(names[v])].add(at)
    assert np.mean([bool(held[v] & opened[q]) for q in range(len(queries)) for v in want[q].tolist()]) >= 0.9


def test_documents_of_short_lines_stay(spark):
    import corpus_pipeline

    licence = "This text is licensed to everyone, as it is"
    own = ["\n".join(f"verse {i} {w}" for w in ("one", "two", "six")) for i in range(4)]
    texts = [licence] + [f"{licence}\n{x}" for x in own] + [f"{licence}\n \n", " \n"]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.dedup_lines(spark, documents(spark, texts), "").collect()}
    assert got == {0: licence, **dict(enumerate(own, 1)), 6: " \n"}


def test_pipeline_stages(spark):
    import corpus_pipeline
    from tests.llm.test_near import brute_join, brute_lines
    from tests.llm.test_texts import SENTENCES

    rng = random.Random(2)
    base = [" ".join(rng.choice(SENTENCES["en"].split()) + rng.choice(["", "er", "ing", "s", "ly", "ed"]) for _ in range(90)) for _ in range(14)]
    passage = " ".join(rng.choice(SENTENCES["en"].split()) + str(rng.choice(["um", "ion", "al"])) for _ in range(60))
    texts = base + [base[0], base[1][:200] + " else " + base[1][200:]] + [f"{b[:250]} {passage} {b[250:]}"[::1] for b in base[5:7]]
    texts += ["12345 ### !!!", None, base[2] + "\n" + base[3]]
    docs = documents(spark, texts)
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in seen.collect()}
        out = stage(spark, seen, "").cache()
        if name == "language_id":
            assert {r["doc_id"] for r in out.collect()} == {i for i, t in enumerate(texts) if t and any(c.isalpha() for c in t)}
        elif name == "line_dedup":
            order = sorted(before)
            want = dict(zip(order, brute_lines([before[i] for i in order])))
            want = {i: t for i, t in want.items() if t == before[i] or any(len(x.strip()) >= 20 for x in t.split("\n"))}
            assert {r["doc_id"]: r["text"] for r in out.collect()} == want
        elif name == "ngram_jaccard_join":
            order = sorted(before)
            joined = brute_join([before[i] for i in order])
            assert {r["doc_id"] for r in out.collect()} == {order[i] for i, (_, root) in joined.items() if root == i}
        elif name == "substring_dedup":
            assert set(before) == {r["doc_id"] for r in out.collect()}
            assert sum(passage in r["text"] for r in out.collect()) <= 1
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            assert all(r["n_chars"] == len(r["text"] or "") for r in out.collect())
        seen = out
    assert {r["doc_id"] for r in seen.collect()} == set(before)
