"""Ranked search against plain scoring of every pair."""

import math
import random
import re
from collections import Counter

import pytest

from starloom.llm import ranked
from tests.llm.fixtures import CLASHING, ODD_TEXTS

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def termed(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    bags = [(d, Counter(termed(t))) for d, t in docs]
    n, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, []).extend(termed(text))
    out = []
    for item, query in asked.items():
        scored = []
        for doc, bag in bags:
            if doc is None or not bag:
                continue
            m = 25 + 75 * sum(bag.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in query if bag[t])
            if score > 0:
                scored.append((-score, doc))
        out += [(item, r, doc, -s) for r, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def frames(spark, docs, items):
    names = ", ".join(f"{c} string" for c in CLASHING)
    clash = ["z"] * len(CLASHING)
    return (spark.createDataFrame([(*d, *clash) for d in docs], f"doc_id long, text string, {names}"),
            spark.createDataFrame([(*i, *clash) for i in items], f"item_id long, text string, {names}"))


def found(spark, docs, items, parts=3, **more):
    d, i = frames(spark, docs, items)
    return sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in ranked.search(d.repartition(parts), i, **more).collect())


def case(seed, docs=400):
    rng = random.Random(seed)
    say = lambda n: " ".join(f"W{int(rng.paretovariate(0.6)) % 900}" for _ in range(n))
    rows = [(i * 3, say(rng.choice([1, 5, 30, 30, 200]))) for i in range(docs)]
    return rows, [(i, say(rng.choice([1, 3, 12, 40]))) for i in range(30)]


def test_equals_brute_force(spark):
    docs, items = case(1)
    expected = brute(docs, items)
    assert found(spark, docs, items) == expected
    assert found(spark, docs, items, buckets=16) == expected  # loose bounds, same results
    assert found(spark, docs, items, block_queries=7) == expected
    assert found(spark, docs, items, k=3) == brute(docs, items, 3)


def test_odd_texts_null_and_repeated_ids(spark):
    docs = list(enumerate(ODD_TEXTS)) + [(None, "wide tab"), (5, "wide x"), (5, "wide x"), (5, None), (40, "W-i-d-e tab,TAB")]
    items = [(1, "Wide tab"), (1, "x"), (2, None), (3, " - "), (None, "wide"), (4, "日本語のテキスト é"), (5, "the the"), (6, "nowhere")]
    expected = brute(docs, items)
    assert {r[0] for r in expected} == {1, 4, 5}
    assert found(spark, docs, items) == expected


def test_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same words here") for i in range(300, 0, -1)] + [(1000 + i, f"other text {i}") for i in range(100)]
    rows = found(spark, docs, [(7, "words")], parts=5)
    assert [r[2] for r in rows] == list(range(1, 11)) and rows == brute(docs, [(7, "words")])


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, " ")], [(1, "a")]) == []


def test_very_long_text(spark):
    rng = random.Random(2)
    docs = [(1, " ".join(f"t{rng.randrange(5000)}" for _ in range(200_000)))] + [(i, f"t{i} t{i + 1}") for i in range(2, 60)]
    items = [(1, "t5 t6 t7"), (2, " ".join(f"t{i}" for i in range(300)))]
    assert found(spark, docs, items) == brute(docs, items)


def test_bounds_hold_and_prune():
    docs, items = case(3, 3000)
    texts = [t.encode() for _, t in docs]
    hashes = [ranked.terms([t.encode()])[0] for _, t in items]
    queries = ranked.Queries([i for i, _ in items], hashes)
    bags = [set(termed(t)) for _, t in docs]
    name = {int(ranked.terms([t.encode()])[0][0]): t for _, text in items for t in termed(text)}
    df = [sum(name[int(h)] in b for b in bags) for h in queries.term]
    import numpy as np

    total = sum(len(termed(t)) for _, t in docs)
    queries.weigh(len(docs), np.array(df))
    batch = ranked.Batch(texts, len(docs), total, queries, ranked.BUCKETS)
    bounds = batch.bounds()
    doc, query = np.divmod(np.arange(bounds.size), len(items))
    exact = batch.scores(doc, query).reshape(bounds.shape)
    assert (bounds >= exact).all()
    best = ranked.Best(len(items), 10)
    best.search(batch, [d for d, _ in docs])
    assert best.scored < bounds.size / 10
    assert sorted((i, r, d, -s) for i, rows in zip(queries.ids, best.rows) for r, (s, d) in enumerate(sorted(rows), 1)) == brute(docs, items)


@pytest.mark.parametrize("length", [1, 10**6])
def test_large_counts_do_not_wrap(length):
    """75 * n * N beyond a long."""
    import numpy as np

    queries = ranked.Queries([1], [ranked.terms([b"a"])[0]])
    queries.weigh(10**12, np.array([5]))
    batch = ranked.Batch([b"a " * length], 10**12, 10**14, queries, 64)
    m = 25 + 75 * length * 10**12 // 10**14
    w = math.floor(1000 * math.log((2 * 10**12 + 2) / 11))
    assert batch.scores(np.array([0]), np.array([0]))[0] == w * (10**9 * length // (1000 * length + 8 * m))
