"""Decontamination against a plain search of every window at every place."""

import random
import re

import pytest

from starloom.llm import decontamination
from tests.llm.fixtures import CLASHING, ODD_TEXTS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def worded(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    cut = {}
    for item, text in items:
        w = worded(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            cut.setdefault(tuple(w[i : i + window]), set()).add(item)
    sizes = {len(c) for c in cut}
    out = []
    for doc, text in docs:
        w, hit, found = worded(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (run := tuple(w[i : i + n])) in cut:
                    hit |= set(range(i, i + n))
                    found |= cut[run]
        out.append((doc, len(w), len(hit), sorted(str(f) for f in found if f is not None), stretches(hit)))
    return sorted(out, key=repr)


def stretches(hit):
    out = []
    for i in sorted(hit):
        if out and out[-1][0] + out[-1][1] == i:
            out[-1] = (out[-1][0], out[-1][1] + 1)
        else:
            out.append((i, 1))
    return out


def frames(spark, docs, items):
    names = ", ".join(f"{c} string" for c in CLASHING if c not in ("doc_id", "item_id", "text"))
    clash = ["z"] * len(CLASHING)
    return (spark.createDataFrame([(*d, *clash) for d in docs], f"doc_id long, text string, {names}"),
            spark.createDataFrame([(*i, *clash) for i in items], f"item_id long, text string, {names}"))


def found(spark, docs, items, **more):
    rows = decontamination.decontaminate(*frames(spark, docs, items), **more).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), [(s["first"], s["number"]) for s in r.spans]) for r in rows), key=repr)


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdef" for b in ("", "é", "7", "x")]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 5, 9, 10, 11, 30]) if i % 4 == 0 else 25)) for i in range(24)]
    items = [(i, t if len(t.split()) > 3 else f"q{i} {t}") for i, t in items]
    docs = []
    for i in range(120):
        w = say(rng.choice([0, 3, 9, 10, 60, 300])).split()
        for _ in range(rng.choice([0, 0, 1, 3])):
            passage = rng.choice(items)[1].split()
            lo = rng.randrange(len(passage))
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[lo : lo + rng.choice([8, 10, 12, 40])] if rng.random() < 0.5 else passage
        docs.append((i, rng.choice([" ", ", ", "\n", " - "]).join(w).title()))
    return docs, items


@pytest.mark.parametrize("bound", [1 << 20, -1])
def test_equals_brute_force(spark, bound):
    docs, items = case(1)
    expected = brute(docs, items)
    assert sum(r[2] > 0 for r in expected) > 30
    assert found(spark, docs, items, broadcast_bytes=bound) == expected


def test_other_windows(spark):
    docs, items = case(2)
    for window, shingle in ((3, 2), (6, 6), (1, 5)):
        assert found(spark, docs, items, window=window, shingle=shingle) == brute(docs, items, window)


@pytest.mark.parametrize("bound", [1 << 20, -1])
def test_odd_texts_null_and_repeated_ids(spark, bound):
    passage = "the quick brown fox jumps over the lazy dog and runs away"
    docs = list(enumerate([*ODD_TEXTS, passage, passage.upper().replace(" ", "--"), passage[4:], f"x {passage} {passage}"]))
    docs += [(None, passage), (None, "nothing"), (3, passage), (3, passage), (3, None)]
    items = [(1, passage), (1, "emoji é"), (2, passage), (None, "a"), (4, None), (5, " \n"), (6, "the " * 12), (10, "wide")]
    expected = brute(docs, items)
    assert found(spark, docs, items, broadcast_bytes=bound) == expected
    assert sum(r[0] == 3 and r[2] > 0 for r in expected) == 2


def test_empty_tables(spark):
    docs, items = [(1, "a b c")], [(1, "a b")]
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == [(1, 3, 0, [], [])]
    assert found(spark, docs, [(1, None)]) == [(1, 3, 0, [], [])]


def test_a_shared_passage_in_a_third_of_the_documents(spark):
    rng = random.Random(3)
    shared = " ".join(f"s{i}" for i in range(40))
    own = lambda n: " ".join(f"o{rng.randrange(10 ** 6)}" for _ in range(n))
    docs = [(i, f"{own(30)} {shared} {own(30)}" if i % 3 == 0 else own(80)) for i in range(600)]
    items = [(i, f"{own(5)} {shared}") for i in range(30)]
    rows = found(spark, docs, items)
    assert rows == brute(docs, items)
    assert {r[2] for r in rows} == {0, 40}


def test_very_long_text(spark):
    rng = random.Random(4)
    long = " ".join(f"w{rng.randrange(3000)}" for _ in range(150_000))
    words = long.split()
    items = [(i, " ".join(words[i * 997 : i * 997 + 14])) for i in range(60)]
    assert found(spark, [(1, long), (2, "short")], items) == brute([(1, long), (2, "short")], items)


def test_plan_moves_no_text_and_calls_no_python(spark):
    docs, items = case(5)
    plan = decontamination.occurrences(*frames(spark, docs, items))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
