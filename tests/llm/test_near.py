"""Near-duplicate operators against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from starloom.llm import components, line_dedup, near, ngram_join, substring_dedup
from tests.llm.fixtures import ODD_TEXTS, documents, edited, prose


class Union:
    def __init__(self, names):
        self.up = {n: n for n in names}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def tie(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus():
    base = [prose(s, 40 + 30 * (s % 9)) for s in range(12)]
    texts = ODD_TEXTS + base + base[:4] + [base[1].upper()]
    for i, text in enumerate(base):
        texts += [edited(text, every, f"e{i}x{every}_") for every in (15, 40, 60, 100)]
    # a chain whose ends are not similar, a group with one shared passage, very short ones
    step = prose(77, 200).split()
    texts += [" ".join(step[:i] + [f"q{j}" for j in range(3 * i, 3 * i + 0)] + step[i + 5 * i :]) for i in range(1, 4)]
    texts += [" ".join([f"c{i}_{j}" if j < 4 * i else w for j, w in enumerate(step)]) for i in range(6)]
    passage = prose(99, 60)
    texts += [f"{prose(200 + i, 50 + i)} {passage} {prose(300 + i, 40)}" for i in range(8)]
    return texts + ["one two", "One two", "one two three", "one", "b a", None]


def brute_join(texts, size=3, percent=90):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    union = Union(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and sets[j] and 100 * both >= percent * len(x | sets[j]):
                union.tie(i, j)
    return {i: (len(x), union.find(i)) for i, x in enumerate(sets)}


def test_ngram_join_equals_brute_force(spark):
    texts = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similarity_join(documents(spark, texts)).collect()}
    assert got == brute_join(texts)


def test_ngram_join_of_repeated_ids_and_missing_ids(spark):
    a, b = prose(1, 50), prose(2, 50)
    rows = [(5, a), (3, a), (5, b), (7, b), (None, a), (9, None), (9, None)]
    got = sorted(((r["doc_id"], r["component_id"]) for r in ngram_join.similarity_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (5, 3), (7, 3), (None, None), (9, 9), (9, 9)], key=str)
    assert ngram_join.similarity_join(documents(spark, ["x"]).limit(0)).count() == 0


def test_joins_do_not_depend_on_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(near, "BROADCAST_ROWS", -1)
    texts = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similarity_join(documents(spark, texts)).collect()}
    assert got == brute_join(texts)
    check_lines(spark, [t for t in texts if t])


def test_prefix_tree_equals_pairwise_overlap():
    import numpy as np

    rng = random.Random(5)
    sets = [np.array(sorted(rng.sample(range(60), rng.randint(1, 40))), np.uint64) for _ in range(200)]
    sets += [sets[0], sets[1][:-1] if len(sets[1]) > 1 else sets[1]]
    tree = ngram_join.SetTree(sets)
    for percent in (30, 60, 90):
        for probe in sets[:60]:
            want = [i for i, s in enumerate(sets) if 100 * len(set(s) & set(probe)) >= percent * len(set(s) | set(probe))]
            assert sorted(tree.similar(probe, percent)) == want


@pytest.mark.parametrize("links", [
    [], [(1, 1), (None, 2), (3, None)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(30)] + [(50, i) for i in range(29, 60)],
    [(a, b) for a in range(8) for b in range(8)], [(9, 3), (3, 9), (7, 5), (5, 3)]])
def test_components(spark, links):
    union = Union({x for ab in links for x in ab if x is not None})
    for a, b in links:
        if a is not None and b is not None:
            union.tie(a, b)
    got = components.components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == {(x, union.find(x)) for x in union.up if union.find(x) != x}


def brute_lines(texts):
    held = defaultdict(list)
    for d, t in enumerate(texts):
        for k, line in enumerate((t or "").split("\n")):
            if len(line.strip()) >= line_dedup.MIN_CHARS:
                held[line.strip()].append((d, k))
    lines, sets = list(held), []
    union = Union(range(len(lines)))
    for i, line in enumerate(lines):
        low = line.lower()
        s = {low[j : j + 8] for j in range(max(1, len(low) - 7))}
        for j, other in enumerate(sets):
            if len(s & other) >= 0.8 * len(s | other):
                union.tie(i, j)
        sets.append(s)
    groups, gone = defaultdict(list), set()
    for i, line in enumerate(lines):
        groups[union.find(i)] += held[line]
    for places in groups.values():
        gone |= set(sorted(places)[1:])
    return [None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in enumerate(texts)]


def check_lines(spark, texts):
    df = documents(spark, texts)
    out = line_dedup.dedup_lines(df)
    assert set(out.columns) == set(df.columns)  # n_removed replaces the column of that name
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in out.collect()}
    want = brute_lines(texts)
    assert {i: g[0] for i, g in got.items()} == dict(enumerate(want))
    for i, (text, n) in got.items():
        assert n == len((texts[i] or "").split("\n")) - len((text or "").split("\n")) or text == ""


def test_lines_equal_brute_force(spark):
    lines = [prose(s, 12 + s % 7) for s in range(30)]
    rng = random.Random(8)
    texts = ["\n".join(rng.choice(lines) if rng.random() < 0.4 else edited(rng.choice(lines), 30, f"k{d}_") if rng.random() < 0.5 else prose(1000 * d + j, 15)
                       for j in range(6)) for d in range(40)]
    texts += [*ODD_TEXTS, "short\nshort\nshort", "  " + lines[0] + "  ", lines[0].upper(), "É" * 30 + "\n" + "é" * 30]
    check_lines(spark, texts)


def test_lines_of_repeated_ids_and_missing_ids(spark):
    line, other = prose(1, 20), prose(2, 20)
    rows = [(2, f"{other}\n{line}"), (1, line), (1, line), (None, line), (4, f"{line}\n{other}"), (4, f"{other}\nx")]
    got = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == Counter([(2, other), (1, line), (1, line), (None, line), (4, ""), (4, "x")])
    assert line_dedup.dedup_lines(documents(spark, ["x"]).limit(0)).count() == 0


def test_passages_and_paragraphs(spark):
    passages = [prose(500 + i, n) for i, n in enumerate((51, 60, 120))]
    texts = [f"{prose(s, 60)} {passages[s % 3]} {prose(100 + s, 70)}\n{prose(600 + s, 50)}" for s in range(9)]
    clean = [prose(2000 + s, 150) + "\n" + prose(3000 + s, 80) for s in range(10)]
    paragraph = prose(4000, 80)
    near_copies = [prose(4100 + s, 40) + "\n" + edited(paragraph, 70, f"z{s}_") for s in range(3)]
    short = prose(5000, 20)
    texts = texts + clean + near_copies + [f"{short}\n{prose(5100 + s, 40)}" for s in range(3)] + ODD_TEXTS + [texts[0], None]
    df = documents(spark, texts)
    spans = defaultdict(list)
    for r in substring_dedup.repeated_spans(df).collect():
        spans[r["doc_id"]].append(r)
    for s in range(3, 9):
        inside = set(range(60, 60 + len(passages[s % 3].split())))
        found = {k for r in spans[s] for k in range(r["first"], r["last"])}
        assert found <= inside and len(found) >= len(inside) - 18
        assert {r["kept_in"] for r in spans[s]} == {s % 3}
    assert not any(spans[i] for i in [0, 1, 2, *range(9, 20), 22, 23, 24])
    assert all("paragraph" in {r["kind"] for r in spans[i]} for i in (20, 21))
    whole = len(texts) - 2
    assert {k for r in spans[whole] for k in range(r["first"], r["last"])} >= set(range(15, len(words(texts[0])) - 15))
    # what is cut out, and nothing else
    out = {r["doc_id"]: r["text"] for r in substring_dedup.dedup_substrings(df).collect()}
    for i, text in enumerate(texts):
        gone = {k for r in spans[i] for k in range(r["first"], r["last"])}
        if not gone:
            assert out[i] == text
        else:
            assert words(out[i]) == [w for k, w in enumerate(words(text)) if k not in gone]
    assert substring_dedup.dedup_substrings(df).columns == df.columns
    assert substring_dedup.dedup_substrings(df.limit(0)).count() == 0
