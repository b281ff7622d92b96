"""Whitening against exact fractions and numpy."""

from fractions import Fraction

import numpy as np
import pytest

from starloom.llm import whitening
from starloom.llm.queries import QUERIES
from tests.llm.fixtures import CLASHING

DDL = "vec_id long, embedding array<float>"


def frame(spark, vectors, ddl=DDL):
    return spark.createDataFrame(list(enumerate(vectors)), ddl)


def integers(vectors):
    return [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]


def check(rows, vectors, k=32):
    """The rows against covariances in fractions, centred before multiplying."""
    x = integers(vectors)
    n, d = len(x), len(x[0])
    s = [sum(c) for c in zip(*x)]
    centred = [[Fraction(n * v - t, n) for v, t in zip(row, s)] for row in x]
    cov = np.array([[float(sum(r[i] * r[j] for r in centred) / n) for j in range(d)] for i in range(d)])
    values, vectors_ = np.linalg.eigh(cov)
    values, vectors_ = values[::-1][:k], vectors_[:, ::-1][:, :k]
    values = values[values > np.trace(cov) * d * 1e-15]
    expected = np.array(centred, float) @ vectors_[:, : len(values)] / np.sqrt(values)
    found = np.full(expected.shape, np.nan)
    deviation = [sum((n * v - t) ** 2 for v, t in zip(row, s)) for row in x]
    for r in rows:
        found[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and int(r.deviation) == deviation[r.vec_id]
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
        assert 0 <= r.identity_error < 1e-9
    signs = np.sign((found * expected).sum(0))
    assert np.allclose(found * signs, expected, atol=1e-8)
    again = found - found.mean(0)
    assert np.abs(again.T @ again / n - np.eye(len(values))).max() < 1e-9


def test_equals_fractions(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))).tolist()
    rows = whitening.whiten(frame(spark, vectors).repartition(5)).collect()
    assert len(rows) == 300 * 6
    check(rows, vectors)


def test_some_components_only(spark):
    vectors = np.random.default_rng(2).normal(size=(80, 9)).tolist()
    rows = whitening.whiten(frame(spark, vectors), components=4).collect()
    assert {r.component for r in rows} == {1, 2, 3, 4}
    check(rows, vectors, 4)


def test_constant_dimensions_and_few_rows_have_fewer_components(spark):
    vectors = [[1.0, 2.0, 0.5, 3.0], [1.0, -2.0, 0.5, 3.5], [1.0, 0.0, 0.5, 1.0]]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    assert {r.component for r in rows} == {1, 2}
    check(rows, vectors)
    assert whitening.whiten(frame(spark, [[1.0, 2.0]])).collect() == []
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 5)).collect() == []


def test_rows_that_take_no_part(spark):
    good = np.random.default_rng(3).normal(size=(40, 3)).tolist()
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 1.0], [float("inf"), 0.0, 1.0], [1e30, 0.0, 1.0]]
    rows = whitening.whiten(frame(spark, good + bad)).collect()
    assert {r.vec_id for r in rows} == set(range(40))
    check(rows, good)


def test_each_length_is_fitted_apart(spark):
    rng = np.random.default_rng(4)
    short, long = rng.normal(size=(30, 2)).tolist(), rng.normal(size=(50, 3)).tolist()
    rows = whitening.whiten(frame(spark, short + long)).collect()
    check([r for r in rows if r.vec_id < 30], short)
    apart = whitening.whiten(frame(spark, long)).collect()
    found = {(r.vec_id - 30, r.component): abs(r.whitened) for r in rows if r.vec_id >= 30}
    assert found == pytest.approx({(r.vec_id, r.component): abs(r.whitened) for r in apart})


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    rows = [(i // 2, [float(i // 2), float(i % 3)], *["z"] * len(CLASHING)) for i in range(10)]
    rows.append((None, [4.0, 4.0], *["z"] * len(CLASHING)))
    names = ", ".join(f"{c} string" for c in CLASHING)
    found = whitening.whiten(spark.createDataFrame(rows, f"{DDL}, {names}")).collect()
    assert len(found) == 11 * 2 and {r.n for r in found} == {11}
    assert sum(r.vec_id is None for r in found) == 2


def test_empty_table(spark):
    assert whitening.whiten(spark.createDataFrame([], DDL)).collect() == []


def test_large_entries_stay_exact(spark):
    """Squares beyond a long, in two parts and in Python's integers."""
    for size in (1e7, 1e13):
        vectors = (np.random.default_rng(5).normal(size=(60, 3)) * size).tolist()
        ddl = "vec_id long, embedding array<double>"
        rows = whitening.whiten(frame(spark, vectors, ddl)).collect()
        x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors]
        s = [sum(c) for c in zip(*x)]
        for r in rows:
            assert int(r.deviation) == sum((60 * v - t) ** 2 for v, t in zip(x[r.vec_id], s))
            assert r.identity_error < 1e-9


@pytest.mark.parametrize("size", [1, 1 << 20, 1 << 40, 1 << 61])
def test_squares_are_exact(size):
    t = np.random.default_rng(6).integers(-size, size + 1, (700, 3))
    assert whitening._squares(t).tolist() == [sum(int(v) ** 2 for v in c) for c in t.T]


def test_model_of_other_rows(spark):
    fitted = np.random.default_rng(7).normal(size=(60, 3)).tolist()
    model = whitening.fit(frame(spark, fitted))
    own = {(r.vec_id, r.component): r.whitened for r in whitening.whiten(frame(spark, fitted)).collect()}
    part = whitening.whiten(frame(spark, fitted[:5] + [[1.0]]), model=model).collect()
    assert len(part) == 15 and all(abs(r.whitened - own[r.vec_id, r.component]) < 1e-12 for r in part)


def test_query_on_the_given_table(spark, sf_dir):
    rows = QUERIES["op11_embedding_whitening"](spark, sf_dir).collect()
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    order = sorted(given)
    place = {v: i for i, v in enumerate(order)}
    assert len(rows) == len(given) * 32
    from pyspark.sql import Row

    check([Row(**{**r.asDict(), "vec_id": place[r.vec_id]}) for r in rows], [given[v] for v in order])
