"""Curves, decompositions and learners against plain recomputation."""

import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.ml import classification as C
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from starloom.ml import curves, decomposition, frames, learners
from starloom.operators import facts
from starloom.registry import features
from starloom.sources.readers import TableSet
from tests.conftest import rows


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 12)) + 3 * rng.integers(0, 3, (400, 1))
    label = (x @ rng.normal(size=12) + rng.normal(size=400) > 0).astype(int)
    return x, label, spark.createDataFrame(
        [(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(x, label))], "id long, v array<double>, label int").repartition(5)


def plain_table(pairs):
    pos, neg = sum(l for _, l in pairs), sum(1 - l for _, l in pairs)
    out = []
    for t in sorted({s for s, _ in pairs}):
        tp, fp = (sum(1 for s, l in pairs if s >= t and l == want) for want in (1, 0))
        out.append((t, tp + fp, tp, fp, tp / (tp + fp), tp / pos, fp / neg))
    return out


def test_threshold_table_with_a_score_of_a_third_of_the_rows(spark):
    rng = random.Random(1)
    pairs = [(0.5 if i % 3 == 0 else round(rng.random(), 2), int(rng.random() < 0.4)) for i in range(900)]
    df = spark.createDataFrame([*pairs, (None, 1), (0.1, None)], "s double, l int").repartition(4)
    table = curves.threshold_table(df, "s", "l", ranges=7)
    found = sorted(tuple(r) for r in table.select("threshold", "taken", "tp", "fp", "precision", "recall", "fall_out").collect())
    assert np.array(found) == pytest.approx(np.array(plain_table(pairs)))
    wins = sum((a > b) + 0.5 * (a == b) for a, la in pairs if la for b, lb in pairs if not lb)
    pos = sum(l for _, l in pairs)
    assert curves.area_under_roc(table).first()[0] == pytest.approx(wins / (pos * (900 - pos)))


def test_no_window_runs_over_all_scores(spark):
    df = spark.range(2000).select(F.col("id").cast("double").alias("s"), (F.col("id") % 2).alias("l"))
    sums = curves.running_sums(df, F.desc("s"), ["l"], 8)
    assert sums.agg(F.max("cum_l")).first()[0] == 1000
    plan = sums._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.split("\n") if "SinglePartition" in line]
    # only the totals of the ranges come together
    assert len(single) == 1 and "partial_sum" in plan[plan.index("SinglePartition"):]


def test_empty_threshold_table_and_one_class(spark):
    none = spark.createDataFrame([], "s double, l int")
    assert curves.threshold_table(none, "s", "l").collect() == []
    one = curves.threshold_table(spark.createDataFrame([(0.2, 1), (0.4, 1)], "s double, l int"), "s", "l")
    assert rows(one.select("threshold", "recall", "fall_out")) == [(0.2, 1.0, None), (0.4, 0.5, None)]


def test_roc_equals_that_of_the_model_summary(spark, vectors):
    rows_ = vectors[2].select("id", array_to_vector("v").alias("features"), F.col("label").cast("double").alias("label"))
    model = C.LogisticRegression(regParam=0.01).fit(rows_)
    scored = model.transform(rows_).select(vector_to_array("probability")[1].alias("s"), "label")
    table = curves.threshold_table(scored, "s", "label", 5).cache()
    assert curves.area_under_roc(table).first()[0] == pytest.approx(model.summary.areaUnderROC, abs=1e-9)
    roc = {(round(r.FPR, 9), round(r.TPR, 9)) for r in model.summary.roc.collect()}
    assert {(round(r.fall_out, 9), round(r.recall, 9)) for r in table.collect()} | {(0.0, 0.0), (1.0, 1.0)} == roc
    best = curves.best_f1(table).first()
    assert best.f1 == pytest.approx(max(r["F-Measure"] for r in model.summary.fMeasureByThreshold.collect()))


def test_distances(spark):
    rng = random.Random(2)
    values = [(round(rng.random() ** 2, 2), i % 3 == 0) for i in range(500)]
    df = spark.createDataFrame([*values, (None, True)], "x double, a boolean")
    xs = sorted(v for v, _ in values)
    share = lambda part, t: sum(v <= t for v in part) / len(part)
    below = lambda part, t: sum(v < t for v in part) / len(part)
    assert curves.distance_from(df, "x", F.col("x"), 4).first()[0] == pytest.approx(max(max(share(xs, t) - t, t - below(xs, t)) for t in set(xs)))
    a, b = [v for v, k in values if k], [v for v, k in values if not k]
    assert curves.distance_between(df, "x", F.col("a"), 4).first()[0] == pytest.approx(max(abs(share(a, t) - share(b, t)) for t in set(xs)))


@pytest.mark.parametrize("narrow", [100, 4])
def test_decomposition_restores_the_rows(spark, vectors, narrow):
    x, _, df = vectors
    found = decomposition.svd(df, "id", "v", narrow=narrow)
    assert found.values == pytest.approx(np.linalg.svd(x)[1], rel=1e-8)
    back = {r.id: r.row for r in found.restored().collect()}
    assert max(np.abs(np.array(back[i]) - x[i]).max() for i in range(len(x))) < 1e-6
    u = np.array([r.u for r in found.left.collect()])
    assert np.abs(u.T @ u - np.eye(12)).max() < 1e-6


def test_decomposition_of_a_wide_matrix_and_of_few_ranks(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 4)) @ np.diag([9, 5, 3, 1]) @ rng.normal(size=(4, 200))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)], "id long, v array<double>")
    exact = np.linalg.svd(x)[1]
    assert decomposition.svd(df, "id", "v", 3, narrow=50).values == pytest.approx(exact[:3], rel=1e-8)
    assert len(decomposition.svd(df, "id", "v").values) == 4
    with pytest.raises(ValueError, match="columns"):
        decomposition.svd(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id long, v array<double>"), "id", "v")


def test_k_means_assignments_equal_sql_from_its_centres(spark, vectors, tmp_path):
    x, _, df = vectors
    centres, found = learners.k_means(df, "id", "v", 3, str(tmp_path / "r"))
    given, assigned = pd.DataFrame({"id": range(400), "v": x.tolist()}), found.toPandas()
    middle = pd.DataFrame({"c": range(3), "m": centres.tolist()})
    again = duckdb.sql("""SELECT id, arg_min(c, d) AS cluster FROM (SELECT id, c, list_sum(list_transform(
        list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM given, middle) GROUP BY id""").df()
    assert dict(zip(again["id"], again["cluster"])) == dict(zip(assigned["id"], assigned["cluster"]))
    for c in range(3):  # no round would move anything
        assert x[assigned.set_index("id").loc[range(400), "cluster"].to_numpy() == c].mean(0) == pytest.approx(centres[c])
    assert learners.Rounds(spark, str(tmp_path / "r")).number > 2
    resumed, _ = learners.k_means(df, "id", "v", 3, str(tmp_path / "r"))
    assert (resumed == centres).all()


def test_logistic_gradient_is_nought(spark, vectors):
    x, label, df = vectors
    w = learners.logistic(df, "v", "label", 0.01)
    full = np.hstack((x, np.ones((400, 1))))
    p = 1 / (1 + np.exp(-full @ w))
    assert np.abs(full.T @ (p - label) / 400 + 0.01 * np.append(w[:-1], 0)).max() < 1e-9


def test_factors_solve_their_normal_equations_and_top_items_equal_all_pairs(spark):
    rng = random.Random(4)
    ratings = [(u if rng.random() < 0.6 else 0, i, float(rng.randrange(1, 6))) for u in range(40) for i in rng.sample(range(30), 12)]
    ratings = list({(u, i): r for u, i, r in ratings}.items())
    df = spark.createDataFrame([(u, i, r) for (u, i), r in ratings] + [(None, 1, 2.0)], "u int, i int, r double")
    users, items = learners.factors(df, "u", "i", "r", rank=3, rounds=4)
    f, g = ({r.id: np.array(r.factor) for r in d.collect()} for d in (users, items))
    for u, p in f.items():
        mine = [(g[i], r) for (v, i), r in ratings if v == u]
        gradient = sum((q @ p - r) * q for q, r in mine) + 0.1 * len(mine) * p
        assert np.abs(gradient).max() < 1e-9
    expected = []
    for u in f:
        best = sorted((-float(f[u] @ g[i]), i) for i in g)[:5]
        expected += [(u, n, i) for n, (_, i) in enumerate(best, 1)]
    for block in (7, 1000):
        top = learners.top_items(users, items, 5, block)
        assert sorted((r.user, r["rank"], r.item) for r in top.collect()) == sorted(expected)


def test_stored_entries_are_as_many_as_the_vector_is_full(spark):
    wide, full = Vectors.sparse(1 << 30, {5: 2.0, 9: 0.0}), Vectors.dense([0.0, 3.0])
    df = spark.createDataFrame([(1, wide), (2, full)], ["id", "v"])
    sizes = df.select("id", F.size(F.filter(frames.stored_entries("v"), lambda e: e != 0)).alias("n"))
    # a vector of 2^30 entries, made dense, would not fit an array
    assert rows(sizes) == [(1, 1), (2, 1)]


def test_hashed_vectors_are_counted_without_making_them_dense(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1, 0.0, "X"), (2, "b", 1, 5.5, "Y")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    out = entry_points.queries()["b_ml_feature_hasher"](spark, str(tmp_path))
    assert rows(out) == [(1, 1), (2, 2)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "vectorToArray" not in plan and plan.count("UDF(") <= 1  # the hasher's own


def sizes_of_tasks(df):
    return [n for n in df.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect() if n]


def test_learners_get_tasks_of_bounded_size(spark):
    one = spark.range(3000, numPartitions=1).withColumn("hub", F.lit(1))
    assert sizes_of_tasks(frames.dealt(one, 3000)) == [3000]  # fits: left as it is
    for by in ((), ("hub", "id")):  # a hub's rows too
        parts = frames.dealt(one, 200, by)
        assert max(sizes_of_tasks(parts)) <= 600
        assert rows(parts) == rows(one)


def test_line_prices_are_dealt_whatever_the_files(spark, tmp_path, monkeypatch):
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_extendedprice double"
    given = [(i, i % 7, i % 3, 1, float(i % 50), 0.1, 10.0 * i) for i in range(900)]
    spark.createDataFrame(given, line).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(frames.dealt, "__defaults__", (100, ()))
    prices = frames.line_prices(TableSet(spark, str(tmp_path)))
    assert max(sizes_of_tasks(prices)) <= 300
    assert sorted(r["label"] for r in prices.collect()) == [r[-1] for r in given]


def test_power_iteration_gets_edges_in_ranges(spark, tmp_path, monkeypatch):
    pairs = [(i, i + 1) for i in range(30)] + [(i, i + 2) for i in range(30)]
    spark.createDataFrame(pairs, "l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    seen, real = [], frames.dealt
    monkeypatch.setattr(frames, "dealt", lambda df, **more: seen.append(more) or real(df, 5, **more))
    out = entry_points.queries()["b_ml_power_iteration"](spark, str(tmp_path))
    assert sum(r["n"] for r in out.collect()) == 32 and seen == [{"by": ("src", "dst")}]


@pytest.mark.parametrize("name", ["b_ml_topic_likelihood", "b_ml_counted_idf"])
def test_texts_are_cut_into_words_before_the_passes_of_a_learner(spark, tmp_path, monkeypatch, name):
    texts = [(i, f"a b{i % 4} c{i % 3} d") for i in range(40)]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    kept, real = [], facts.stored
    for module in (frames, features):
        monkeypatch.setattr(module, "stored", lambda df, label: kept.append(label) or real(df, label))
    out = entry_points.queries()[name](spark, str(tmp_path)).collect()
    assert kept == ["counts"]
    assert out[0][0] == 160 if name == "b_ml_topic_likelihood" else len(out) == 40
