"""Rows of the near-duplicate operators are moved once."""

from collections import defaultdict

from pyspark.sql import functions as F

from starloom.llm import components, near, ngram_join, substring_dedup
from starloom.llm.arrow import stored


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_shared_keys_are_dealt_once(spark):
    rows = spark.range(2000).select((F.col("id") % 1300).alias("key"), "id", (F.col("id") % 9 + 1).alias("n"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for given, ratio in ((rows.drop("n"), None), (rows, 0.8)):
            plan = _plan(near.shared_keys(given, ratio))
            assert "ReusedExchange" in plan and plan.count("Exchange hashpartitioning(") == plan.count("ReusedExchange") + 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_shared_keys_equal_a_plain_loop(spark):
    given = [(k, i, 10 + i % 5) for k in range(40) for i in range(k % 7)] * 2 + [(99, 1, 10), (99, 2, 1000), (100, 5, 10), (None, 1, 10), (None, 2, 10)]
    df = spark.createDataFrame(given, "key bigint, id bigint, n bigint")
    held = defaultdict(list)
    for k, i, _ in given:
        held[k].append(i)
    several = {r + (min(held[r[0]]), len(held[r[0]])) for r in given if r[0] is not None and len(set(held[r[0]])) > 1}
    got = [tuple(r) for r in near.shared_keys(df).select("key", "id", "n", "centre", "held").collect()]
    assert len(got) == len(set(got)) and set(got) == several
    got = [tuple(r) for r in near.shared_keys(df, 0.5).select("key", "id", "n", "centre", "held").collect()]
    assert len(got) == len(set(got)) and set(got) == {r for r in several if r[0] != 99}  # far apart in size


def test_keys_of_equal_paragraphs_go_once_per_portion(spark):
    line = "one passage that every document of the portion holds in full"
    rows = spark.createDataFrame([(i, f"{line}\nown words {i} of this text here\n{line}") for i in range(50)], "doc_id bigint, text string").coalesce(1)
    made = substring_dedup.paragraphs(rows, 5)
    assert made.count() == 150
    assert made.select(F.sum(F.size("keys"))).first()[0] == 51 * substring_dedup.BANDS


def test_sets_of_unique_ids_are_not_made_distinct_again(spark, monkeypatch):
    plans, real = [], ngram_join.stored

    def seen(df, label):
        if label == "sets":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(ngram_join, "stored", seen)
    base = [f"w{i}" for i in range(100)]
    texts = [(i, " ".join([*base, f"x{i}"])) for i in range(4)] + [(9, "other words altogether here")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similarity_join(df).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 9: 9}
    assert plans and not any("Aggregate" in p or "Deduplicate" in p for p in plans)
    plans.clear()
    twice = df.unionByName(df.where("doc_id < 2"))
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.similarity_join(twice).collect()} == got
    assert plans and all("Aggregate" in p for p in plans)


def _unadapted(spark, make):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return _plan(make())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_segments_are_dealt_by_key_once(spark):
    passage = " ".join(f"p{i}" for i in range(80))
    rows = spark.createDataFrame([(i, f"own{i} words{i} {passage} end{i}") for i in range(5)], "doc_id bigint, text string")
    plan = _unadapted(spark, lambda: substring_dedup.repeated_passages(rows))
    assert "ReusedExchange" in plan and plan.count("Exchange hashpartitioning(key") == plan.count("ReusedExchange") + 1
    got = substring_dedup.repeated_passages(rows).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 2, 3, 4] and {r["kept_in"] for r in got} == {0}
    assert all(r["last"] - r["first"] >= substring_dedup.MIN_WORDS for r in got)


def test_components_that_hang_under_roots_take_no_round(spark, monkeypatch):
    labels, real = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, label: labels.append(label) or real(df, label))
    links = spark.createDataFrame([(1, 2), (3, 1), (9, 8), (8, 9)], "a bigint, b bigint")
    assert sorted(map(tuple, components.components(links).collect())) == [(2, 1), (3, 1), (9, 8)]
    assert labels == ["links"]


def test_few_pairs_move_only_the_rows_they_need(spark, monkeypatch):
    rows = stored(spark.range(500).select("id", F.concat(F.lit("line "), "id").alias("line")), "rows")
    pairs = stored(spark.createDataFrame([(1, 2), (1, 3), (7, 400)], "a bigint, b bigint"), "pairs")
    want = [(a, b, f"line {a}", f"line {b}") for a, b in ((1, 2), (1, 3), (7, 400))]
    plan = _unadapted(spark, lambda: near.with_both(pairs, rows, "line"))
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning(a" in plan and "hashpartitioning(b" not in plan
    assert sorted(map(tuple, near.with_both(pairs, rows, "line").collect())) == want
    monkeypatch.setattr(near, "BROADCAST_PAIRS", -1)
    assert sorted(map(tuple, near.with_both(pairs, rows, "line").collect())) == want


def test_steps_on_few_rows_take_few_tasks(spark, monkeypatch):
    most = 2 * spark.sparkContext.defaultParallelism
    wide = spark.range(100).repartition(most + 30)
    assert near.fitted(wide, 100).rdd.getNumPartitions() == most
    assert near.fitted(wide, near.BROADCAST_ROWS + 1).rdd.getNumPartitions() == most + 30


def test_repeats_equal_a_plain_loop(spark):
    given = [(d, k, (d * 7 + k) % 23) for d in range(12) for k in range(4)] + [(3, 0, 21), (3, 0, 21), (50, 0, 900), (51, 0, 901)]
    up = {5: 2, 21: 2, 901: 900}
    groups = defaultdict(list)
    for d, k, i in given:
        groups[up.get(i, i)].append((d, k, i))
    want = sorted((d, k, i, min(g)[0]) for g in groups.values() if len(g) > 1 for d, k, i in g if (d, k) != min(g)[:2])
    rows = spark.createDataFrame(given, "doc_id bigint, number int, id bigint")
    roots = spark.createDataFrame(list(up.items()), "id bigint, root bigint")
    got = near.repeats(rows, roots, "doc_id", "number").select("doc_id", "number", "id", "first.doc_id").collect()
    assert sorted(map(tuple, got)) == want
