"""Estimators, clusterings, recommendations, statistics and tuning over the tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, classification as C, clustering as K, regression as R
from pyspark.ml.evaluation import (
    ClusteringEvaluator,
    MulticlassClassificationEvaluator, MultilabelClassificationEvaluator, RankingEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import (
    HashingTF, IndexToString, MinMaxScaler, StringIndexer, Tokenizer, VectorIndexer,
)
from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.ml.recommendation import ALS
from pyspark.ml.stat import ChiSquareTest, Correlation, KolmogorovSmirnovTest, Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import functions as F

from starloom.ml import curves, decomposition, frames, learners
from starloom.operators.facts import stored
from starloom.registry.base import Inputs, Registry
from starloom.streaming import runner
from starloom.streaming.sources import stream_table

REGISTRY = Registry()
query = REGISTRY.query


# --- classification ----------------------------------------------------------------------

def _indexed(estimator):
    """Index the labels, learn, and name the predicted labels again."""

    def build(x: Inputs):
        rows = frames.labelled_vectors(x.tables).withColumn(
            "kind", F.concat(F.lit("k"), F.col("label").cast("int").cast("string")))
        labels = StringIndexer(inputCol="kind", outputCol="indexed").fit(rows)
        stages = [labels, estimator(), IndexToString(
            inputCol="prediction", outputCol="predicted", labels=labels.labels)]
        scored = Pipeline(stages=stages).fit(rows).transform(rows)
        return scored.groupBy("kind", "predicted").agg(F.count(F.lit(1)).alias("n"))

    return build


REGISTRY.add("b_ml_decision_tree_classifier", _indexed(
    lambda: C.DecisionTreeClassifier(labelCol="indexed", maxDepth=3)))
REGISTRY.add("b_ml_random_forest_classifier", _indexed(
    lambda: C.RandomForestClassifier(labelCol="indexed", numTrees=10, maxDepth=3, seed=7)))


def _binary(estimator, scale: bool = False):
    def build(x: Inputs):
        rows = frames.binary_vectors(x.tables)
        if scale:
            rows = MinMaxScaler(inputCol="features", outputCol="scaled").fit(rows).transform(
                rows).drop("features").withColumnRenamed("scaled", "features")
        return frames.confusion(estimator().fit(rows).transform(rows))

    return build


REGISTRY.add("b_ml_gbt_classifier", _binary(lambda: C.GBTClassifier(maxIter=3, maxDepth=3, seed=7)))
REGISTRY.add("b_ml_linear_svc", _binary(lambda: C.LinearSVC(maxIter=10, regParam=0.1)))
REGISTRY.add("b_ml_logistic_elastic_net", _binary(
    lambda: C.LogisticRegression(maxIter=10, regParam=0.3, elasticNetParam=0.8)))
REGISTRY.add("b_ml_fm_classifier", _binary(
    lambda: C.FMClassifier(stepSize=0.01, maxIter=10, seed=7), scale=True))
REGISTRY.add("b_ml_naive_bayes", _binary(
    lambda: C.NaiveBayes(smoothing=1.0, modelType="multinomial"), scale=True))


@query()
def b_ml_logistic_summary(x: Inputs):
    """Training summary: objective per iteration."""
    model = C.LogisticRegression(maxIter=10, regParam=0.01, elasticNetParam=0.8).fit(
        frames.binary_vectors(x.tables))
    history = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    curve = x.spark.createDataFrame(history, "iteration int, objective double")
    return curve.withColumn("objective", F.round("objective", 6))


def _multiclass(estimator):
    def build(x: Inputs):
        rows = frames.labelled_vectors(x.tables)
        scored = estimator(len(rows.first()["features"])).fit(rows).transform(rows)
        return frames.confusion(scored)

    return build


REGISTRY.add("b_ml_multiclass_logistic", _multiclass(
    lambda size: C.LogisticRegression(maxIter=5, regParam=0.05, elasticNetParam=0.2)))
REGISTRY.add("b_ml_multilayer_perceptron", _multiclass(
    lambda size: C.MultilayerPerceptronClassifier(layers=[size, 12, 10], maxIter=20, seed=7)))
REGISTRY.add("b_ml_one_vs_rest", _multiclass(
    lambda size: C.OneVsRest(classifier=C.LogisticRegression(maxIter=3, tol=1e-4))))


# --- regression --------------------------------------------------------------------------

@query("""SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
    round(regr_intercept(l_extendedprice, l_quantity), 1) AS intercept FROM lineitem""")
def b_ml_linear_regression(x: Inputs):
    """Least squares of price on quantity."""
    rows = frames.assembled(x.tables["lineitem"].select(
        "l_quantity", F.col("l_extendedprice").alias("label")), ["l_quantity"])
    model = R.LinearRegression(solver="normal").fit(rows)
    return x.spark.createDataFrame(
        [(round(float(model.coefficients[0]), 3), round(float(model.intercept), 1))],
        "slope double, intercept double")


def _regression(estimator, scale: bool = False, index: bool = False):
    def build(x: Inputs):
        rows = frames.line_prices(x.tables)
        stages = []
        column = "features"
        if scale:
            stages.append(MinMaxScaler(inputCol=column, outputCol="scaled"))
            column = "scaled"
        if index:
            stages.append(VectorIndexer(inputCol=column, outputCol="indexed", maxCategories=4))
            column = "indexed"
        stages.append(estimator().setFeaturesCol(column))
        return frames.error_summary(Pipeline(stages=stages).fit(rows).transform(rows))

    return build


REGISTRY.add("b_ml_elastic_net_regression", _regression(
    lambda: R.LinearRegression(maxIter=10, regParam=0.3, elasticNetParam=0.8)))
REGISTRY.add("b_ml_decision_tree_regressor", _regression(
    lambda: R.DecisionTreeRegressor(maxDepth=3), index=True))
REGISTRY.add("b_ml_random_forest_regressor", _regression(
    lambda: R.RandomForestRegressor(numTrees=5, maxDepth=3, seed=7), index=True))
REGISTRY.add("b_ml_gbt_regressor", _regression(
    lambda: R.GBTRegressor(maxIter=3, maxDepth=3, seed=7), index=True))
REGISTRY.add("b_ml_fm_regressor", _regression(
    lambda: R.FMRegressor(stepSize=0.01, maxIter=10, seed=7), scale=True))
REGISTRY.add("b_ml_generalized_linear", _regression(
    lambda: R.GeneralizedLinearRegression(family="gaussian", link="identity", maxIter=5,
                                          regParam=0.3)))
REGISTRY.add("b_ml_isotonic_regression", _regression(
    lambda: R.IsotonicRegression(featureIndex=0)))


@query()
def b_ml_survival_regression(x: Inputs):
    """Years from 1990 to shipment as survival time; open line items are censored."""
    rows = x.tables["lineitem"].select(
        (F.datediff("l_shipdate", F.lit("1990-01-01").cast("date")) / 365.0).alias("label"),
        F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("censor"),
        "l_quantity", "l_discount")
    rows = frames.assembled(rows.where("label > 0"), ["l_quantity", "l_discount"])
    model = R.AFTSurvivalRegression(quantileProbabilities=[0.3, 0.6], maxIter=20).fit(rows)
    return x.spark.createDataFrame(
        [(round(float(model.intercept), 2), round(float(model.scale), 2))],
        "intercept double, scale double")


# --- clustering --------------------------------------------------------------------------

def _clusters(estimator):
    def build(x: Inputs):
        rows = frames.labelled_vectors(x.tables)
        scored = estimator().fit(rows).transform(rows)
        return scored.groupBy("prediction").agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("labels"))

    return build


REGISTRY.add("b_ml_k_means", _clusters(lambda: K.KMeans(k=10, seed=1, maxIter=10)))
REGISTRY.add("b_ml_bisecting_k_means", _clusters(
    lambda: K.BisectingKMeans(k=4, seed=1, maxIter=5)))
REGISTRY.add("b_ml_gaussian_mixture", _clusters(
    lambda: K.GaussianMixture(k=2, seed=7, maxIter=3)))


@query()
def b_ml_topics(x: Inputs):
    """Topics of the documents: heaviest hashed terms per topic."""
    counts = frames.hashed_counts(x.tables, 512)
    model = K.LDA(k=5, maxIter=5, seed=7, optimizer="online").fit(counts)
    return model.describeTopics(3).select("topic", F.size("termIndices").alias("terms"))


@query("SELECT count(*) AS tokens, true AS below FROM (SELECT unnest(string_split_regex(rtrim(lower(text), ' ' || chr(10)), '\\s')) AS w FROM documents) t")
def b_ml_topic_likelihood(x: Inputs):
    """Likelihood bound and perplexity of the topics: their ratio is the number of tokens."""
    counts = frames.hashed_counts(x.tables, 512)
    model = K.LDA(k=5, maxIter=3, seed=7, optimizer="online").fit(counts)
    bound, perplexity = model.logLikelihood(counts), model.logPerplexity(counts)
    return x.spark.createDataFrame([(round(-bound / perplexity), bound < 0 < perplexity)], "tokens long, below boolean")


@query()
def b_ml_power_iteration(x: Inputs):
    """Clusters of the supply graph by the number of shared line items."""
    edges = (
        x.tables["lineitem"].where("l_partkey <> l_suppkey")
        .groupBy(F.least("l_partkey", "l_suppkey").alias("src"),
                 F.greatest("l_partkey", "l_suppkey").alias("dst"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )
    # in ranges: a vertex is sent to few tasks each round, and a hub's edges are many tasks' work
    edges = frames.dealt(stored(edges, "edges"), by=("src", "dst"))
    picked = K.PowerIterationClustering(
        k=2, maxIter=5, initMode="degree", weightCol="weight").assignClusters(edges)
    return picked.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query()
def b_ml_stream_k_means(x: Inputs):
    """Cluster centres refitted on each arriving batch."""

    def refit(batch):
        rows = frames.assembled(batch.select("l_quantity", "l_discount"),
                                ["l_quantity", "l_discount"])
        scored = K.KMeans(k=3, seed=1, maxIter=5).fit(rows).transform(rows)
        return scored.groupBy("prediction").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg("l_quantity"), 3).alias("quantity"))

    _, out = runner.run_batches(stream_table(x.spark, x.folder, "lineitem"), "append", shape=refit)
    return out.select("batch", "prediction", "n", "quantity")


@query()
def b_ml_stream_regression(x: Inputs):
    """Linear model refitted on each arriving batch."""

    def refit(batch):
        rows = frames.assembled(
            batch.select("l_quantity", F.col("l_extendedprice").alias("label")), ["l_quantity"])
        return frames.error_summary(R.LinearRegression().fit(rows).transform(rows))

    _, out = runner.run_batches(stream_table(x.spark, x.folder, "lineitem"), "append", shape=refit)
    return out.select("batch", "n", "rmse", "mae")


# --- recommendation and patterns ---------------------------------------------------------

@query()
def b_ml_recommendation(x: Inputs):
    """Ratings are the quantities bought per supplier; fit quality over all of them."""
    ratings = x.tables["lineitem"].groupBy(
        F.col("l_partkey").cast("int").alias("part"), F.col("l_suppkey").cast("int").alias("supp")
    ).agg(F.avg("l_quantity").cast("float").alias("rating"))
    model = ALS(rank=5, maxIter=3, regParam=0.1, userCol="part", itemCol="supp",
                ratingCol="rating", coldStartStrategy="drop", seed=7).fit(ratings)
    scored = model.transform(ratings)
    rmse = RegressionEvaluator(labelCol="rating", metricName="rmse").evaluate(scored)
    return x.spark.createDataFrame([(round(rmse, 2),)], "rmse double")


_BASKETS = """RECURSIVE b AS (SELECT DISTINCT user_id AS u, strftime(ts, '%Y-%m-%d') AS d, event_type AS t FROM events),
    total AS (SELECT count(*) AS n FROM (SELECT DISTINCT u, d FROM b) x),
    s AS (SELECT u, d, t AS items, t AS last FROM b
        UNION ALL SELECT s.u, s.d, s.items || '+' || b.t, b.t FROM s JOIN b ON s.u = b.u AND s.d = b.d AND b.t > s.last),
    f AS (SELECT items, count(*) AS freq FROM s GROUP BY 1 HAVING count(*) >= 0.05 * (SELECT n FROM total))"""


def _patterns(x: Inputs):
    """Event types a user has on one day, as baskets."""
    baskets = x.tables["events"].groupBy("user_id", F.to_date("ts").alias("d")).agg(
        F.collect_set("event_type").alias("items"))
    return FPGrowth(itemsCol="items", minSupport=0.05, minConfidence=0.3).fit(baskets)


def _set(column):
    return F.array_join(F.array_sort(column), "+")


@query(f"WITH {_BASKETS} SELECT items, freq FROM f")
def b_ml_frequent_items(x: Inputs):
    """All sets of event types frequent among the (user, day) baskets."""
    return _patterns(x).freqItemsets.select(_set("items").alias("items"), "freq")


@query(f"""WITH {_BASKETS}, p AS (SELECT items, freq, unnest(string_split(items, '+')) AS consequent FROM f),
    r AS (SELECT items, freq, consequent, array_to_string(list_sort(list_filter(string_split(items, '+'),
        lambda y: y <> consequent)), '+') AS antecedent FROM p)
    SELECT antecedent, consequent, round(r.freq / CAST(a.freq AS DOUBLE), 6) AS confidence,
        round(r.freq / CAST((SELECT n FROM total) AS DOUBLE), 6) AS support
    FROM r JOIN f a ON a.items = r.antecedent WHERE r.freq / CAST(a.freq AS DOUBLE) >= 0.3""")
def b_ml_association_rules(x: Inputs):
    """Rules between the frequent sets, with their confidence."""
    return _patterns(x).associationRules.select(
        _set("antecedent").alias("antecedent"), F.col("consequent")[0].alias("consequent"),
        F.round("confidence", 6).alias("confidence"), F.round("support", 6).alias("support"))


@query("""WITH RECURSIVE e AS (SELECT user_id AS u, strftime(ts, '%Y-%m-%d') AS d, event_type AS k, min(ts) AS t
        FROM events GROUP BY 1, 2, 3),
    s AS (SELECT u, d, '["' || k || '"]' AS p, 1 AS n, t, k FROM e
        UNION ALL SELECT s.u, s.d, s.p || ',["' || e.k || '"]', n + 1, e.t, e.k FROM s JOIN e
            ON s.u = e.u AND s.d = e.d AND (e.t > s.t OR e.t = s.t AND e.k > s.k) WHERE n < 3)
    SELECT '[' || p || ']' AS pattern, count(*) AS freq FROM s GROUP BY 1
    HAVING count(*) >= 0.1 * (SELECT count(*) FROM (SELECT DISTINCT u, d FROM e) b)""")
def b_ml_frequent_sequences(x: Inputs):
    """Orders of event types that many (user, day) series share."""
    daily = (
        x.tables["events"].groupBy("user_id", F.to_date("ts").alias("d"), "event_type")
        .agg(F.min("ts").alias("t")).groupBy("user_id", "d")
        .agg(F.sort_array(F.collect_list(F.struct("t", "event_type"))).alias("s"))
        .select(F.transform("s", lambda e: F.array(e["event_type"])).alias("sequence"))
    )
    found = PrefixSpan(minSupport=0.1, maxPatternLength=3).findFrequentSequentialPatterns(daily)
    return found.select(F.to_json("sequence").alias("pattern"), "freq")


# --- statistics --------------------------------------------------------------------------

@query("SELECT round(corr(l_quantity, l_extendedprice), 6) AS pearson FROM lineitem")
def b_ml_correlation(x: Inputs):
    rows = frames.line_numbers(x.tables, ["l_quantity", "l_extendedprice"])
    matrix = Correlation.corr(rows, "features", "pearson").first()[0]
    return x.spark.createDataFrame([(round(float(matrix[0, 1]), 6),)], "pearson double")


@query("SELECT round(avg(l_quantity), 6) AS mean, round(var_samp(l_quantity), 4) AS variance, "
       "max(l_quantity) AS largest, count(*) AS n FROM lineitem")
def b_ml_summary(x: Inputs):
    rows = frames.line_numbers(x.tables)
    s = rows.select(Summarizer.metrics("mean", "variance", "max", "count").summary(
        F.col("features")).alias("s")).select("s.*")
    return s.select(
        F.round(frames.component("mean", 0), 6).alias("mean"),
        F.round(frames.component("variance", 0), 4).alias("variance"),
        frames.component("max", 0).alias("largest"), F.col("count").alias("n"))


@query("""
    WITH c AS (SELECT l_linenumber AS a, l_returnflag AS b, count(*) AS o FROM lineitem GROUP BY 1, 2),
    e AS (SELECT x.a, y.b, x.n * y.n / CAST((SELECT count(*) FROM lineitem) AS DOUBLE) AS e
        FROM (SELECT l_linenumber AS a, count(*) AS n FROM lineitem GROUP BY 1) x,
             (SELECT l_returnflag AS b, count(*) AS n FROM lineitem GROUP BY 1) y)
    SELECT round(sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e), 4) AS statistic
    FROM e LEFT JOIN c USING (a, b)""")
def b_ml_chi_square(x: Inputs):
    """Independence of line number and return flag."""
    rows = frames.assembled(x.tables["lineitem"].select(
        F.col("l_linenumber").cast("double").alias("line"),
        (F.ascii("l_returnflag") - 65).cast("double").alias("label")), ["line"])
    test = ChiSquareTest.test(rows, "features", "label", flatten=True)
    return test.select(F.round("statistic", 4).alias("statistic"))


# the normal distribution by a rational approximation, good to seven decimals
_NORMAL = """(CASE WHEN z >= 0 THEN 1 - tail ELSE tail END)"""
_TAIL = """0.5 * exp(-z * z / 2) * k * (0.254829592 + k * (-0.284496736 + k * (1.421413741 + k * (-1.453152027 + k * 1.061405429))))"""


@query(f"""
    SELECT round(max(greatest(upto - {_NORMAL}, {_NORMAL} - below)), 4) AS statistic FROM (
        SELECT *, {_TAIL} AS tail FROM (
            SELECT *, 1 / (1 + 0.3275911 * abs(z) / sqrt(2)) AS k FROM (
                SELECT (value - 50.0) / 30.0 AS z, sum(n) OVER (ORDER BY value) / sum(n) OVER () AS upto,
                    (sum(n) OVER (ORDER BY value) - n) / sum(n) OVER () AS below
                FROM (SELECT value, count(*) AS n FROM events GROUP BY 1) c) a) b) t""")
def b_ml_distribution_test(x: Inputs):
    """Distance of the event values from a normal distribution."""
    test = KolmogorovSmirnovTest.test(x.tables["events"], "value", "norm", 50.0, 30.0)
    return test.select(F.round("statistic", 4).alias("statistic"))


@query("SELECT event_type, count(*) AS n, true AS plausible FROM events GROUP BY 1")
def b_ml_stratified_sample(x: Inputs):
    """A tenth of each event type, drawn per stratum: its size lies within five deviations of
    what a fair draw gives."""
    # the strata are the types there are, of which there are few by nature
    events = x.tables["events"]
    kinds = [r["event_type"] for r in events.select("event_type").distinct().collect()]
    drawn = events.sampleBy("event_type", {k: 0.1 for k in kinds}, seed=11)
    sizes = drawn.groupBy("event_type").agg(F.count(F.lit(1)).alias("k"))
    whole = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).join(sizes, "event_type", "left")
    off = F.abs(F.coalesce("k", F.lit(0)) - F.col("n") / 10)
    return whole.select("event_type", "n", (off <= 5 * F.sqrt(F.col("n") * 0.09)).alias("plausible"))


@query("SELECT count(*) AS n, true AS plausible FROM lineitem")
def b_ml_random_sample(x: Inputs):
    """A five percent sample: its size lies within five deviations of what a fair draw gives."""
    rows = x.tables["lineitem"]
    kept = rows.sample(0.05, seed=3).agg(F.count(F.lit(1)).alias("kept"))
    both = rows.agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(kept))  # one row each
    return both.select("n", (F.abs(F.col("kept") - F.col("n") * 0.05) <= 5 * F.sqrt(F.col("n") * 0.0475)).alias("plausible"))


KERNEL = "exp(-pow((value - {p}) / 5.0::DOUBLE, 2) / 2) / (5.0::DOUBLE * sqrt(2 * pi()))"


@query("SELECT " + ", ".join(f"round(avg({KERNEL.format(p=p)}), 6) AS at_{p}" for p in
                             (10, 30, 50, 70, 90)) + " FROM events")
def b_ml_kernel_density(x: Inputs):
    """Gaussian kernel density of the event values at five points, one pass."""
    points, width = [10.0, 30.0, 50.0, 70.0, 90.0], 5.0
    scale = 1 / (width * (2 * 3.141592653589793) ** 0.5)
    kernels = [
        F.round(F.avg(F.exp(-F.pow((F.col("value") - p) / width, 2) / 2) * scale), 6).alias(
            f"at_{int(p)}") for p in points]
    return x.tables["events"].agg(*kernels)


@query("""WITH t AS (SELECT user_id, event_type, count(*) AS n, avg(value) AS v FROM events GROUP BY 1, 2),
        r AS (SELECT user_id, v > 50 AS worthy, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type DESC) AS place FROM t)
    SELECT round(avg(hits) / 3, 4) AS precision_at_3 FROM (
        SELECT user_id, sum(CASE WHEN worthy AND place <= 3 THEN 1.0 ELSE 0 END) AS hits FROM r GROUP BY 1) u""")
def b_ml_ranking_metrics(x: Inputs):
    """Precision at 3 of each user's most frequent event types, where the types worth more than
    50 on average are the relevant ones."""
    per_type = x.tables["events"].groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("v"))
    code = lambda e: F.xxhash64(e).cast("double")
    ranked = per_type.groupBy("user_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("n", "event_type")), False),
                    lambda e: code(e["event_type"])).alias("prediction"),
        F.transform(F.collect_list(F.when(F.col("v") > 50, F.col("event_type"))), code).alias("label"))
    precision = RankingEvaluator(metricName="precisionAtK", k=3).evaluate(ranked)
    return x.spark.createDataFrame([(round(precision, 4),)], "precision_at_3 double")


@query("""WITH h AS (SELECT user_id, event_type, max(CASE WHEN day(ts) <= 15 THEN 1 ELSE 0 END) AS a,
        max(CASE WHEN day(ts) > 15 THEN 1 ELSE 0 END) AS b FROM events GROUP BY 1, 2)
    SELECT round(avg(f), 4) AS f1 FROM (SELECT user_id, 2.0 * sum(a * b) / (sum(a) + sum(b)) AS f FROM h GROUP BY 1) u""")
def b_ml_multilabel_metrics(x: Inputs):
    """Agreement of the event types of a user's first and second half of the month."""
    half = F.when(F.dayofmonth("ts") <= 15, "label").otherwise("prediction")
    events = x.tables["events"]
    coded = StringIndexer(inputCol="event_type", outputCol="code").fit(events).transform(events)
    code = F.col("code")
    sets = coded.groupBy("user_id").agg(
        F.collect_set(F.when(half == "label", code)).alias("label"),
        F.collect_set(F.when(half == "prediction", code)).alias("prediction"))
    f1 = MultilabelClassificationEvaluator(metricName="f1Measure").evaluate(sets)
    return x.spark.createDataFrame([(round(f1, 4),)], "f1 double")


# --- stages and tuning -------------------------------------------------------------------

def _text_stages():
    return [
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(inputCol="words", outputCol="features", numFeatures=256),
        C.LogisticRegression(maxIter=5, regParam=0.01),
    ]


@query()
def b_ml_stages(x: Inputs):
    """Tokens, hashed counts and a classifier fitted as one chain of stages."""
    rows = frames.labelled_texts(x.tables)
    return frames.confusion(Pipeline(stages=_text_stages()).fit(rows).transform(rows))


@query()
def b_ml_cross_validation(x: Inputs):
    """Regularisation chosen by two-fold cross-validation."""
    rows = frames.labelled_texts(x.tables)
    stages = _text_stages()
    grid = ParamGridBuilder().addGrid(stages[2].regParam, [0.1, 0.01]).build()
    fitted = CrossValidator(
        estimator=Pipeline(stages=stages), estimatorParamMaps=grid, numFolds=2, seed=7,
        evaluator=MulticlassClassificationEvaluator()).fit(rows)
    scores = [(float(g[stages[2].regParam]), round(float(m), 2)) for g, m in zip(grid, fitted.avgMetrics)]
    return x.spark.createDataFrame(scores, "reg_param double, score double")


@query()
def b_ml_train_validation(x: Inputs):
    """Elastic net mix chosen on a held-out fifth."""
    rows = frames.line_prices(x.tables)
    lr = R.LinearRegression(maxIter=5)
    grid = ParamGridBuilder().addGrid(lr.elasticNetParam, [0.0, 1.0]).build()
    fitted = TrainValidationSplit(
        estimator=lr, estimatorParamMaps=grid, evaluator=RegressionEvaluator(),
        trainRatio=0.8, seed=7).fit(rows)
    scores = [(float(g[lr.elasticNetParam]), round(float(m), 0))
              for g, m in zip(grid, fitted.validationMetrics)]
    return x.spark.createDataFrame(scores, "elastic_net double, rmse double")


@query()
def b_ml_param_maps(x: Inputs):
    """The same estimator fitted with parameters given at fit time."""
    rows = frames.binary_vectors(x.tables)
    lr = C.LogisticRegression(maxIter=10, regParam=0.01)
    model = lr.fit(rows, {lr.maxIter: 5, lr.regParam: 0.1, lr.threshold: 0.55})
    return frames.confusion(model.transform(rows))


@query("SELECT label, count(*) AS n FROM embeddings GROUP BY 1")
def b_ml_vector_frame(x: Inputs):
    """Vectors written to files and read back with their type."""
    from starloom.config import fresh_dir

    path = fresh_dir(x.spark, "vectors")
    frames.labelled_vectors(x.tables).write.parquet(path)
    back = x.spark.read.parquet(path).where(F.size(frames.vector_to_array("features")) > 0)
    return back.groupBy(F.col("label").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n"))


_GRAM = """(SELECT i, j, sum(CAST(embedding[i] AS DOUBLE) * CAST(embedding[j] AS DOUBLE)) AS g FROM embeddings,
    (SELECT unnest(range(1, 65)) AS i) a, (SELECT unnest(range(1, 65)) AS j) b GROUP BY 1, 2)"""


@query(f"""SELECT round(sum(CASE WHEN i = j THEN g END), 6) AS squares, round(sum(g * g), 4) AS fourths FROM {_GRAM} x""")
def b_ml_singular_values(x: Inputs):
    """Singular values of the embeddings: the sums of their squares and fourth powers."""
    s = decomposition.svd(x.tables["embeddings"], "vec_id", "embedding").values
    return x.spark.createDataFrame([(round(float((s**2).sum()), 6), round(float((s**4).sum()), 4))], "squares double, fourths double")


@query("""SELECT vec_id, CAST(i AS INTEGER) AS i, round(CAST(embedding[i] AS DOUBLE), 5) AS value
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) e""")
def b_ml_svd_restored(x: Inputs):
    """The embeddings put together again from their decomposition."""
    back = decomposition.svd(x.tables["embeddings"], "vec_id", "embedding").restored()
    return back.select(F.col("id").alias("vec_id"), F.posexplode("row").alias("at", "v")).select(
        "vec_id", (F.col("at") + 1).alias("i"), F.round("v", 5).alias("value"))


@query("""WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1),
        d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(pow(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 2)) AS s
            FROM embeddings a, embeddings b GROUP BY 1, 2, 3),
        m AS (SELECT vec_id, max(CASE WHEN own = other THEN s / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b
            FROM d JOIN c ON c.label = other GROUP BY 1)
    SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM m""")
def b_ml_silhouette(x: Inputs):
    """Silhouette of the stored classes of the embeddings, taken as clusters."""
    rows = frames.labelled_vectors(x.tables).withColumnRenamed("label", "prediction")
    return x.spark.createDataFrame([(round(ClusteringEvaluator().evaluate(rows), 6),)], "silhouette double")


# --- curves and own learners -------------------------------------------------------------

@query("""SELECT threshold, taken, tp, fp, round(tp / taken, 9) AS "precision", round(tp / positives, 9) AS recall, round(fp / negatives, 9) AS fall_out
    FROM (SELECT threshold, CAST(sum(p) OVER w AS DOUBLE) AS tp, CAST(sum(n) OVER w AS DOUBLE) AS fp, CAST(sum(p + n) OVER w AS DOUBLE) AS taken,
            CAST(sum(p) OVER () AS DOUBLE) AS positives, CAST(sum(n) OVER () AS DOUBLE) AS negatives
        FROM (SELECT l_quantity * l_linenumber AS threshold, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS p,
                sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) AS n FROM lineitem GROUP BY 1) c
        WINDOW w AS (ORDER BY threshold DESC)) t""")
def b_ml_threshold_table(x: Inputs):
    """Precision, recall and fall-out at every score: how well a number tells returned items."""
    scored = x.tables["lineitem"].select(
        (F.col("l_quantity") * F.col("l_linenumber")).alias("score"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"))
    table = curves.threshold_table(scored, "score", "label")
    return table.select("threshold", *[F.col(c).cast("double").alias(c) for c in ("taken", "tp", "fp")],
                        *[F.round(c, 9).alias(c) for c in ("precision", "recall", "fall_out")])


@query("""SELECT round(sum(n * (before + p / 2.0)) / (max(positives) * max(negatives)), 9) AS area FROM (
    SELECT p, n, sum(p) OVER (ORDER BY score DESC) - p AS before, sum(p) OVER () AS positives, CAST(sum(n) OVER () AS DOUBLE) AS negatives
    FROM (SELECT value AS score, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS p,
        sum(CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END) AS n FROM events GROUP BY 1) c) t""")
def b_ml_area_under_roc(x: Inputs):
    """How well an event's value tells purchases."""
    scored = x.tables["events"].select("value", (F.col("event_type") == "purchase").cast("int").alias("label"))
    return curves.area_under_roc(curves.threshold_table(scored, "value", "label")).select(F.round("area", 9).alias("area"))


@query("""SELECT round(max(abs(ca / na - cb / nb)), 9) AS distance FROM (
    SELECT sum(a) OVER w AS ca, sum(b) OVER w AS cb, CAST(sum(a) OVER () AS DOUBLE) AS na, CAST(sum(b) OVER () AS DOUBLE) AS nb
    FROM (SELECT value, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS a, sum(CASE WHEN event_type = 'view' THEN 0 ELSE 1 END) AS b
        FROM events GROUP BY 1) c WINDOW w AS (ORDER BY value)) t""")
def b_ml_two_sample_distance(x: Inputs):
    """Kolmogorov-Smirnov distance between the values of views and of other events."""
    found = curves.distance_between(x.tables["events"], "value", F.col("event_type") == "view")
    return found.select(F.round("distance", 9).alias("distance"))


@query()
def b_ml_logistic_threshold(x: Inputs):
    """Area under the curve of a fitted classifier, and its threshold of the best F1."""
    rows = frames.binary_vectors(x.tables)
    scored = C.LogisticRegression(maxIter=20, regParam=0.02).fit(rows).transform(rows)
    table = curves.threshold_table(scored.select(frames.component("probability", 1).alias("score"), "label"), "score", "label")
    best = curves.best_f1(table).select(F.round("threshold", 4).alias("threshold"), F.round("f1", 4).alias("f1"))
    area = curves.area_under_roc(table).select(F.round("area", 4).alias("area"))
    return area.join(F.broadcast(best))  # one row each


@query()
def b_ml_own_k_means(x: Inputs):
    """Lloyd rounds over the embeddings until nothing moves."""
    _, found = learners.k_means(x.tables["embeddings"], "vec_id", "embedding", 10)
    return found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query()
def b_ml_own_logistic(x: Inputs):
    """Newton rounds for the upper half of the classes: the weights."""
    labelled = x.tables["embeddings"].withColumn("upper", (F.col("label") >= 5).cast("int"))
    weights = learners.logistic(labelled, "embedding", "upper", 0.01)
    return x.spark.createDataFrame([(i, round(float(w), 6)) for i, w in enumerate(weights)], "i int, weight double")


def _bought(x: Inputs):
    return x.tables["lineitem"].groupBy("l_partkey", "l_suppkey").agg(F.avg("l_quantity").alias("rating"))


@query()
def b_ml_own_factors(x: Inputs):
    """Alternating least squares over the quantities bought per supplier: fit of the factors."""
    users, items = learners.factors(_bought(x), "l_partkey", "l_suppkey", "rating", rank=4, rounds=3)
    dot = F.aggregate(F.zip_with("f", "g", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    rated = _bought(x).join(users.toDF("l_partkey", "f"), "l_partkey").join(items.toDF("l_suppkey", "g"), "l_suppkey")
    return rated.agg(F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(F.pow(dot - F.col("rating"), 2))), 4).alias("rmse"))


@query("""SELECT count(DISTINCT l_partkey) AS users, CAST(least(5, count(DISTINCT l_suppkey)) * count(DISTINCT l_partkey) AS BIGINT) AS n,
    true AS falling FROM lineitem""")
def b_ml_recommend_top(x: Inputs):
    """The five suppliers of the greatest products per part, in falling order."""
    users, items = learners.factors(_bought(x), "l_partkey", "l_suppkey", "rating", rank=4, rounds=2)
    top = learners.top_items(users, items, 5)
    per_user = top.groupBy("user").agg(F.count(F.lit(1)).alias("k"), F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("s"))
    falling = F.expr("forall(sequence(1, size(s) - 1), i -> s[i - 1].score >= s[i].score AND s[i].rank = i + 1)")
    return per_user.agg(F.count(F.lit(1)).alias("users"), F.sum("k").alias("n"), F.min((F.size("s") < 2) | falling).alias("falling"))
