"""Feature transformers over the tables."""

from __future__ import annotations

from pyspark.ml import feature as T
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from starloom.ml import frames
from starloom.ml.frames import KEYS, component
from starloom.operators.facts import stored
from starloom.registry.base import Inputs, Registry

REGISTRY = Registry()
query = REGISTRY.query

KEY_SQL = ", ".join(KEYS)


def _lines(x: Inputs, columns=None):
    return frames.line_numbers(x.tables, columns)


def _entries(df, names: list[str], vector: str = "out", digits: int | None = None):
    """The keys and the vector's entries as plain columns."""
    values = [component(vector, i) for i in range(len(names))]
    if digits is not None:
        values = [F.round(v, digits) for v in values]
    return df.select(*KEYS, *[v.alias(n) for v, n in zip(values, names)])


@query(f"SELECT {KEY_SQL}, CASE WHEN l_quantity > 25 THEN 1.0::DOUBLE ELSE 0.0 END AS out "
       "FROM lineitem")
def b_ml_binarizer(x: Inputs):
    t = T.Binarizer(threshold=25.0, inputCol="l_quantity", outputCol="out")
    return t.transform(x.tables["lineitem"]).select(*KEYS, "out")


@query(f"SELECT {KEY_SQL}, CAST(CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 30 THEN 1 "
       "ELSE 2 END AS DOUBLE) AS out FROM lineitem")
def b_ml_bucketizer(x: Inputs):
    t = T.Bucketizer(splits=[-float("inf"), 10, 30, float("inf")], inputCol="l_quantity",
                     outputCol="out")
    return t.transform(x.tables["lineitem"]).select(*KEYS, "out")


@query(f"SELECT {KEY_SQL}, l_quantity * 2 AS a, l_discount * 0.5::DOUBLE AS b FROM lineitem")
def b_ml_elementwise_product(x: Inputs):
    t = T.ElementwiseProduct(scalingVec=Vectors.dense([2.0, 0.5]), inputCol="features",
                             outputCol="out")
    return _entries(t.transform(_lines(x, ["l_quantity", "l_discount"])), ["a", "b"])


@query(f"SELECT {KEY_SQL}, round(l_quantity / (l_quantity + l_tax), 9) AS a, "
       "round(l_tax / (l_quantity + l_tax), 9) AS b FROM lineitem")
def b_ml_normalizer(x: Inputs):
    t = T.Normalizer(p=1.0, inputCol="features", outputCol="out")
    return _entries(t.transform(_lines(x, ["l_quantity", "l_tax"])), ["a", "b"], digits=9)


def _fitted(x: Inputs, estimator, columns, names, digits):
    rows = _lines(x, columns)
    return _entries(estimator.fit(rows).transform(rows), names, digits=digits)


@query(f"SELECT {KEY_SQL}, round((l_quantity - lo) / (hi - lo), 9) AS a FROM lineitem, "
       "(SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem) m")
def b_ml_min_max_scaler(x: Inputs):
    return _fitted(x, T.MinMaxScaler(inputCol="features", outputCol="out"), ["l_quantity"], ["a"], 9)


@query(f"SELECT {KEY_SQL}, round(l_extendedprice / hi, 9) AS a FROM lineitem, "
       "(SELECT max(abs(l_extendedprice)) AS hi FROM lineitem) m")
def b_ml_max_abs_scaler(x: Inputs):
    return _fitted(x, T.MaxAbsScaler(inputCol="features", outputCol="out"),
                   ["l_extendedprice"], ["a"], 9)


@query(f"SELECT {KEY_SQL}, round(l_quantity / s, 6) AS a FROM lineitem, "
       "(SELECT stddev_samp(l_quantity) AS s FROM lineitem) m")
def b_ml_standard_scaler(x: Inputs):
    return _fitted(x, T.StandardScaler(inputCol="features", outputCol="out"),
                   ["l_quantity"], ["a"], 6)


@query()
def b_ml_robust_scaler(x: Inputs):
    return _fitted(x, T.RobustScaler(inputCol="features", outputCol="out", withCentering=True),
                   ["l_quantity"], ["a"], 6)


@query(f"SELECT {KEY_SQL}, round(coalesce(nullif(l_discount, 0), m), 6) AS a FROM lineitem, "
       "(SELECT avg(nullif(l_discount, 0)) AS m FROM lineitem) t")
def b_ml_imputer(x: Inputs):
    """Missing discounts take the mean of the others."""
    rows = x.tables["lineitem"].withColumn("d", F.expr("nullif(l_discount, 0D)"))
    filled = T.Imputer(inputCols=["d"], outputCols=["out"]).fit(rows).transform(rows)
    return filled.select(*KEYS, F.round("out", 6).alias("a"))


RANKED = """(SELECT p_brand AS b, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1
    AS DOUBLE) AS i FROM part GROUP BY 1)"""


@query(f"SELECT p_partkey, i AS brand FROM part JOIN {RANKED} r ON b = p_brand")
def b_ml_string_indexer(x: Inputs):
    rows = x.tables["part"].select("p_partkey", "p_brand")
    return T.StringIndexer(inputCol="p_brand", outputCol="brand").fit(rows).transform(rows).select(
        "p_partkey", "brand")


@query("SELECT p_partkey, p_brand AS back FROM part")
def b_ml_index_to_string(x: Inputs):
    rows = x.tables["part"].select("p_partkey", "p_brand")
    coded = T.StringIndexer(inputCol="p_brand", outputCol="i").fit(rows).transform(rows)
    return T.IndexToString(inputCol="i", outputCol="back").transform(coded).select(
        "p_partkey", "back")


@query("SELECT p_partkey, CASE WHEN p_size = 1 THEN 1.0::DOUBLE ELSE 0.0 END AS one, "
       "CASE WHEN p_size = 7 THEN 1.0::DOUBLE ELSE 0.0 END AS seven FROM part")
def b_ml_one_hot(x: Inputs):
    rows = x.tables["part"].select("p_partkey", F.col("p_size").cast("double").alias("size"))
    coded = T.OneHotEncoder(inputCols=["size"], outputCols=["out"]).fit(rows).transform(rows)
    return coded.select("p_partkey", component("out", 1).alias("one"),
                        component("out", 7).alias("seven"))


@query(f"SELECT {KEY_SQL}, l_quantity AS a, l_discount AS b FROM lineitem")
def b_ml_vector_assembler(x: Inputs):
    return _entries(_lines(x, ["l_quantity", "l_discount"]), ["a", "b"], "features")


@query(f"SELECT {KEY_SQL}, l_extendedprice AS a, l_tax AS b FROM lineitem")
def b_ml_vector_slicer(x: Inputs):
    t = T.VectorSlicer(inputCol="features", outputCol="out", indices=[1, 3])
    return _entries(t.transform(_lines(x)), ["a", "b"])


@query("SELECT count(*) AS n FROM lineitem")
def b_ml_vector_size_hint(x: Inputs):
    """Vectors of another size would be skipped; none are."""
    t = T.VectorSizeHint(inputCol="features", handleInvalid="skip", size=4)
    return t.transform(_lines(x)).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {KEY_SQL}, l_quantity AS a, l_quantity * l_quantity AS aa, l_tax AS b, "
       "l_quantity * l_tax AS ab, l_tax * l_tax AS bb FROM lineitem")
def b_ml_polynomial(x: Inputs):
    t = T.PolynomialExpansion(degree=2, inputCol="features", outputCol="out")
    return _entries(t.transform(_lines(x, ["l_quantity", "l_tax"])), ["a", "aa", "b", "ab", "bb"])


@query(f"SELECT {KEY_SQL}, l_linenumber * l_quantity AS a, l_linenumber * l_tax AS b FROM lineitem")
def b_ml_interaction(x: Inputs):
    t = T.Interaction(inputCols=["l_linenumber", "features"], outputCol="out")
    return _entries(t.transform(_lines(x, ["l_quantity", "l_tax"])), ["a", "b"])


@query(f"SELECT {KEY_SQL}, l_quantity + l_tax AS a FROM lineitem")
def b_ml_sql_transformer(x: Inputs):
    t = T.SQLTransformer(statement=f"SELECT {KEY_SQL}, l_quantity + l_tax AS a FROM __THIS__")
    return t.transform(x.tables["lineitem"])


@query()
def b_ml_quantile_discretizer(x: Inputs):
    rows = x.tables["events"].select("event_id", "value")
    t = T.QuantileDiscretizer(numBuckets=4, inputCol="value", outputCol="out", relativeError=0.001)
    return t.fit(rows).transform(rows).groupBy("out").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(l_linenumber - 1 AS DOUBLE) AS line, count(*) AS n FROM lineitem GROUP BY 1")
def b_ml_vector_indexer(x: Inputs):
    rows = _lines(x, ["l_linenumber", "l_quantity"])
    t = T.VectorIndexer(inputCol="features", outputCol="out", maxCategories=10)
    return t.fit(rows).transform(rows).groupBy(component("out", 0).alias("line")).agg(
        F.count(F.lit(1)).alias("n"))


def _dct_sql(k: int, name: str) -> str:
    terms = " + ".join(f"{c} * cos(pi() * {2 * n + 1} * {k} / 8)" for n, c in
                       enumerate(frames.NUMBERS))
    return f"round(({terms}) * sqrt({0.25 if k == 0 else 0.5}::DOUBLE), 3) AS {name}"


@query(f"SELECT {KEY_SQL}, {', '.join(_dct_sql(k, c) for k, c in enumerate('abcd'))} FROM lineitem")
def b_ml_dct(x: Inputs):
    t = T.DCT(inverse=False, inputCol="features", outputCol="out")
    return _entries(t.transform(_lines(x)), ["a", "b", "c", "d"], digits=3)


@query()
def b_ml_pca(x: Inputs):
    rows = frames.labelled_vectors(x.tables)
    model = T.PCA(k=3, inputCol="features", outputCol="out").fit(rows)
    return model.transform(rows).select(
        "vec_id", *[F.round(F.abs(component("out", i)), 4).alias(f"pc{i}") for i in range(3)])


@query("SELECT c_custkey, CASE WHEN c_acctbal <> 0 THEN 2 ELSE 1 END AS filled FROM customer")
def b_ml_feature_hasher(x: Inputs):
    t = T.FeatureHasher(inputCols=["c_acctbal", "c_mktsegment"], outputCol="out", numFeatures=1 << 12)
    sizes = F.size(F.filter(frames.stored_entries("out"), lambda v: v != 0))
    return t.transform(x.tables["customer"]).select("c_custkey", sizes.alias("filled"))


@query("SELECT c_custkey, c_acctbal AS label, (SELECT count(DISTINCT c_mktsegment) FROM customer) "
       "AS width FROM customer")
def b_ml_r_formula(x: Inputs):
    rows = x.tables["customer"].select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    t = T.RFormula(formula="c_acctbal ~ c_mktsegment + c_nationkey")
    return t.fit(rows).transform(rows).select(
        "c_custkey", "label", F.size(frames.vector_to_array("features")).alias("width"))


# --- selection ---------------------------------------------------------------------------

@query("""SELECT CASE WHEN var_samp(l_quantity) > 1 THEN 1 ELSE 0 END + CASE WHEN
    var_samp(l_extendedprice) > 1 THEN 1 ELSE 0 END + CASE WHEN var_samp(l_discount) > 1 THEN 1
    ELSE 0 END + CASE WHEN var_samp(l_tax) > 1 THEN 1 ELSE 0 END AS kept FROM lineitem""")
def b_ml_variance_threshold(x: Inputs):
    rows = _lines(x)
    t = T.VarianceThresholdSelector(varianceThreshold=1.0, featuresCol="features", outputCol="out")
    picked = t.fit(rows).transform(rows)
    return picked.agg(F.max(F.size(frames.vector_to_array("out"))).alias("kept"))


@query()
def b_ml_chi_square_selector(x: Inputs):
    rows = frames.assembled(x.tables["lineitem"].select(
        *[F.col(c).cast("double") for c in ("l_linenumber", "l_quantity")],
        (F.ascii("l_returnflag") - 65).cast("double").alias("label")),
        ["l_linenumber", "l_quantity"])
    model = T.ChiSqSelector(numTopFeatures=1, featuresCol="features", outputCol="out",
                            labelCol="label").fit(rows)
    return x.spark.createDataFrame([(int(i),) for i in model.selectedFeatures], "feature int")


@query("""WITH v AS (SELECT label, i - 1 AS feature, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, (SELECT unnest(range(1, 65)) AS i) r),
        g AS (SELECT feature, label, count(*) AS n, avg(x) AS m, var_pop(x) * count(*) AS within FROM v GROUP BY 1, 2),
        t AS (SELECT feature, avg(x) AS mean FROM v GROUP BY 1),
        f AS (SELECT feature, sum(n * (m - mean) * (m - mean)) / sum(within) AS ratio FROM g JOIN t USING (feature) GROUP BY 1)
    SELECT CAST(arg_max(feature, ratio) AS INTEGER) AS feature FROM f""")
def b_ml_univariate_selector(x: Inputs):
    rows = frames.labelled_vectors(x.tables)
    t = T.UnivariateFeatureSelector(featuresCol="features", outputCol="out", labelCol="label",
                                    selectionMode="numTopFeatures")
    model = t.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(
        1).fit(rows)
    return x.spark.createDataFrame([(int(i),) for i in model.selectedFeatures], "feature int")


# --- text --------------------------------------------------------------------------------

def _tokens(x: Inputs, table: str = "documents", key: str = "doc_id"):
    return T.Tokenizer(inputCol="text", outputCol="words").transform(
        x.tables[table].select(key, "text"))


#: sum of the entries of a sparse vector, without making it dense
_total = F.udf(lambda v: float(v.values.sum()), DoubleType())


def _joined(column: str, name: str = "tokens"):
    """All tokens in order, as one digest."""
    return F.sha2(F.concat_ws("|", column), 256).alias(name)


_SPLIT = "string_split_regex(rtrim(lower(text), ' ' || chr(10)), '\\s')"


@query(f"SELECT item_id, len({_SPLIT}) AS words, sha256(array_to_string({_SPLIT}, '|')) AS tokens FROM benchmark")
def b_ml_tokenizer(x: Inputs):
    return _tokens(x, "benchmark", "item_id").select("item_id", F.size("words").alias("words"), _joined("words"))


@query("SELECT doc_id, len(w) AS words, sha256(array_to_string(w, '|')) AS tokens FROM "
       "(SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents) d")
def b_ml_regex_tokenizer(x: Inputs):
    t = T.RegexTokenizer(inputCol="text", outputCol="words", pattern="[a-z]+", gaps=False)
    return t.transform(x.tables["documents"].select("doc_id", "text")).select(
        "doc_id", F.size("words").alias("words"), _joined("words"))


@query(f"""SELECT item_id, greatest(len(w) - 1, 0) AS pairs, sha256(array_to_string(list_transform(range(1, len(w)),
    lambda i: w[i] || ' ' || w[i + 1]), '|')) AS tokens FROM (SELECT item_id, {_SPLIT} AS w FROM benchmark) b""")
def b_ml_n_gram(x: Inputs):
    t = T.NGram(n=2, inputCol="words", outputCol="out")
    return t.transform(_tokens(x, "benchmark", "item_id")).select(
        "item_id", F.size("out").alias("pairs"), _joined("out"))


# fixed values: frequent words of the texts' languages
STOP_WORDS = ["the", "and", "that", "in", "de", "la", "que", "der", "die", "und", "le", "et"]


@query(f"""SELECT doc_id, len(k) AS kept, sha256(array_to_string(k, '|')) AS tokens FROM (
    SELECT doc_id, list_filter({_SPLIT}, lambda w: w NOT IN ({", ".join(f"'{w}'" for w in STOP_WORDS)})) AS k FROM documents) d""")
def b_ml_stop_words(x: Inputs):
    t = T.StopWordsRemover(inputCol="words", outputCol="out", stopWords=STOP_WORDS)
    return t.transform(_tokens(x)).select("doc_id", F.size("out").alias("kept"), _joined("out"))


@query(f"""WITH t AS (SELECT doc_id, unnest({_SPLIT}) AS w FROM documents),
    d AS (SELECT w, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(DISTINCT doc_id))) AS idf FROM t GROUP BY w)
    SELECT doc_id, round(sum(idf), 4) AS weight FROM t JOIN d USING (w) GROUP BY doc_id""")
def b_ml_counted_idf(x: Inputs):
    """Weights of exact words, not of hashed ones; the vocabulary is as large as it takes."""
    rows = _tokens(x)
    size = max(1, rows.select(F.explode("words").alias("w")).distinct().count())
    counts = T.CountVectorizer(inputCol="words", outputCol="tf", vocabSize=size).fit(rows).transform(rows)
    counts = stored(counts.select("doc_id", "tf"), "counts")  # fitted and weighed without the texts
    scored = T.IDF(inputCol="tf", outputCol="out").fit(counts).transform(counts)
    return scored.select("doc_id", F.round(_total("out"), 4).alias("weight"))


@query("""WITH t AS (SELECT doc_id, unnest(string_split_regex(rtrim(lower(text), ' ' || chr(10)), '\\s')) AS w FROM documents),
    d AS (SELECT w FROM t GROUP BY w HAVING count(DISTINCT doc_id) >= 2)
    SELECT doc_id, CAST(count(d.w) AS DOUBLE) AS hits FROM t LEFT JOIN d USING (w) GROUP BY doc_id""")
def b_ml_count_vectorizer(x: Inputs):
    rows = _tokens(x)
    model = T.CountVectorizer(inputCol="words", outputCol="out", vocabSize=1 << 20, minDF=2.0).fit(rows)
    return model.transform(rows).select("doc_id", _total("out").alias("hits"))


@query()
def b_ml_tf_idf(x: Inputs):
    counts = T.HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 18).transform(_tokens(x))
    scored = T.IDF(inputCol="tf", outputCol="out").fit(counts).transform(counts)
    return scored.select("doc_id", F.round(_total("out"), 4).alias("weight"))


@query()
def b_ml_word_vectors(x: Inputs):
    rows = _tokens(x, "conversations", "conv_id")
    model = T.Word2Vec(vectorSize=3, minCount=1, maxIter=1, seed=7, inputCol="words",
                       outputCol="out").fit(rows)
    return model.transform(rows).select("conv_id", F.size(frames.vector_to_array("out")).alias("d"))


# --- near neighbours ---------------------------------------------------------------------

@query()
def b_ml_projection_hashing(x: Inputs):
    """Approximate nearest stored vectors of the mean vector."""
    rows = frames.labelled_vectors(x.tables)
    center = rows.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"]
    model = T.BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=2.0, numHashTables=3, seed=7).fit(rows)
    return model.approxNearestNeighbors(rows, center, 5).select(
        "vec_id", F.round("distCol", 4).alias("distance"))


@query()
def b_ml_min_hash(x: Inputs):
    """Approximate nearest texts of the first benchmark item."""
    def shingled(table, key):
        return T.HashingTF(inputCol="words", outputCol="features", numFeatures=1 << 18,
                           binary=True).transform(_tokens(x, table, key))

    probe = shingled("benchmark", "item_id").orderBy("item_id").first()["features"]
    rows = shingled("documents", "doc_id").where(F.size("words") > 0)
    model = T.MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=5, seed=7).fit(rows)
    return model.approxNearestNeighbors(rows, probe, 5).select(
        "doc_id", F.round("distCol", 4).alias("distance"))
