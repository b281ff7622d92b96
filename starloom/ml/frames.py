"""Feature frames over the tables."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, Tokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from starloom.operators.facts import stored
from starloom.sources.readers import TableSet

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
#: rows of one task of a learner, which keeps them in memory from round to round
ROWS_PER_TASK = 250_000


def assembled(df: DataFrame, columns: list[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=name).transform(df)


def dealt(rows: DataFrame, per_task: int = ROWS_PER_TASK, by: tuple = ()) -> DataFrame:
    """The same rows over so many tasks that none has more than about ``per_task``, and all cores
    have some, however the files are split; in ranges of the columns ``by`` if given. Rows that
    fit one task stay as they are."""
    n = -(-rows.count() // per_task)
    if n <= 1:
        return rows
    n = max(n, rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartitionByRange(n, *by) if by else rows.repartition(n)


def line_numbers(tables: TableSet, columns: list[str] | None = None) -> DataFrame:
    """Line items with their numeric columns as a vector."""
    columns = columns or NUMBERS
    return assembled(tables["lineitem"].select(*KEYS, "l_returnflag", "l_linestatus", *NUMBERS),
                     columns)


def labelled_vectors(tables: TableSet) -> DataFrame:
    """The stored vectors with their class."""
    vector = array_to_vector(F.col("embedding").cast("array<double>"))
    return tables["embeddings"].select(
        "vec_id", F.col("label").cast("double").alias("label"), vector.alias("features"))


def binary_vectors(tables: TableSet) -> DataFrame:
    """The stored vectors; class one is the upper half of the labels."""
    return labelled_vectors(tables).withColumn(
        "label", F.when(F.col("label") >= 5, 1.0).otherwise(0.0))


def line_prices(tables: TableSet) -> DataFrame:
    """Line items with the price as label and quantity and discount as features."""
    rows = tables["lineitem"].select(
        *KEYS, "l_quantity", "l_discount", F.col("l_extendedprice").alias("label"))
    return assembled(dealt(rows), ["l_quantity", "l_discount"])


def labelled_texts(tables: TableSet) -> DataFrame:
    """Documents that carry a quality label."""
    return tables["documents"].join(tables["labels"], "doc_id").select(
        "doc_id", "text", F.col("quality").cast("double").alias("label"))


def hashed_counts(tables: TableSet, size: int) -> DataFrame:
    """Counts of the hashed words of every document, written once for the many passes of a learner."""
    tokens = Tokenizer(inputCol="text", outputCol="words").transform(tables["documents"].select("doc_id", "text"))
    counts = HashingTF(inputCol="words", outputCol="features", numFeatures=size).transform(tokens)
    return stored(counts.select("doc_id", "features"), "counts")


def component(name: str, index: int):
    """One entry of a vector column."""
    return vector_to_array(F.col(name))[index]


def stored_entries(name: str):
    """The entries a vector column holds, as an array: all of a dense vector, those that are not
    left out of a sparse one. As long as the vector is full, not as wide as it is."""
    return F.unwrap_udt(F.col(name))["values"]


def confusion(predictions: DataFrame, label: str = "label") -> DataFrame:
    """Counts per true and predicted class."""
    return predictions.groupBy(label, "prediction").agg(F.count(F.lit(1)).alias("n"))


def error_summary(predictions: DataFrame, label: str = "label") -> DataFrame:
    """Root mean squared and mean absolute error over all rows."""
    miss = F.col(label) - F.col("prediction")
    return predictions.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sqrt(F.avg(miss * miss)), 4).alias("rmse"),
        F.round(F.avg(F.abs(miss)), 4).alias("mae"))
