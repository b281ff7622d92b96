"""Documents to training sequences in five stages.

Language ID, line dedup, near-copies of whole documents, repeated passages, packing. Each stage
works on what the one before kept, written as Parquet; all but the last return the columns of
``documents``. Stages compare texts of many documents, so SQL over the tables cannot express
them; the tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.config import fresh_dir
from starloom.llm import language, line_dedup, ngram_join, packing, substring_dedup
from starloom.llm.arrow import unused
from starloom.llm.queries import table, vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an undetermined language go."""
    return language.keep_identified(docs, "doc_id", "text", "lang", "source")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Similar lines stay once in the corpus. A document goes when lines were cut out of it and
    only blank ones are left: all it said stands elsewhere."""
    count = unused(docs, "n_removed")
    cut = line_dedup.dedup_lines(docs, "doc_id", "text", count_col=count)
    kept = cut.where((F.col(count) == 0) | F.col("text").rlike(r"(?U)\S"))
    return _measured(kept, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents that of the smallest id stays."""
    joined = ngram_join.similarity_join(docs, "doc_id", "text")
    name = unused(docs, "_gone")
    gone = joined.where("component_id <> doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def dedup_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages stay in the document of smallest id; one of which nothing is left goes."""
    cut = substring_dedup.dedup_substrings(docs, "doc_id", "text", paragraph_words=substring_dedup.PARAGRAPH_WORDS)
    return _measured(cut.where("text is null or trim(text) <> '' or n_chars = 0"), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as sequences of at most 4096 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


def _measured(cut: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the length of the text as it is now."""
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", dedup_substrings),
    ("best_fit_packing", pack),
]

#: no SQL expresses the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            path = fresh_dir(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
