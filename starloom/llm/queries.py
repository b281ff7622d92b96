"""The registered queries of the training-data operators, on the whole tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import packing

    return packing.pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import pieces

    return pieces.encode_decode(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import html_text

    return html_text.extract(table(spark, folder, "pages"))


@query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import token_counts

    return token_counts.token_counts(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by text, declared language and source; pages by text, markup and address. Both
    share the model fitted on the documents."""
    from starloom.llm import language

    documents = table(spark, folder, "documents")
    pages = table(spark, folder, "pages").select(
        "page_id", "url", language.page_text("html").alias("text"), language.page_declares("html").alias("declared"))
    model = language.fit(documents.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared")))
    judged = partial(language.identify, model=model)
    of_documents = judged(documents, "doc_id", "text", "lang", "source").withColumnRenamed("id", "doc_id")
    of_pages = judged(pages, "page_id", "text", "declared", "url").withColumnRenamed("id", "page_id")
    return of_documents.unionByName(of_pages, allowMissingColumns=True)


@query
def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import ngram_join

    return ngram_join.similarity_join(table(spark, folder, "documents"))


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import line_dedup

    return line_dedup.dedup_lines(table(spark, folder, "documents")).select("doc_id", "text", "n_removed")


@query
def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import substring_dedup

    return substring_dedup.repeated_spans(table(spark, folder, "documents"), paragraph_words=substring_dedup.PARAGRAPH_WORDS)


@query
def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import neighbours

    return neighbours.search(table(spark, folder, "embeddings"))


@query
def op4_top_k_search(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import topk

    return topk.search(table(spark, folder, "documents"))


# words lie between ASCII white space; only A-Z has a lower case
_WORDS_SQL = r"""
    SELECT doc_id, term FROM (
        SELECT doc_id, unnest(string_split_regex(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+')) AS term
        FROM documents) WHERE term <> ''
"""

SQL["op4_top_k_search"] = f"""
WITH words AS ({_WORDS_SQL}),
     lens AS (SELECT doc_id, count(*) AS dl FROM words GROUP BY doc_id),
     stats AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM words) / (SELECT count(*) FROM documents) AS mean),
     tf AS (SELECT doc_id, term, count(*) AS tf, any_value(dl) AS dl FROM words JOIN lens USING (doc_id) GROUP BY doc_id, term),
     df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
     scored AS (
         SELECT q.doc_id AS query_id, d.doc_id,
                round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * d.dl / mean))), 6) AS score
         FROM tf q JOIN tf d USING (term) JOIN df USING (term) CROSS JOIN stats
         WHERE q.doc_id % 20 = 0 GROUP BY 1, 2),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import whitening

    return whitening.whiten(table(spark, folder, "embeddings")).withColumn("deviation", F.col("deviation").cast("bigint"))


@query
def op12_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import decontamination

    found = decontamination.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_SMALL_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op12_benchmark_decontamination"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_SMALL_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_SMALL_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     starts AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0),
     cut AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS win FROM starts),
     sizes AS (SELECT DISTINCT n FROM cut),
     places AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs JOIN sizes ON len(w) >= n),
     found AS (SELECT r, i, p.n, item FROM (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win FROM places) p JOIN cut USING (n, win)),
     hit AS (SELECT r, count(DISTINCT word) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS word FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r),
     lists AS (SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN lists USING (r)
"""


@query
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    from starloom.llm import ranked

    return ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def _terms_sql(key: str, of: str) -> str:
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"SELECT {key}, unnest(regexp_extract_all({small}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM {of}"


SQL["op13_ranked_search"] = f"""
WITH terms AS ({_terms_sql("doc_id", "documents")}),
     asked AS (SELECT item_id, term, count(*) AS times FROM ({_terms_sql("item_id", "benchmark")}) GROUP BY item_id, term),
     lens AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
     stats AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lens),
     tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
     df AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, stats GROUP BY term, docs),
     scored AS (
         SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS BIGINT) AS score
         FROM asked JOIN tf USING (term) JOIN df USING (term) JOIN lens USING (doc_id), stats GROUP BY item_id, doc_id),
     ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
