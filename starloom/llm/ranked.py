"""Ranked lexical search with hashed max-sketches.

The impact of a term in a document, without the term's weight, is folded into one of ``BUCKETS``
coordinates by the term's hash; a coordinate keeps the largest. A query looks its terms'
coordinates up and sums them by its weights: as a coordinate is at least the impact of each of
its terms, that sum bounds the score from above. The bounds of a batch of documents and all queries
are one matrix product. Each query then scores documents exactly in falling order of their bound
until the next bound is below its k-th best score so far.

Two passes over the documents: counts (documents, terms, documents per asked term), then sketches,
bounds and scores inside the task that holds the text, so that no index, no text and no sketch
moves. Of a task only k rows per query leave; ranks of ranks merge them. Queries come in blocks
of bounded size, each block a search of its own; scores are integers, so nothing depends on
the order of sums.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from starloom.llm import hashing
from starloom.llm.arrow import slices, stored, tidy
from starloom.llm.hashing import U

K, BUCKETS = 10, 2048
#: distinct (query, term) entries of a block of queries, and queries in it
BLOCK_TERMS, BLOCK_QUERIES = 200_000, 512
#: documents scored exactly at a time for each query
STEP = 8
#: results of a query are first ranked in so many groups of tasks
GROUPS = 16

_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x80:] = True
for _lo, _hi in (("0", "9"), ("A", "Z"), ("a", "z")):
    _IN_WORD[ord(_lo) : ord(_hi) + 1] = True


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every term: runs of ASCII letters, digits and what is beyond ASCII, A-Z as
    a-z. What lies between is blanked, so that the words of the result are the terms."""
    spaces = bytes(i if _IN_WORD[i] else 0x20 for i in range(256))
    found = hashing.words([t.translate(spaces) for t in texts])
    return found.hash, found.row


class Queries:
    """A block of queries: distinct terms by hash, and per query its terms with their repeats."""

    def __init__(self, ids: list, hashes: list[np.ndarray]):
        self.ids = ids
        self.term = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, U)
        entry = [np.unique(np.searchsorted(self.term, h), return_counts=True) for h in hashes]
        self.first = np.cumsum([0, *(len(t) for t, _ in entry)])
        self.of = np.concatenate([t for t, _ in entry]) if entry else np.zeros(0, np.int64)
        self.repeats = np.concatenate([c for _, c in entry]) if entry else np.zeros(0, np.int64)
        self.weight = np.zeros(len(self.of), np.int64)

    def weigh(self, n: int, frequency: np.ndarray) -> None:
        w = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for f in frequency.tolist()], np.int64)
        self.weight = w[self.of] * self.repeats

    def lookup(self, hashed: np.ndarray) -> np.ndarray:
        """The number of each term among the asked ones, -1 for others."""
        if not len(self.term):
            return np.full(len(hashed), -1)
        at = np.minimum(np.searchsorted(self.term, hashed), len(self.term) - 1)
        return np.where(self.term[at] == hashed, at, -1)


def _bucket(hashed: np.ndarray, buckets: int) -> np.ndarray:
    return (hashing.mix(hashed) % U(buckets)).astype(np.int64)


class Batch:
    """Documents of one batch: impacts of their terms, their sketches, exact scores."""

    def __init__(self, texts: list[bytes], n: int, total: int, queries: Queries, buckets: int):
        hashed, row = terms(texts)
        order = np.lexsort((hashed, row))
        hashed, row = hashed[order], row[order]
        first = np.ones(len(hashed), bool)
        first[1:] = (hashed[1:] != hashed[:-1]) | (row[1:] != row[:-1])
        starts = np.flatnonzero(first)
        tf = np.diff(np.append(starts, len(hashed)))
        hashed, row = hashed[starts], row[starts]
        length = np.bincount(row, tf, len(texts)).astype(np.int64)
        most = int(length.max()) if len(length) else 0
        share = 75 * length * n // total if 75 * most * n < 1 << 63 else (75 * length.astype(object) * n // total).astype(np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * (25 + share)[row])
        self.size = len(texts)
        # only coordinates that some query looks up are ever read
        asked, self.column = np.unique(_bucket(queries.term, buckets), return_inverse=True)
        place = np.full(buckets, -1)
        place[asked] = np.arange(len(asked))
        at = place[_bucket(hashed, buckets)]
        keep = at >= 0
        sketch = np.zeros(self.size * len(asked))
        np.maximum.at(sketch, row[keep] * len(asked) + at[keep], impact[keep].astype(float))
        self.sketch = sketch.reshape(self.size, len(asked))
        known = queries.lookup(hashed)
        keep = known >= 0
        key = row[keep] * max(len(queries.term), 1) + known[keep]
        order = np.argsort(key)
        self.key, self.impact, self.queries = key[order], impact[keep][order], queries

    def bounds(self) -> np.ndarray:
        """Upper bound of every document's score for every query; raised by more than the sums,
        which are of whole numbers, can lose in doubles."""
        q = self.queries
        table = np.zeros((self.sketch.shape[1], len(q.ids)))
        np.add.at(table, (self.column[q.of], np.repeat(np.arange(len(q.ids)), np.diff(q.first))), q.weight.astype(float))
        return self.sketch @ table * (1 + 1e-9)

    def scores(self, doc: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact scores of pairs."""
        q = self.queries
        size = q.first[query + 1] - q.first[query]
        pair = np.repeat(np.arange(len(doc)), size)
        entry = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + q.first[query][pair]
        key = doc[pair] * len(q.term) + q.of[entry]
        at = np.minimum(np.searchsorted(self.key, key), max(len(self.key) - 1, 0))
        hit = np.flatnonzero(self.key[at] == key) if len(self.key) else np.zeros(0, np.int64)
        out = np.zeros(len(doc), np.int64)
        np.add.at(out, pair[hit], q.weight[entry[hit]] * self.impact[at[hit]])
        return out


class Best:
    """The k best documents of every query so far: score falling, then id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.rows: list[list[tuple]] = [[] for _ in range(queries)]
        self.least = np.ones(queries, np.int64)  # a score below this is no result
        self.scored = 0

    def search(self, batch: Batch, ids: list) -> None:
        bound = batch.bounds().T
        order = np.argsort(-bound, axis=1, kind="stable")
        open_ = np.arange(len(bound))
        for lo in range(0, batch.size, STEP):
            chosen = order[open_, lo : lo + STEP]
            above = bound[open_[:, None], chosen] >= self.least[open_][:, None]
            at, column = np.nonzero(above)
            if not len(at):
                break
            doc, query = chosen[at, column], open_[at]
            score = batch.scores(doc, query)
            self.scored += len(doc)
            for i in np.flatnonzero(score >= self.least[query]).tolist():
                self._add(int(query[i]), int(score[i]), ids[doc[i]])
            open_ = open_[above.all(1)]  # bounds fall: one too low ends the batch for its query

    def _add(self, query: int, score: int, doc) -> None:
        rows = self.rows[query]
        rows.append((-score, doc))
        if len(rows) > self.k:
            rows.sort()
            rows.pop()
        if len(rows) == self.k:
            self.least[query] = -max(rows)[0]


# --- over the tables -----------------------------------------------------------------------

def _counts(texts: DataFrame, queries: Queries) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and documents per asked term."""

    def run(batches):
        documents, total, frequency = 0, 0, np.zeros(len(queries.term), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                hashed, row = terms(hashing.raw_texts(part.column("text")))
                documents, total = documents + len(np.unique(row)), total + len(row)
                at = queries.lookup(hashed)
                pairs = np.unique(row[at >= 0] * max(len(queries.term), 1) + at[at >= 0])
                frequency += np.bincount(pairs % max(len(queries.term), 1), minlength=len(queries.term))
        some = np.flatnonzero(frequency)
        yield pa.RecordBatch.from_arrays([pa.array(np.append([-2, -1], some)), pa.array(np.append([documents, total], frequency[some]))], ["term", "n"])

    found = dict(texts.mapInArrow(tidy(run), "term bigint, n bigint").groupBy("term").agg(F.sum("n")).toPandas().itertuples(index=False, name=None))
    frequency = np.array([found.get(i, 0) for i in range(len(queries.term))], np.int64)
    return int(found.get(-2, 0)), int(found.get(-1, 0)), frequency


def _block(rows: DataFrame) -> Queries:
    """The queries of a block; rows of one id are one query."""
    held: dict = {}
    for item, text in rows.toLocalIterator():
        hashed, _ = terms([text.encode()])
        held[item] = np.concatenate((held[item], hashed)) if item in held else hashed
    held = {i: h for i, h in held.items() if len(h)}
    return Queries(list(held), list(held.values()))


def _search(docs: DataFrame, queries: Queries, n: int, total: int, k: int, buckets: int, item_type: DataType) -> DataFrame:
    id_type = docs.schema["id"].dataType
    item_arrow, id_arrow = to_arrow_type(item_type), to_arrow_type(id_type)

    def run(batches):
        best = Best(len(queries.ids), k)
        for batch in batches:
            for part in slices(batch.select(["id", "text"]), "text"):
                best.search(Batch(hashing.raw_texts(part.column("text")), n, total, queries, buckets), part.column("id").to_pylist())
        found = [(q, d, -s) for q, rows in zip(queries.ids, best.rows) for s, d in rows]
        q, d, s = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(q, item_arrow), pa.array(d, id_arrow), pa.array(s, pa.int64())], ["item_id", "doc_id", "score"])

    return docs.mapInArrow(tidy(run), f"item_id {item_type.simpleString()}, doc_id {id_type.simpleString()}, score bigint")


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = K, buckets: int = BUCKETS, block_terms: int = BLOCK_TERMS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """Per query and rank: item_id, rank (from 1), doc_id, score.

    Scores are integers as the weights and impacts are; documents of score nought are no result,
    equal scores go by ascending id. Null texts, and texts without a term, are no documents and no
    queries. Documents without an id count in the statistics and are no result; documents that
    share an id, and repeated rows, are each a result of their own. Items without an id are left
    out; items that share one are one query with the terms of all. Empty tables give no rows;
    other columns are not read. Terms are told apart by 64-bit hashes.
    """
    item_type, id_type = items.schema[item_id].dataType, docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("id"), F.col(doc_text).alias("text")).where("text is not null")
    asked = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(1, -(-size["n"] // block_queries), -(-(size["chars"] or 0) // (2 * block_terms)))
    found = []
    for b in range(blocks):
        queries = _block(asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b))
        if not len(queries.term):
            continue
        n, total, frequency = _counts(rows.select("text"), queries)
        if not total:
            break
        queries.weigh(n, frequency)
        best = _search(rows.where("id is not null"), queries, n, total, k, buckets, item_type)
        found.append(stored(best, "best") if blocks > 1 else best)
    if not found:
        return docs.sparkSession.createDataFrame([], f"item_id {item_type.simpleString()}, rank int, doc_id {id_type.simpleString()}, score bigint")
    best = reduce(DataFrame.unionByName, found).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS)))
    order = [F.desc("score"), F.col("doc_id")]
    near = best.withColumn("place", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))).where(F.col("place") <= k)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
