"""Approximate nearest neighbours over balanced posting lists.

Centroids are fitted on a bounded sample with a penalty on large clusters, so that lists stay of
like length. Every vector goes to its nearest list; one near a boundary goes to further lists as
well, unless a list already chosen lies closer to the further centroid than the vector does. The
centroids are searched through a neighbour graph held in memory. A query is held against every
centroid and visits the lists whose centroid is at most ``RATIO`` times as far as its nearest, at
least ``LEAST_LISTS`` and at most ``MOST_LISTS`` or one in ``OPENED`` of all lists, whichever is
more, so that what it sees grows with the lists; in them every vector is compared exactly.

Equal vectors are one entry that keeps its k + 1 smallest ids: no more can be in any answer. A
list that is long for one task is split, and its queries go to every part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.arrow import stored, tidy

#: vectors the centroids are fitted on, vectors a list should have, centroids at most, rounds
SAMPLE, LIST_SIZE, MOST_CENTROIDS, ROUNDS = 20_000, 100, 4_096, 10
#: lists a vector may be in, and how much further than its nearest (squared distance)
REPLICAS, BOUNDARY = 6, 1.6
#: lists a query visits, and how much further than its nearest (squared distance); beyond
#: OPENED * MOST_LISTS lists it visits up to one in OPENED
LEAST_LISTS, MOST_LISTS, RATIO, OPENED = 8, 64, 2.5, 8
#: neighbours of a centroid in the graph, candidates kept while searching
DEGREE, WIDTH = 24, 80
#: entries and queries of one block of comparisons
BLOCK, QUERY_BLOCK = 4_000, 2_000
K = 5


# --- the index -----------------------------------------------------------------------------

def fit(sample: np.ndarray, lists: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Unit centroids; a cluster's size is added to its distance so that none grows large."""
    rng = np.random.default_rng(seed)
    lists = min(lists, len(sample))
    centres = sample[np.sort(rng.choice(len(sample), lists, replace=False))]
    size = np.zeros(lists)
    fair = len(sample) / lists
    for _ in range(rounds):
        near = np.empty(len(sample), np.int64)
        spread = 0.05 * np.maximum(size / fair - 1, 0)
        for lo in range(0, len(sample), 4096):
            near[lo : lo + 4096] = (spread - 2 * sample[lo : lo + 4096] @ centres.T).argmin(1)
        size = np.bincount(near, minlength=lists).astype(float)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        empty = size == 0
        if empty.any():  # start anew from members of the largest cluster
            large = np.flatnonzero(near == size.argmax())
            sums[empty] = sample[rng.choice(large, int(empty.sum()))]
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-300)
    return centres


class CentroidGraph:
    """Neighbour graph of the centroids with a best-first search for whole batches."""

    def __init__(self, centres: np.ndarray, degree: int = DEGREE):
        self.centres = centres
        n = len(centres)
        self.degree = min(degree, n - 1)
        close = centres @ centres.T
        np.fill_diagonal(close, -np.inf)
        half = max(self.degree // 2, 1)
        order = np.argsort(-close, axis=1, kind="stable")[:, : self.degree] if n > 1 else np.zeros((n, 0), np.int64)
        if n > 2 * self.degree:  # some far links keep the graph in one piece
            rng = np.random.default_rng(3)
            order[:, half + half // 2 :] = rng.integers(0, n, order[:, half + half // 2 :].shape)
        self.links = order
        # entry points: a bounded number, spread over the centroids
        self.entries = np.linspace(0, n - 1, min(n, 64)).astype(np.int64)

    def search(self, x: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and squared distances of about the ``want`` nearest centroids, nearest first."""
        n, width = len(self.centres), min(max(WIDTH, want), len(self.centres))
        found = np.broadcast_to(self.entries, (len(x), len(self.entries))).copy()
        score = x @ self.centres[self.entries].T
        done = np.zeros((len(x), n), bool)
        rows = np.arange(len(x))[:, None]
        seen = np.zeros((len(x), n), bool)
        seen[:, self.entries] = True
        while True:
            keep = np.argsort(-score, axis=1, kind="stable")[:, :width]
            found, score = np.take_along_axis(found, keep, 1), np.take_along_axis(score, keep, 1)
            fresh = ~done[rows, found] & np.isfinite(score)
            if not fresh.any():
                break
            # the best eight not yet expanded
            place = np.argsort(~fresh, axis=1, kind="stable")[:, :8]
            usable = np.take_along_axis(fresh, place, 1)
            node = np.take_along_axis(found, place, 1)
            done[rows, node] |= usable
            ahead = self.links[node].reshape(len(x), -1)
            new = ~seen[rows, ahead] & np.repeat(usable, self.links.shape[1], axis=1)
            # a centroid reached twice in one step counts once
            order = np.argsort(ahead, axis=1, kind="stable")
            ordered = np.take_along_axis(ahead, order, 1)
            first = np.ones_like(new)
            first_sorted = np.ones_like(new)
            first_sorted[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
            np.put_along_axis(first, order, first_sorted, 1)
            got = np.einsum("ij,ikj->ik", x, self.centres[ahead]) if ahead.size else np.zeros(ahead.shape)
            seen[rows, ahead] |= new
            got = np.where(new & first, got, -np.inf)
            found, score = np.concatenate((found, ahead), 1), np.concatenate((score, got), 1)
        return found[:, :want], np.maximum(2 - 2 * score[:, :want], 0)

    def lists_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the posting lists a vector is kept in."""
        near, far = self.search(x, min(4 * REPLICAS, len(self.centres)))
        chosen = np.zeros(near.shape, bool)
        chosen[:, 0] = True
        for j in range(1, near.shape[1]):
            close = far[:, j] <= BOUNDARY * far[:, 0] + 1e-12
            between = np.zeros(len(x), bool)
            for i in range(j):  # a chosen list closer to this centroid than the vector is
                gap = 2 - 2 * np.einsum("ij,ij->i", self.centres[near[:, i]], self.centres[near[:, j]])
                between |= chosen[:, i] & (gap < far[:, j])
            chosen[:, j] = close & ~between & (chosen.sum(1) < REPLICAS)
        rows, columns = np.nonzero(chosen)
        return rows, near[rows, columns]

    def visited(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the posting lists a query visits."""
        n = len(self.centres)
        want = min(max(MOST_LISTS, -(-n // OPENED)), n)
        score = x @ self.centres.T
        near = np.argpartition(-score, want - 1, axis=1)[:, :want]
        near = np.take_along_axis(near, np.argsort(-np.take_along_axis(score, near, 1), axis=1, kind="stable"), 1)
        far = np.maximum(2 - 2 * np.take_along_axis(score, near, 1), 0)
        chosen = far <= RATIO * far[:, :1] + 1e-12
        chosen[:, :LEAST_LISTS] = True
        rows, columns = np.nonzero(chosen)
        return rows, near[rows, columns]


# --- vectors -----------------------------------------------------------------------------------

def _usable(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows with a vector that takes part, and their vectors as doubles."""
    rows, out = [], []
    for i, v in enumerate(column):
        if not v.is_valid or v.values.null_count:
            continue
        x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
        if len(x) and np.isfinite(x).all() and x.any():
            rows.append(i)
            out.append(x)
    return np.array(rows, np.int64), out


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosine(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row-wise cosine in doubles; the same for the same two vectors wherever they stand."""
    q = q / np.abs(q).max(-1, keepdims=True)
    v = v / np.abs(v).max(-1, keepdims=True)
    return (q * v).sum(-1) / (np.sqrt((q * q).sum(-1)) * np.sqrt((v * v).sum(-1)))


def entries(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: raw (doubles), ids (the k + 1 smallest), queries (ids that are queries).
    ``rows`` has id, vector and is_query."""

    def run(batches):
        for batch in batches:
            at, vectors = _usable(batch.column("vector"))
            ids, query = batch.column("id").to_pylist(), batch.column("is_query").to_pylist()
            held: dict[bytes, list[int]] = {}
            for i, x in zip(at.tolist(), vectors):
                if ids[i] is not None:
                    held.setdefault(x.tobytes(), []).append(i)
            kept = [sorted({ids[i] for i in g})[: k + 1] for g in held.values()]
            asked = [sorted({ids[i] for i in g if query[i]}) for g in held.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(kept, pa.list_(pa.int64())), pa.array(asked, pa.list_(pa.int64()))], ["raw", "ids", "queries"])

    partial = rows.mapInArrow(tidy(run), "raw binary, ids array<bigint>, queries array<bigint>")
    ids = partial.select("raw", F.explode("ids").alias("id")).distinct().groupBy("raw").agg(
        F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids"))
    return ids, partial.select("raw", F.explode("queries").alias("query")).distinct()


def _parts(counts: DataFrame, block: int) -> dict[int, int]:
    """Parts of each list; at most MOST_CENTROIDS rows."""
    return {r["list"]: -(-r["count"] // block) for r in counts.groupBy("list").count().collect()}


def search(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", is_query=None, k: int = K) -> DataFrame:
    """Per query and rank: query_id, rank (from 1), vec_id, score (cosine), nearest first, ties to
    the smaller id.

    ``is_query`` is a condition on ``df``; None takes ids divisible by 50. A query's own row is no
    candidate. Null, empty and zero vectors, vectors with null or non-finite components, vectors
    of another length than most of the sample and rows without an id take no part, neither as
    candidates nor as queries. Repeated rows of an id count once. An empty table gives no rows.
    """
    is_query = F.col(id_col) % 50 == 0 if is_query is None else is_query
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    held, asked = entries(rows, k)
    held = stored(held, "entries")
    asked = stored(asked, "queries")
    total = held.count()
    digest = F.xxhash64("raw")
    last = held.select(digest.alias("d")).orderBy("d").limit(SAMPLE).agg(F.max("d")).first()[0]
    answer = "query_id bigint, rank int, vec_id bigint, score double"
    if last is None:
        return df.sparkSession.createDataFrame([], answer)
    # by digest a bounded sample, the same at every run
    raws = sorted(bytes(r["raw"]) for r in held.where(digest <= last).select("raw").limit(SAMPLE).collect())
    sizes, counts = np.unique([len(r) for r in raws], return_counts=True)
    length = int(sizes[counts.argmax()])
    held = held.where(F.length("raw") == length)
    sample = _unit([r for r in raws if len(r) == length])
    lists = int(np.clip(-(-total // LIST_SIZE), 1, MOST_CENTROIDS))
    graph = df.sparkSession.sparkContext.broadcast(CentroidGraph(fit(sample, lists)))  # MOST_CENTROIDS vectors and links

    def placed(pick: str):
        def run(batches):
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    part = batch.slice(lo, 512)
                    found, which = getattr(graph.value, pick)(_unit(part.column("raw").to_pylist()))
                    taken = part.take(pa.array(found))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(which.astype(np.int32))], [*part.schema.names, "list"])

        return run

    postings = stored(held.mapInArrow(tidy(placed("lists_of")), "raw binary, ids array<bigint>, list int"), "postings")
    visits = stored(asked.select("raw").distinct().where(F.length("raw") == length).mapInArrow(tidy(placed("visited")), "raw binary, list int"), "visits")
    list_parts, visit_parts = _parts(postings, BLOCK), _parts(visits, QUERY_BLOCK)
    spark = df.sparkSession
    table = spark.createDataFrame([(i, n, visit_parts.get(i, 0)) for i, n in list_parts.items()], "list int, parts int, visit_parts int").where("visit_parts > 0")
    table = F.broadcast(table)
    # every block of a list meets every block of its queries once
    left = postings.join(table, "list").withColumn("part", F.pmod(F.xxhash64("raw"), F.col("parts")).cast("int"))
    left = left.withColumn("visit_part", F.explode(F.sequence(F.lit(0), F.col("visit_parts") - 1)))
    right = visits.join(table, "list").withColumn("visit_part", F.pmod(F.xxhash64("raw"), F.col("visit_parts")).cast("int"))
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keys = ["list", "part", "visit_part"]

    def compare(entries_: pa.Table, queries_: pa.Table) -> pa.Table:
        made = {"query": [], "score": [], "ids": []}
        if entries_.num_rows and queries_.num_rows:
            raw, asked_ = entries_.column("raw").to_pylist(), queries_.column("raw").to_pylist()
            v = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
            q = np.frombuffer(b"".join(asked_), np.float64).reshape(len(asked_), -1)
            rough = _unit(asked_) @ _unit(raw).T
            want = min(k + 4, len(raw))  # a few more than needed: the product rounds otherwise
            best = np.argpartition(-rough, want - 1, axis=1)[:, :want]
            # equal up to rounding at the edge: take all of them
            edge = np.take_along_axis(rough, best, 1).min(1) - 1e-12
            query, entry = np.nonzero(rough >= edge[:, None])
            score = cosine(q[query], v[entry])
            smallest = np.array([x[0] for x in entries_.column("ids").to_pylist()])
            order = np.lexsort((smallest[entry], -score, query))
            place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
            order = order[place <= k]
            made = {"query": [asked_[i] for i in query[order]], "score": score[order], "ids": entries_.column("ids").take(pa.array(entry[order]))}
        return pa.table([pa.array(made["query"], pa.binary()), pa.array(made["score"], pa.float64()),
                         made["ids"].combine_chunks() if isinstance(made["ids"], pa.ChunkedArray) else pa.array(made["ids"], pa.list_(pa.int64()))], names=["raw", "score", "ids"])

    near = left.select(*keys, "raw", "ids").groupBy(*keys).cogroup(right.select(*keys, "raw").groupBy(*keys)).applyInArrow(
        compare, "raw binary, score double, ids array<bigint>")
    # an entry met in several lists counts once; k + 1 entries hold every answer
    one = near.groupBy("raw", F.element_at("ids", 1).alias("first")).agg(F.first("score").alias("score"), F.first("ids").alias("ids"))
    best = one.groupBy("raw").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "first", "ids"))), 1, k + 1).alias("best"))
    found = asked.join(best, "raw").select(F.col("query").alias("query_id"), F.explode("best").alias("b"))
    found = found.select("query_id", F.col("b.far").alias("far"), F.explode("b.ids").alias("vec_id")).where("vec_id <> query_id")
    ranked = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("far", "vec_id"))), 1, k).alias("best"))
    out = ranked.select("query_id", F.posexplode("best").alias("rank", "b"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.far")).alias("score"))
