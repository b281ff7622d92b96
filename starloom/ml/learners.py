"""Learners written as rounds of aggregates: k-means, logistic regression, least squares factors.

A round sums vectors or normal equations inside the tasks and per key afterwards; what reaches
the driver is as large as the model. Each round leaves its state in a folder, and a learner that
is started again on the same folder goes on with the last one.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.config import fresh_dir
from starloom.ml.decomposition import SLAB, _matrix, _summed
from starloom.operators.facts import stored
from starloom.operators.joins import lookup_join
from starloom.sources.sinks import _files
from starloom.streaming.runner import stored_batches

MOST_ROUNDS = 500


class Rounds:
    """States by the number of their round, as JSON below a folder."""

    def __init__(self, spark: SparkSession, folder: str | None):
        self.spark, self.folder = spark, folder or fresh_dir(spark, "rounds")
        self.number, self.state = 0, None
        done = [n for n in stored_batches(spark, self.folder) if self._complete(n)]
        if done:
            self.number = done[-1]
            self.state = json.loads(spark.read.text(self._path(self.number), wholetext=True).first()[0])

    def _path(self, number: int) -> str:
        return f"{self.folder}/batch={number}"

    def _complete(self, number: int) -> bool:
        folder, files = _files(self.spark, f"{self._path(number)}/_SUCCESS")
        return files.exists(folder)

    def put(self, state) -> None:
        self.number, self.state = self.number + 1, state
        text = self.spark.createDataFrame([(json.dumps(state),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(self._path(self.number))


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.where(F.col(vector_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("row"))


# --- k-means -----------------------------------------------------------------------------

def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre, the first of equally near ones."""
    return ((x[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)


def _near_batches(batch: pa.RecordBatch, centres: np.ndarray):
    size = max(1, 4_000_000 // max(centres.size, 1))
    for lo in range(0, batch.num_rows, size):
        part = batch.slice(lo, size)
        x = _matrix(part.column("row"))
        yield part, x, _nearest(x, centres)


def k_means(df: DataFrame, id_col: str, vector_col: str, k: int, folder: str | None = None) -> tuple[np.ndarray, DataFrame]:
    """Centres, and (id, cluster) of every row, once no row changes its cluster's mean any more.

    It starts from the ``k`` distinct vectors whose hashes are the smallest. A centre without
    rows stays where it is.
    """
    rows, rounds = _vectors(df, id_col, vector_col), Rounds(df.sparkSession, folder)
    if rounds.state is None:
        first = rows.select("row").distinct().orderBy(F.xxhash64("row"), "row").limit(k).collect()
        rounds.put([r["row"] for r in first])
    while rounds.number <= MOST_ROUNDS:
        centres = np.array(rounds.state)
        shape = (len(centres), centres.shape[1] + 1)

        def sums(x, centres=centres, shape=shape):
            total = np.zeros(shape)
            np.add.at(total, _nearest(x, centres), np.hstack((x, np.ones((len(x), 1)))))
            return total

        total = _summed(rows, sums, shape)
        n = total[:, -1:]
        moved = np.where(n > 0, total[:, :-1] / np.maximum(n, 1), centres)
        if np.allclose(moved, centres, rtol=0, atol=1e-12):
            break
        rounds.put(moved.tolist())
    centres = np.array(rounds.state)

    def run(batches):
        for batch in batches:
            for part, _, near in _near_batches(batch, centres):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(near.astype(np.int32))], ["id", "cluster"])

    return centres, rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, cluster int")


# --- logistic regression -----------------------------------------------------------------

def logistic(df: DataFrame, vector_col: str, label_col: str, ridge: float = 1e-3, folder: str | None = None) -> np.ndarray:
    """Weights, the intercept last, at which the gradient of the mean log loss plus half of
    ``ridge`` times the squared weights is nought. Newton rounds: gradient and curvature are one
    sum over the rows each."""
    known = df.where(F.col(vector_col).isNotNull() & F.col(label_col).isNotNull())
    rows = known.select(F.concat(F.col(vector_col).cast("array<double>"), F.array(F.col(label_col).cast("double"))).alias("row"))
    rounds, head = Rounds(df.sparkSession, folder), rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("row")).alias("d")).first()
    n, d = head["n"], head["d"]
    if not n:
        raise ValueError("no labelled rows")
    if rounds.state is None:
        rounds.put([0.0] * d)
    while rounds.number <= MOST_ROUNDS:
        weights = np.array(rounds.state)

        def sums(block, weights=weights):
            x = np.hstack((block[:, :-1], np.ones((len(block), 1))))
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -500, 500)))
            return np.vstack((x.T @ (p - block[:, -1]), (x * (p * (1 - p))[:, None]).T @ x))

        total = _summed(rows, sums, (d + 1, d)) / n
        penalty = ridge * np.append(np.ones(d - 1), 0)
        gradient, curvature = total[0] + penalty * weights, total[1:] + np.diag(penalty)
        if np.abs(gradient).max() < 1e-10:
            break
        rounds.put((weights - np.linalg.solve(curvature + 1e-12 * np.eye(d), gradient)).tolist())
    return np.array(rounds.state)


# --- factors -----------------------------------------------------------------------------

def _solved(ratings: DataFrame, fixed: DataFrame, of: str, by: str, rank: int, ridge: float) -> DataFrame:
    """(id, factor) of the ``of`` side that fit the ratings best while ``by``'s factors stand.

    The normal equations of an id are sums over its ratings, combined map-side, so an id with a
    third of all ratings is one row per task in the shuffle.
    """
    known = lookup_join(ratings, fixed.select(F.col("id").alias("_id"), F.col("factor").alias("_f")), by, "_id", spread_by=of, how="inner")
    f = [F.col("_f")[i] for i in range(rank)]
    products = [F.sum(f[i] * f[j]) for i in range(rank) for j in range(i, rank)]
    sums = known.groupBy(F.col(of).alias("id")).agg(
        F.array(*products).alias("a"), F.array(*[F.sum(f[i] * F.col("rating")) for i in range(rank)]).alias("b"), F.count(F.lit(1)).alias("n"))

    def run(batches):
        upper = np.triu_indices(rank)
        for pdf in batches:
            if not len(pdf):
                continue
            a = np.zeros((len(pdf), rank, rank))
            a[:, upper[0], upper[1]] = np.array(pdf["a"].tolist())
            a[:, upper[1], upper[0]] = np.array(pdf["a"].tolist())
            a += ridge * pdf["n"].to_numpy()[:, None, None] * np.eye(rank)
            solved = np.linalg.solve(a, np.array(pdf["b"].tolist())[:, :, None])[:, :, 0]
            yield pd.DataFrame({"id": pdf["id"], "factor": list(solved)})

    return sums.mapInPandas(run, f"id {ratings.schema[of].dataType.simpleString()}, factor array<double>")


def factors(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 5, ridge: float = 0.1, rounds: int = 10) -> tuple[DataFrame, DataFrame]:
    """(id, factor) of users and of items whose products fit the ratings, by alternating least
    squares; the ridge weighs by the number of ratings. Each half round is written. The users'
    factors are the exact solution for the items' ones. Rows with a null take no part."""
    known = stored(ratings.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).cast("double").alias("rating")).dropna(), "ratings")
    # fixed pseudo-random start: each entry from a hash of the item and its place
    start = [(F.pmod(F.xxhash64("item", F.lit(i)), F.lit(2_000_003)) / 2_000_003.0 + 0.01) / rank**0.5 for i in range(rank)]
    items = stored(known.select("item").distinct().select(F.col("item").alias("id"), F.array(*start).alias("factor")), "items")
    for n in range(rounds):
        users = stored(_solved(known, items, "user", "item", rank, ridge), "users")
        if n < rounds - 1:
            items = stored(_solved(known, users, "item", "user", rank, ridge), "items")
    return users, items


#: entries of a block of factors
ENTRIES = 1 << 20
#: rows of users that a block has at least, where there are more than tasks
BLOCK = 4_096
#: children of a node, and items of a leaf
FAN, LEAF = 32, 32
#: products that are held at a time, and nodes open at a time
HELD, OPEN = 1 << 20, 1 << 15
#: far above the rounding of a product in turned coordinates
SLACK = 1e-10


class _Boxes:
    """Items in leaves of near ones, under nodes of ``FAN`` children, each with the least and
    greatest entries below it. Boxes stand in the coordinates of ``_axes``; no product of an
    item with a vector exceeds that of its box by more than ``SLACK`` of their lengths."""

    def __init__(self, points: np.ndarray, leaf: int, vectors: np.ndarray | None = None):
        self.turn, back = _axes(points, points if vectors is None else vectors)
        turned = points @ back
        self.order = _near_order(turned, leaf)
        self.reach = np.sqrt((points ** 2).sum(1).max())
        low = high = points[self.order]
        self.levels = []  # from the items to the root: (low, high, which are there), by parent
        size = leaf
        while True:
            nodes = -(-len(low) // size)
            there = (np.arange(nodes * size) < len(low)).reshape(nodes, size)
            fill = lambda x: np.concatenate((x, np.repeat(x[-1:], nodes * size - len(x), 0))).reshape(nodes, size, -1)
            low, high = fill(low), fill(high)
            self.levels.append((low, high, there))
            if nodes == 1:
                break
            if size == leaf and len(self.levels) == 1:
                low = high = fill(turned[self.order])
            low, high, size = low.min(1), high.max(1), FAN
        self.levels.reverse()

    def _products(self, u: np.ndarray, at: int, node: np.ndarray) -> np.ndarray:
        """Of items, or the greatest possible below the children of a node."""
        low, high, there = self.levels[at]
        items, total = at == len(self.levels) - 1, 0.0
        own = u if items else u @ self.turn
        for d in range(u.shape[1]):
            mine = own[:, d, None]
            total = total + mine * (low[node, :, d] if items else np.where(mine >= 0, high[node, :, d], low[node, :, d]))
        if not items:
            total = total + SLACK * self.reach * np.sqrt((u ** 2).sum(1))[:, None]
        return np.where(there[node], total, -np.inf)

    def best(self, u: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of ``u``, item, product) of the ``n`` greatest of each row, falling, ties to the
        smaller item."""
        node = np.zeros(len(u), dtype=int)
        for at in range(len(self.levels) - 1):  # the leaf that promises most
            node = node * self.levels[at][0].shape[1] + self._products(u, at, node).argmax(1)
        least = _nth(self._products(u, len(self.levels) - 1, node), n)
        return self._below(u, least, 0, np.arange(len(u)), np.zeros(len(u), dtype=int), n)

    def _below(self, u, least, at, who, node, n):
        """The same, of what is below the nodes; ``who`` rises. Where ties or odd vectors open
        too many, rows go by parts."""
        for at in range(at, len(self.levels)):
            if len(who) > OPEN and who[0] != who[-1]:
                cut = np.searchsorted(who, (who[0] + who[-1] + 1) // 2)
                parts = [self._below(u, least, at, w, p, n) for w, p in ((who[:cut], node[:cut]), (who[cut:], node[cut:]))]
                return tuple(np.concatenate(x) for x in zip(*parts))
            width, found = self.levels[at][0].shape[1], []
            step = max(1, HELD // (width * u.shape[1]))
            for lo in range(0, len(who), step):
                w, p = who[lo:lo + step], node[lo:lo + step]
                value = self._products(u[w], at, p)
                row, child = np.nonzero(self.levels[at][2][p] & ~(value < least[w][:, None]))
                found.append((w[row], p[row] * width + child, value[row, child]))
            who, node, value = (np.concatenate(x) for x in zip(*found))
        item = self.order[node]
        order = np.lexsort((item, -value, who))
        order = order[np.arange(len(who)) - np.searchsorted(who, who[order]) < n]
        return who[order], item[order], value[order]


def _axes(points: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matrices that turn vectors and points, with the same products: the points are as wide in
    every direction as it counts for the vectors. Factors often lie near a plane, where boxes
    along the given axes would bound nothing."""
    points, vectors = (x[np.isfinite(x).all(1)] for x in (points, vectors))
    if not len(points) or not len(vectors):
        return np.eye(points.shape[1]), np.eye(points.shape[1])
    apart = points - points.mean(0)
    wide, axes = _widths(apart.T @ apart / len(points))
    turn, back = axes * wide, axes / wide
    vectors = vectors @ turn
    counts, axes = _widths(vectors.T @ vectors / len(vectors))
    return turn @ axes / counts, back @ axes * counts


def _widths(square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Square roots of the eigenvalues, none below a thousandth of the greatest, and vectors."""
    values, axes = np.linalg.eigh(square)
    return np.sqrt(np.maximum(values, max(values.max() * 1e-6, np.finfo(float).tiny))), axes


def _nth(score: np.ndarray, n: int) -> np.ndarray:
    """The ``n``-th greatest of each row; not a number counts as the smallest."""
    return -np.partition(-score, n - 1)[:, n - 1] if score.shape[1] >= n else np.full(len(score), -np.inf)


def _near_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Order in which runs of ``leaf`` points, and of ``FAN`` such runs, are near each other:
    halves by the widest entry, the left one a power of two of leaves."""
    order, open_ = np.arange(len(points)), [(0, len(points))]
    while open_:
        lo, hi = open_.pop()
        if hi - lo <= leaf:
            continue
        mine = points[order[lo:hi]]
        widest = (mine.max(0) - mine.min(0)).argmax()
        half = leaf << (-(-(hi - lo) // leaf) - 1).bit_length() - 1
        order[lo:hi] = order[lo:hi][np.argpartition(mine[:, widest], half)]
        open_ += [(lo, lo + half), (lo + half, hi)]
    return order


def top_items(users: DataFrame, items: DataFrame, n: int, block: int | None = None) -> DataFrame:
    """(user, rank, item, score): the ``n`` items of the greatest products per user, ties to the
    smaller item.

    Blocks of users meet blocks of items, each pair a task's work of bounded size that keeps
    ``n`` items a user; those are then ranked per user, first combined map-side. Within a pair
    only boxes of items are opened that may hold one of a user's best, so a user meets few
    items; no item is left out that could be among them.
    """
    (user_n, rank), (item_n, _) = (
        df.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("factor")), F.lit(1))).first() for df in (users, items))
    most = block or max(BLOCK, ENTRIES // max(rank, 1))
    tasks = min(-(-user_n // (block or BLOCK)), 2 * users.sparkSession.sparkContext.defaultParallelism)
    sizes = [max(1, -(-user_n // most), tasks), max(1, -(-item_n // most))]
    dealt = lambda df, own, other, own_n, other_n: df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(own_n)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))))
    left, right = dealt(users, "ub", "ib", *sizes), dealt(items, "ib", "ub", *sizes[::-1])
    user_type, item_type = (df.schema["id"].dataType.simpleString() for df in (users, items))

    def best(u: pd.DataFrame, i: pd.DataFrame) -> pd.DataFrame:
        if not len(u) or not len(i):
            return pd.DataFrame({"user": u["id"][:0], "item": i["id"][:0], "score": np.zeros(0)})
        i = i.sort_values("id", ignore_index=True)
        factor, who, out = np.stack(u["factor"].to_numpy()), u["id"].to_numpy(), []
        boxes = _Boxes(np.stack(i["factor"].to_numpy()), max(LEAF, 2 * n), factor)
        for lo in range(0, len(u), SLAB):
            row, item, score = boxes.best(factor[lo:lo + SLAB], n)
            out.append(pd.DataFrame({"user": who[lo + row], "item": i["id"].to_numpy()[item], "score": score}))
        return pd.concat(out)

    found = left.groupBy("ub", "ib").cogroup(right.groupBy("ub", "ib")).applyInPandas(best, f"user {user_type}, item {item_type}, score double")
    # at most n entries of each block of items
    entry = F.struct((-F.col("score")).alias("low"), F.col("item"))
    ranked = found.groupBy("user").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, n).alias("best"))
    return ranked.select("user", F.posexplode("best").alias("at", "b")).select(
        "user", (F.col("at") + 1).alias("rank"), F.col("b.item").alias("item"), (-F.col("b.low")).alias("score"))
