"""Whitening of embeddings; covariances by polarisation.

Vectors become integers. Two aggregates over all rows give what the components need: the sums of
every dimension, then the exact squares of the centred values ``n*x - S`` of every dimension and
of the sum of every two dimensions. A difference of these variances is twice a covariance,

    2 cov(a, b) = var(a + b) - var(a) - var(b),

so the matrix is put together from integers, without any rounding before its last division, and
``eigh`` of it gives the components. Partial sums leave a task as one row per dimension pair; what
reaches the driver is as large as the matrix, whatever the number of vectors.

Vectors of another length are another space: each length has its own fit list and components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.llm.arrow import tidy, unused

#: x = floor(SCALE * c) + SHIFT
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: rows whose squares are added at a time
SLAB = 1024
#: a sum of squares leaves a task in two parts, high and low
LOW_BITS = 60
#: an entry counts as finite if its integer stays below this, so that it is a long
MOST = 2.0**62


@dataclass(frozen=True)
class Whitener:
    """Components of the vectors of one length: the columns of ``vectors``, by falling value."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exact."""
        return _centred(x, self.n, self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        """x - S/n on every component, over the root of its value."""
        return (self.centred(x).astype(float) / self.n) @ self.vectors / np.sqrt(self.values)


# --- inside tasks --------------------------------------------------------------------------

def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length the row numbers and integer vectors of the rows that take part."""
    column = batch.column("vector")
    lens = np.diff(column.offsets.to_numpy())
    flat = column.values.slice(column.offsets[0].as_py(), int(lens.sum()))
    lens[~column.is_valid().to_numpy(zero_copy_only=False)] = 0
    starts = column.offsets.to_numpy()[:-1] - column.offsets[0].as_py()
    entry = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry becomes nan
    for length in np.unique(lens[lens > 0]).tolist():
        rows = np.flatnonzero(lens == length)
        part = entry[starts[rows][:, None] + np.arange(length)]
        with np.errstate(over="ignore", invalid="ignore"):
            whole = np.floor(SCALE * part)
        fit = (np.isfinite(part) & (np.abs(whole) < MOST)).all(1)
        if fit.any():
            yield rows[fit], whole[fit].astype(np.int64) + SHIFT


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n*x - S in longs if they are large enough, else in Python's integers."""
    most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    if n * most < 1 << 61 and max(abs(int(s)) for s in sums) < 1 << 61:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums.astype(object)


def _squares(t: np.ndarray) -> np.ndarray:
    """Exact sums of squares of the columns, as Python integers; at most SLAB rows."""
    if t.dtype == object:
        return (t * t).sum(0)
    most = max(abs(int(t.max())), abs(int(t.min())))
    if most * most * len(t) < 1 << 63:
        return np.einsum("ij,ij->j", t, t).astype(object)
    if most >= 1 << 48:
        return _squares(t.astype(object))
    high, low = t >> 24, t & 0xFFFFFF  # each product below 2^48, sums of SLAB rows below 2^58
    parts = [np.einsum("ij,ij->j", a, b).astype(object) for a, b in ((high, high), (high, low), (low, low))]
    return parts[0] * (1 << 48) + parts[1] * (1 << 25) + parts[2]


def _sum_rows(batches):
    total: dict[int, list] = {}
    for batch in batches:
        for _, x in _vectors(batch):
            held = total.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
            held[0] += len(x)
            held[1] = held[1] + (x >> 31).sum(0).astype(object) * (1 << 31) + (x & 0x7FFFFFFF).sum(0).astype(object)
    for length, (n, sums) in total.items():
        at = np.arange(length + 1)  # the place after the last dimension holds the count
        yield _parts(["length", "i"], [np.full(length + 1, length), at], np.append(sums, n))


def _parts(names: list[str], keys: list[np.ndarray], sums: np.ndarray) -> pa.RecordBatch:
    """Keys and exact sums, split in a high and a low part."""
    wide = pa.decimal128(38, 0)
    high = pa.array([int(s) >> LOW_BITS for s in sums], pa.int64()).cast(wide)
    low = pa.array([int(s) & ((1 << LOW_BITS) - 1) for s in sums], pa.int64()).cast(wide)
    return pa.RecordBatch.from_arrays([*(pa.array(k.astype(np.int32)) for k in keys), high, low], [*names, "high", "low"])


def _pair_rows(fits: dict[int, tuple[int, np.ndarray]]):
    def run(batches):
        total: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for _, x in _vectors(batch):
                d = x.shape[1]
                n, sums = fits[d]
                held = total.setdefault(d, [np.zeros(d - i, object) for i in range(d)])
                for lo in range(0, len(x), SLAB):
                    y = _centred(x[lo : lo + SLAB], n, sums)
                    for i in range(d):  # its own square, then that of its sum with each later one
                        t = y[:, i:] + y[:, i : i + 1]
                        t[:, 0] = y[:, i]
                        held[i] = held[i] + _squares(t)
        for d, held in total.items():
            for i, squares in enumerate(held):
                yield _parts(["length", "i", "j"], [np.full(d - i, d), np.full(d - i, i), np.arange(i, d)], squares)

    return run


def _covariance_rows(model: dict[int, Whitener]):
    def run(batches):
        total = {}
        for batch in batches:
            for _, x in _vectors(batch):
                if fit := model.get(x.shape[1]):
                    w = fit.project(x)  # x - S/n has mean nought
                    total[x.shape[1]] = total.get(x.shape[1], 0) + w.T @ w
        for length, c in total.items():
            i, j = np.triu_indices(len(c))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k.astype(np.int32)) for k in (np.full(len(i), length), i, j)), pa.array(c[i, j])], ["length", "i", "j", "s"])

    return run


# --- over the table ------------------------------------------------------------------------

def _rows(df: DataFrame, vector_col: str) -> DataFrame:
    return df.select(F.col(vector_col).cast("array<double>").alias("vector"))


def _collected(parts: DataFrame, keys: list[str]) -> dict[tuple, int]:
    """Exact sums by key; as many as the matrices have entries."""
    table = parts.groupBy(*keys).agg(F.sum("high").alias("high"), F.sum("low").alias("low")).toArrow()
    sums = ((int(h) << LOW_BITS) + int(l) for h, l in zip(table["high"].to_pylist(), table["low"].to_pylist()))
    return dict(zip(zip(*(table[k].to_pylist() for k in keys)), sums))


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitener]:
    """Per vector length its components, as many as ``components`` and as have a variance."""
    rows = _rows(df, vector_col)
    sums = _collected(rows.mapInArrow(tidy(_sum_rows), "length int, i int, high decimal(38,0), low decimal(38,0)"), ["length", "i"])
    lengths = sorted({length for length, _ in sums})
    fits = {d: (sums[d, d], np.array([sums[d, i] for i in range(d)], object)) for d in lengths}
    squares = _collected(
        rows.mapInArrow(tidy(_pair_rows(fits)), "length int, i int, j int, high decimal(38,0), low decimal(38,0)"), ["length", "i", "j"]) if fits else {}
    return {d: w for d, (n, s) in fits.items() if (w := _components(d, n, s, squares, components)) is not None}


def _components(d: int, n: int, sums: np.ndarray, squares: dict, components: int) -> Whitener | None:
    cov = np.empty((d, d))
    whole = n**3  # the squares are of n*x - S, and their mean is over n
    for i in range(d):
        own = squares[d, i, i]
        cov[i, i] = own / whole
        for j in range(i + 1, d):
            cov[i, j] = cov[j, i] = (squares[d, i, j] - own - squares[d, j, j]) / (2 * whole)
    trace = float(sum(squares[d, i, i] for i in range(d)) / whole)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > trace * d * np.finfo(float).eps]  # others have no variance but rounding
    if not len(order):
        return None
    return Whitener(n, sums, values[order], vectors[:, order], trace)


def identity_errors(df: DataFrame, model: dict[int, Whitener], vector_col: str = "embedding") -> dict[int, float]:
    """Per length the largest entry of the whitened rows' covariance minus the identity."""
    parts = _rows(df, vector_col).mapInArrow(tidy(_covariance_rows(model)), "length int, i int, j int, s double")
    table = parts.groupBy("length", "i", "j").agg(F.sum("s").alias("s")).toArrow().to_pylist()
    worst = dict.fromkeys(model, 0.0)
    for r in table:
        worst[r["length"]] = max(worst[r["length"]], abs(r["s"] / model[r["length"]].n - (r["i"] == r["j"])))
    return worst


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           model: dict[int, Whitener] | None = None) -> DataFrame:
    """Per row and component: the id, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` (decimal) is the exact sum of squares of n*x - S of the row, ``whitened`` its
    centred vector on the component over the root of the component's value, ``explained`` the
    value over the trace, ``identity_error`` one value for all rows of a length.

    Rows whose vector is null, empty or holds a null, a non-finite entry or one whose integer is
    no long take no part. A null id stays a row; repeated rows and ids count as often as they
    stand. Vectors of different lengths are fitted apart. Components without variance (a constant
    dimension, fewer rows than dimensions, one row) are not returned. An empty table gives no
    rows; other columns are not read. ``model`` whitens rows with components fitted on others;
    rows of a length it does not have are left out.
    """
    model = fit(df, vector_col, components) if model is None else model
    errors = identity_errors(df, model, vector_col)
    name = unused(df, "vector")
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias(name)).withColumnRenamed(name, "vector")
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at, x in _vectors(batch):
                if fit_ := model.get(x.shape[1]):
                    yield from _whitened(batch.column("id"), at, x, fit_, errors[x.shape[1]])

    out = rows.mapInArrow(tidy(run), f"id {id_type}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)


def _whitened(ids: pa.Array, at: np.ndarray, x: np.ndarray, fit_: Whitener, error: float) -> Iterator[pa.RecordBatch]:
    k, wide = len(fit_.values), pa.decimal128(38, 0)
    names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for lo in range(0, len(x), SLAB):
        part, rows = x[lo : lo + SLAB], at[lo : lo + SLAB]
        deviation = _squares(fit_.centred(part).T)  # columns are the rows here
        total = pa.array([int(v) for v in deviation], wide) if max(deviation) >= 1 << 63 else pa.array(deviation.astype(np.int64)).cast(wide)
        each, m = np.repeat(np.arange(len(rows)), k), len(rows) * k
        yield pa.RecordBatch.from_arrays([
            ids.take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
            pa.array(np.full(m, fit_.n)), total.take(pa.array(each)), pa.array(fit_.project(part).ravel()),
            pa.array(np.tile(fit_.values / fit_.trace, len(rows))), pa.array(np.full(m, error))], names)
