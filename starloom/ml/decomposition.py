"""Singular value decomposition of a matrix whose rows are a DataFrame.

The left vectors stay a DataFrame, the right ones are a small array. A narrow matrix is
decomposed through its Gram matrix, summed inside tasks and then per entry. A wide one is not:
blocked power iteration multiplies the rows by a few vectors and back per round, so what leaves
the tasks is as large as those vectors, and rounds go on until the values stand still.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: columns up to which the Gram matrix is summed
NARROW = 1_024
#: rows multiplied at a time
SLAB = 4_096
#: further vectors of the power iteration, which make the wanted ones settle sooner
SPARE = 8
TOLERANCE, MOST_ROUNDS = 1e-11, 1_000


@dataclass(frozen=True)
class Decomposition:
    """``left`` (id, u array), ``values`` falling, ``right`` one column per value."""

    left: DataFrame
    values: np.ndarray
    right: np.ndarray

    def restored(self) -> DataFrame:
        """(id, row array): U times the values times the right vectors."""
        back = (self.right * self.values).T

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    yield _rows(batch.column("id"), _matrix(batch.column("u")) @ back, "row")

        return self.left.mapInArrow(run, f"id {self.left.schema['id'].dataType.simpleString()}, row array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _rows(ids: pa.Array, rows: np.ndarray, name: str) -> pa.RecordBatch:
    offsets = np.arange(0, rows.size + 1, max(rows.shape[1], 1), dtype=np.int32)
    return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))], ["id", name])


def _slabs(batches) -> Iterator[np.ndarray]:
    for batch in batches:
        for lo in range(0, batch.num_rows, SLAB):
            yield _matrix(batch.column("row").slice(lo, SLAB))


def _summed(rows: DataFrame, product, shape: tuple[int, int]) -> np.ndarray:
    """Sum over all rows of ``product`` of their slabs: one row of sums per column and task."""

    def run(batches):
        total = np.zeros(shape)
        for slab in _slabs(batches):
            total += product(slab)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(shape[0], dtype=np.int32), shape[1])),
             pa.array(np.tile(np.arange(shape[1], dtype=np.int32), shape[0])), pa.array(total.ravel())], ["i", "j", "s"])

    parts = rows.select("row").mapInArrow(run, "i int, j int, s double")
    table = parts.groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros(shape)
    out[table["i"].to_numpy(), table["j"].to_numpy()] = table["s"].to_numpy()
    return out


def svd(df: DataFrame, id_col: str, vector_col: str, k: int | None = None, narrow: int = NARROW) -> Decomposition:
    """The ``k`` largest singular values (all, if not given, of a narrow matrix) and their vectors.

    Rows whose vector is null are left out; all vectors must have one length. Values that are
    nought but for rounding are left out. The largest entry of each right vector is positive.
    """
    rows = df.where(F.col(vector_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("row"))
    lengths = rows.agg(F.min(F.size("row")).alias("a"), F.max(F.size("row")).alias("b")).first()
    if lengths["a"] != lengths["b"]:
        raise ValueError(f"rows of {lengths['a']} to {lengths['b']} columns")
    d = lengths["a"] or 0
    k = min(k or d, d)
    if d <= narrow:
        squares, right = np.linalg.eigh(_summed(rows, lambda x: x.T @ x, (d, d)))
        order = np.argsort(-squares, kind="stable")[:k]
        squares, right = squares[order], right[:, order]
    else:
        squares, right = _power(rows, d, k)
    keep = squares > (squares[0] if len(squares) else 0) * d * np.finfo(float).eps
    squares, right = squares[keep], right[:, keep]
    if right.size:
        right = right * np.sign(right[np.abs(right).argmax(0), np.arange(right.shape[1])])
    values = np.sqrt(squares)
    onto = right / values

    def left(batches):
        for batch in batches:
            if batch.num_rows:
                yield _rows(batch.column("id"), _matrix(batch.column("row")) @ onto, "u")

    return Decomposition(rows.mapInArrow(left, f"id {rows.schema['id'].dataType.simpleString()}, u array<double>"), values, right)


def _power(rows: DataFrame, d: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues of the Gram matrix, which is never made, and their vectors."""
    block = np.linalg.qr(np.random.default_rng(7).normal(size=(d, min(k + SPARE, d))))[0]
    before = None
    for _ in range(MOST_ROUNDS):
        image = _summed(rows, lambda x, v=block: x.T @ (x @ v), block.shape)
        small, turn = np.linalg.eigh(block.T @ image)
        squares, block_now = small[::-1], (block @ turn)[:, ::-1]
        # residual of each wanted pair, from the same product
        rest = np.linalg.norm((image @ turn)[:, ::-1] - block_now * squares, axis=0)[:k]
        if before is not None and (rest <= TOLERANCE**0.5 * squares[0]).all() and np.allclose(squares[:k], before, rtol=TOLERANCE):
            return squares[:k], block_now[:, :k]
        before, block = squares[:k], np.linalg.qr(image)[0]
    raise RuntimeError(f"the values still move after {MOST_ROUNDS} rounds")
