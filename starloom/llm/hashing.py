"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays.

Equality of hashes stands for equality of words and shingles; the hashes depend on nothing but
the bytes, so every task on every machine gives the same ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the word."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def seeded(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed * 0x632BE59BD9B4E019 % (1 << 64)))


@lru_cache(maxsize=1)
def _bytes_table() -> np.ndarray:
    table = seeded(256, 1)
    table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]  # letter case does not count
    return table


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ODD = U(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    powers = np.full(1 << 16, _ODD, U)
    powers[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(powers)


def _power(at: np.ndarray) -> np.ndarray:
    """Odd factors by place in the word; beyond the table they repeat with another factor."""
    table = _powers()
    if not len(at) or at.max() < len(table):
        return table[at]
    with np.errstate(over="ignore"):
        return table[at & 0xFFFF] * (mix((at >> 16).astype(U)) | U(1))


@dataclass
class Words:
    """Words of a batch of texts: hash, row, first byte and end byte in the row's UTF-8."""

    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # per row the number of its first word; one entry more than rows

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def raw_texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()).to_pylist()]


def words(texts: list[bytes]) -> Words:
    """What lies between ASCII white space, A-Z as a-z."""
    buffer = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    offsets = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1))) + 1
    space = _SPACE[buffer]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, U), none, none, none, np.zeros(len(texts) + 1, np.int64))
    lens = end - start
    inside = np.flatnonzero(~space)
    place = np.arange(len(inside)) - np.repeat(np.cumsum(lens) - lens, lens)
    with np.errstate(over="ignore"):
        parts = _bytes_table()[buffer[inside]] * _power(place)
        hashed = mix(np.add.reduceat(parts, np.cumsum(lens) - lens) + lens.astype(U) * _ODD)
    row = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(row, np.arange(len(texts) + 1))
    return Words(hashed, row, start - offsets[row], end - offsets[row], first)


def shingles(w: Words, size: int, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, group and first word of every run of ``size`` words within a group (the row, if not
    given); a group with fewer words has all its words as one shingle. ``group`` ascends."""
    group = w.row if group is None else group
    n = len(w.hash)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, U), none, none
    factors, runs = seeded(size, 7) | U(1), max(n - size + 1, 0)
    with np.errstate(over="ignore"):
        total = np.zeros(runs, U)
        for k in range(size if runs else 0):
            total += w.hash[k : runs + k] * factors[k]
        at = np.flatnonzero(group[:runs] == group[n - runs :])
        hashed, owner = mix(total[at]), group[at]
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sizes = np.diff(np.append(starts, n))
        short = starts[sizes < size]
        if len(short):
            counts = sizes[sizes < size]
            few = counts.astype(U) * U(0xA24BAED4963EE407)
            for k in range(size - 1):
                have = counts > k
                few[have] += w.hash[short[have] + k] * factors[k]
            hashed = np.concatenate((hashed, mix(few)))
            owner = np.concatenate((owner, group[short]))
            at = np.concatenate((at, short))
            order = np.argsort(at, kind="stable")
            hashed, owner, at = hashed[order], owner[order], at[order]
    return hashed, owner, at


def distinct(hashed: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes per owner, ascending within each."""
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    keep = np.ones(len(hashed), bool)
    keep[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    return hashed[keep], owner[keep]


def set_digests(hashed: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each owner's set of distinct hashes."""
    out = []
    with np.errstate(over="ignore"):
        for seed in (11, 13):
            total = np.zeros(n, U)
            if len(hashed):
                starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                total[owner[starts]] = np.add.reduceat(mix(hashed ^ seeded(1, seed)[0]), starts)
            out.append(total.view(np.int64))
    return out[0], out[1]
