"""MinHash signatures by one permutation, their bands, and parities of whole sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from starloom.llm.hashing import U, mix, seeded


#: a bin that no shingle fell into
EMPTY = np.iinfo(np.uint32).max


def signatures(hashed: np.ndarray, owner: np.ndarray, n: int, bins: int) -> np.ndarray:
    """(n, bins): the least hash of each owner in each bin; the bin is decided by the upper half
    of a hash, the value is its lower half."""
    out = np.full(n * bins, EMPTY, np.uint32)
    cell = owner * bins + (((hashed >> U(32)) * U(bins)) >> U(32)).view(np.int64)
    np.minimum.at(out, cell, hashed.astype(np.uint32))
    return filled(out.reshape(n, bins))


def filled(signature: np.ndarray) -> np.ndarray:
    """Signatures whose empty bins take the value of the next one that is not, marked by the
    distance; those of owners without any shingle stay empty."""
    out = signature.astype(U)
    empty = signature == EMPTY
    gaps, columns = np.nonzero(empty & ~empty.all(1)[:, None])
    distance, bins = 0, signature.shape[1]
    while len(gaps):
        distance += 1
        ahead = (columns + distance) % bins
        good = ~empty[gaps, ahead]
        out[gaps[good], columns[good]] = signature[gaps[good], ahead[good]] + (U(distance) << U(32))
        gaps, columns = gaps[~good], columns[~good]
    return out


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """(n, bands): one 64-bit key per band of ``rows`` values, different in every band."""
    n, bins = signature.shape
    count = bins // rows
    factors = seeded(bins, 17) | U(1)
    with np.errstate(over="ignore"):
        mixed = mix(signature[:, : count * rows] * factors[None, : count * rows])
        return mix(mixed.reshape(n, count, rows).sum(2) + seeded(count, 19)[None, :]).view(np.int64)


#: parities of a set, in words of 64 bits
PARITIES = [f"w{i}" for i in range(16)]


def parities(hashed: np.ndarray, owner: np.ndarray, n: int) -> list[pa.Array]:
    """For each of ``n`` sets one bit per part of the hash space, whether an odd number of its
    distinct hashes lies there, as columns of 64 bits. What two sets have in common cancels out,
    so they differ in at most as many bits as hashes."""
    bits = 64 * len(PARITIES)
    odd = np.bincount(owner * bits + (mix(hashed.copy()) % U(bits)).view(np.int64), minlength=n * bits) & 1
    words = np.packbits(odd.astype(np.uint8).reshape(n, bits), axis=1).view(np.int64)
    return [pa.array(w) for w in np.ascontiguousarray(words.T)]
