"""Fuzzy line dedup by MinHash.

Lines are compared by their sets of character shingles. Signatures are cut into bands; lines
that share a band are candidates, exact Jaccard decides, and a distributed union-find makes
components of similar lines. Of each component one line stays: that of the smallest document id,
and in it the first. A line is named by a 64-bit hash of its text, so equal lines are one item
from the start, however often they occur. Every line that is not blank takes part; one shorter
than a shingle is a single one, so such lines are similar only if equal but for case.

Bands: with 5 values each and 12 of them, lines of similarity 0.8 share one with probability
0.99, of 0.9 with 0.9999.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starloom.llm import near
from starloom.llm.arrow import discard, slices, stored, tidy, unused
from starloom.llm.hashing import U, mix
from starloom.llm.minhash import EMPTY, PARITIES, bands, filled, parities

#: characters of a shingle, similarity of similar lines, values of a band and number of bands
SHINGLE, SIMILARITY, ROWS, BANDS = 8, 0.8, 5, 12
#: only blank lines are left out
MIN_CHARS = 1
#: bytes of text worked on at a time, so that the arrays stay in the processor's cache
SLICE = 1 << 18


def line_ids(lines: list[str]) -> np.ndarray:
    """64-bit hash of each line, as it is but for white space at its ends."""
    return np.fromiter((xxhash.xxh3_64_intdigest(line.strip().encode("utf-8")) for line in lines), U, len(lines))


def _rolled(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of the SHINGLE characters from every place of the lower-cased lines on, each followed
    by a separator; first place and length of each line. Places where a line has fewer
    characters left hold no shingle."""
    low = [line.lower() for line in lines]
    points = np.frombuffer(("\n".join(low) + "\n" * SHINGLE).encode("utf-32-le"), np.uint32).astype(U)
    lens = np.fromiter(map(len, low), np.int64, len(low))
    with np.errstate(over="ignore"):
        two = points[:-1] * U(0x9E3779B97F4A7C15)
        two += points[1:]
        four = two[:-2] * U(0xC2B2AE3D27D4EB4F)
        four += two[2:]
        eight = four[:-4] * U(0xD6E8FEB86659FD93)
        eight += four[4:]
        hashed = mix(eight)
    return hashed, np.cumsum(lens + 1) - lens - 1, lens


def _short(lens: np.ndarray) -> list[int]:
    """Lines that are one shingle as a whole."""
    return np.flatnonzero((lens > 0) & (lens < SHINGLE)).tolist()


def line_signatures(lines: list[str], bins: int) -> np.ndarray:
    """MinHash signature of each line's shingles."""
    hashed, first, lens = _rolled(lines)
    hashed = hashed[: int(lens.sum()) + len(lens)]
    gone = (first + lens)[:, None] - np.arange(SHINGLE)[None, :]  # separators and what is too near to them
    gone = gone[gone >= first[:, None]]
    cell = ((hashed >> U(32)) * U(bins)) >> U(32)
    cell += np.repeat(np.arange(len(lines), dtype=U) * U(bins), lens + 1)
    value = hashed.astype(np.uint32)
    keep = np.ones(len(hashed), bool)
    keep[gone] = False
    out = np.full(len(lines) * bins, EMPTY, np.uint32)
    np.minimum.at(out, cell[keep].view(np.int64), value[keep])
    out = out.reshape(len(lines), bins)
    for i in _short(lens):
        out[i, 0] = line_ids([lines[i].lower()])[0] & U(0x7FFFFFFF)
    return filled(out)


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending; ``values`` is sorted in place."""
    values.sort()
    keep = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values if keep.all() else values[keep]


def shingle_sets(lines: list[str]) -> list[np.ndarray]:
    """Distinct shingle hashes of each line; a line shorter than a shingle is one, an empty line
    has none."""
    hashed, first, lens = _rolled(lines)
    out = [_distinct(hashed[a : a + n].copy()) for a, n in zip(first.tolist(), np.maximum(lens - SHINGLE + 1, 0).tolist())]
    for i in _short(lens):
        out[i] = line_ids([lines[i].lower()])
    return out


def _batches(batch: pa.RecordBatch):
    """Document ids, line numbers and lines of a batch without the blank ones, in portions."""
    for part in slices(batch, "text", SLICE):
        docs, numbers, lines = [], [], []
        for i, text in enumerate(part.column("text").to_pylist()):
            for k, line in enumerate((text or "").split("\n")):
                if len(line.strip()) >= MIN_CHARS:
                    docs.append(i)
                    numbers.append(k)
                    lines.append(line)
        if lines:
            yield part.column("doc_id").take(pa.array(docs)), numbers, lines


def keyed_lines(rows: DataFrame, line_rows: int = ROWS, line_bands: int = BANDS) -> DataFrame:
    """Every line that is not blank: doc_id, number, id and its band keys."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for docs, numbers, lines in _batches(batch):
                named = line_ids(lines)
                ids, where, of_line = np.unique(named, return_index=True, return_inverse=True)
                keys = bands(line_signatures([lines[i].strip() for i in where.tolist()], line_rows * line_bands), line_rows)
                first = np.zeros(len(lines), bool)
                first[where] = True  # keys go once per portion
                offsets = np.concatenate(([0], np.cumsum(np.where(first, line_bands, 0))))
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[of_line[first]].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.array(numbers, pa.int32()), pa.array(named.view(np.int64)), listed], ["doc_id", "number", "id", "keys"])

    return rows.mapInArrow(tidy(run), f"doc_id {id_type}, number int, id bigint, keys array<bigint>")


def _candidates(rows: DataFrame, lines: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, line, n, parities) of the wanted line ids; n counts distinct shingles.

    Each wanted id is read at its first place among ``lines``: the documents get the numbers of
    the lines to bring, so no other line leaves a task.
    """
    ids = stored(ids, "ids")
    first = near.semi(lines.select("id", "doc_id", "number"), ids, "id").groupBy("id").agg(F.min(F.struct("doc_id", "number")).alias("at"))
    wanted = first.select(F.col("at.doc_id").alias("doc_id"), F.struct(F.col("at.number").alias("number"), "id").alias("place"))
    wanted = stored(wanted.groupBy("doc_id").agg(F.collect_list("place").alias("places")), "places")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = {}
                for text, places in zip(part.column("text").to_pylist(), part.column("places").to_pylist()):
                    split = (text or "").split("\n")
                    here = [(p["id"], split[p["number"]].strip()) for p in places if p["number"] < len(split)]
                    named = line_ids([line for _, line in here]).view(np.int64).tolist()
                    found.update((i, line) for (i, line), h in zip(here, named) if i == h)
                sets = shingle_sets(list(found.values())) if found else []
                n = np.array([len(s) for s in sets], np.int64)
                hashed = np.concatenate(sets) if sets else np.zeros(0, U)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.string()), pa.array(n),
                     *parities(hashed, np.repeat(np.arange(len(n)), n), len(n))], ["id", "line", "n", *PARITIES])

    # all lists together hold one place an id
    few = ids.count() <= near.BROADCAST_ROWS
    brought = rows.join(F.broadcast(wanted) if few else wanted, "doc_id").select("text", "places")
    return brought.mapInArrow(tidy(run), "id bigint, line string, n bigint, " + ", ".join(f"{w} bigint" for w in PARITIES)).dropDuplicates(["id"])


def _verify(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in slices(batch, "of_a", SLICE):
                good = []
                sets = shingle_sets(part.column("of_a").to_pylist() + part.column("of_b").to_pylist())
                for x, y in zip(sets[: part.num_rows], sets[part.num_rows :]):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(both > 0 and both >= similarity * (len(x) + len(y) - both) - 1e-9)
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return near.with_both(pairs, texts, "line").mapInArrow(tidy(run), "a bigint, b bigint")


def repeated_lines(rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The lines to remove: doc_id, number, id (of the line), kept_in (the document that keeps
    a line of the component). ``rows`` has doc_id and text."""
    named = rows.where("doc_id is not null")
    lines = stored(keyed_lines(named), "lines")
    keys = lines.select(F.explode("keys").alias("key"), "id")
    texts: list[DataFrame] = []

    def features(shared: DataFrame) -> DataFrame:
        texts.append(stored(_candidates(named, lines, shared.select("id").distinct()), "candidates"))
        return texts[0].drop("line")

    roots = near.link(keys, lambda pairs: _verify(pairs, texts[0], similarity), features=features,
                      possible=near.differing_bits() <= near.most_differing(similarity))
    discard(texts[0])
    again = near.repeats(lines.select("doc_id", "number", "id"), roots, "doc_id", "number")
    return again.select("doc_id", "number", "id", F.col("first.doc_id").alias("kept_in"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                count_col: str = "n_removed") -> DataFrame:
    """All rows and columns of ``df`` with the repeated lines cut out of ``text_col``, and
    ``count_col`` (lines cut out).

    Lines end at line feeds; blank lines are never removed. Null
    texts stay null, empty ones empty. Rows without an id take no part and stay as they are. Rows
    that share an id are compared as one document, and a line of one of them is removed only
    where the same line stands at that place. An empty table gives no rows. A column of ``df``
    named ``count_col`` is replaced.
    """
    df = df.drop(count_col)
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    gone = repeated_lines(rows, similarity)
    doc, cut_out, names = unused(df, "_doc"), unused(df, "_gone"), df.columns
    lists = gone.groupBy("doc_id").agg(F.collect_set(F.struct("number", "id")).alias(cut_out)).withColumnRenamed("doc_id", doc)
    joined = df.join(lists, F.col(id_col) == F.col(doc), "left").drop(doc)

    def run(batches):
        for batch in batches:
            texts, cut = [], []
            gone = batch.column(cut_out)
            ends, numbers, ids = gone.offsets.to_pylist(), *(gone.values.field(c).to_pylist() for c in ("number", "id"))
            for text, lo, hi in zip(batch.column(text_col).to_pylist(), ends, ends[1:]):
                if lo == hi or text is None:
                    texts.append(text)
                    cut.append(0)
                    continue
                lines = text.split("\n")
                entries = [(k, h) for k, h in zip(numbers[lo:hi], ids[lo:hi]) if k < len(lines)]
                same = line_ids([lines[k] for k, _ in entries]).view(np.int64).tolist()
                drop = {k for (k, h), found in zip(entries, same) if h == found}
                texts.append("\n".join(line for k, line in enumerate(lines) if k not in drop))
                cut.append(len(drop))
            columns = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cut, pa.int64())], [*names, count_col])

    return joined.mapInArrow(tidy(run), StructType([*df.schema.fields, StructField(count_col, LongType())]))
