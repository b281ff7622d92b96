"""N-gram Jaccard join with a prefix tree.

A document's set holds its distinct word shingles in one global order, rarest first: shingles
are ordered by a coarse class of their frequency in all documents and then by hash. Frequencies
come from a table of ``BUCKETS`` counters summed over every document. The order only decides
what is cheap; any order gives the same links.

Two sets that are similar enough share several of their first shingles: with an overlap of at
least ``need`` the prefixes of length n - need + k have k shingles in common. Documents meet on
the shingles of their prefixes; pairs that meet often enough are verified. For that, the sets
that meet one set are stored in a radix tree, and the one set walks it: the overlap along a
shared path is counted once for all sets below, and a subtree is left as soon as the shingles
that remain on either side cannot make up the overlap that its smallest set asks for.

Documents with the same set are one class, held by its smallest id.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import hashing, near
from starloom.llm.arrow import discard, slices, stored, tidy
from starloom.llm.components import components
from starloom.llm.minhash import PARITIES, parities

U = np.uint64
#: counters of the frequency table, and how many travel in one row
BUCKETS, SLICE = 1 << 20, 1 << 12
SHINGLE, PERCENT = 3, 90
#: share of a set, in hundredths, by which prefixes are longer than needed for one common
#: shingle, so that pairs must share that many more; and the share of a set whose most frequent
#: shingles in the prefix need not be looked at, as pairs share more than those
EXTRA, SPARE = 4, 2


def needed(n_a: int, n_b: int, percent: int = PERCENT) -> int:
    """Smallest overlap o with 100 * o >= percent * (n_a + n_b - o)."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    least = -(-percent * n // 100)
    return n - least + 1 + EXTRA * n // 100


def _document_sets(part: pa.RecordBatch, size: int):
    texts = hashing.raw_texts(part.column("text"))
    hashed, owner, _ = hashing.shingles(hashing.words(texts), size)
    return (*hashing.distinct(hashed, owner), len(texts))


def _bucket(hashed: np.ndarray) -> np.ndarray:
    return (hashed >> U(44)).astype(np.int64)


def profiles(rows: DataFrame, size: int) -> DataFrame:
    """One pass over the texts: per row doc_id, n and digests of its set, and per task its part of
    the frequency table in rows with ``slice`` and ``counts``."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        counts, here = np.zeros(BUCKETS, np.uint64), None
        for batch in batches:
            here = here or batch.schema.field("doc_id").type
            for part in slices(batch, "text"):
                hashed, owner, n = _document_sets(part, size)
                counts += np.bincount(_bucket(hashed), minlength=BUCKETS).astype(np.uint64)
                one, two = hashing.set_digests(hashed, owner, n)
                empty = pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.bincount(owner, minlength=n)), pa.array(one), pa.array(two), *empty], names)
        if here is not None and counts.any():
            at = [i for i in range(BUCKETS // SLICE) if counts[i * SLICE : (i + 1) * SLICE].any()]
            packed = [zlib.compress(counts[i * SLICE : (i + 1) * SLICE].tobytes(), 1) for i in at]
            gone = [pa.nulls(len(at), t) for t in (here, pa.int64(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*gone, pa.array(at, pa.int32()), pa.array(packed, pa.binary())], names)

    names = ["doc_id", "n_shingles", "one", "two", "slice", "counts"]
    return rows.mapInArrow(tidy(run), f"doc_id {id_type}, n_shingles bigint, one bigint, two bigint, slice int, counts binary")


def frequency_classes(profile: DataFrame) -> np.ndarray:
    """The table summed over all tasks, as logarithms: one byte per bucket."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                counts = np.frombuffer(zlib.decompress(packed), np.uint64)
                sums[i] = sums[i] + counts if i in sums else counts
        packed = [zlib.compress(v.tobytes(), 1) for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], ["slice", "counts"])

    tables, ddl = profile.where("slice is not null").select("slice", "counts"), "slice int, counts binary"
    # salted: the parts of one slice from many tasks are added up in eight places, then in one
    spread = tables.repartition(64, "slice", F.pmod(F.xxhash64("counts"), F.lit(8))).mapInArrow(tidy(run), ddl)
    out = np.zeros(BUCKETS, np.uint64)
    for row in spread.repartition(16, "slice").mapInArrow(tidy(run), ddl).collect():  # BUCKETS counters
        out[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] += np.frombuffer(zlib.decompress(row["counts"]), np.uint64)
    # below twice the mean the noise of the table hides the frequency: one class
    mean = max(float(out.mean()), 1.0)
    return np.clip(np.round(2 * np.log2(np.maximum(out / (2 * mean), 1.0))), 0, 62).astype(np.uint8)


def ordered(hashed: np.ndarray, owner: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets in global order: a token is its class and the rest of its hash."""
    tokens = (classes[_bucket(hashed)].astype(U) << U(58)) | (hashing.mix(hashed.copy()) >> U(6))
    return hashing.distinct(tokens, owner)


# --- the tree -----------------------------------------------------------------------------------

class SetTree:
    """Radix tree of ascending token arrays; a node holds the tokens up to the next fork."""

    def __init__(self, sets: list[np.ndarray]):
        self.nodes: list[tuple] = []  # tokens, depth before, smallest and largest set, children, sets that end
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sets = [sets[i] for i in order]
        self.names = order
        self.roots = self._build(0, len(order), 0) if order else []

    def _build(self, lo: int, hi: int, depth: int) -> list[int]:
        """Nodes of the sets ``lo`` to ``hi``, which agree on their first ``depth`` tokens."""
        out, work = [], [(lo, hi, depth, None)]
        while work:
            lo, hi, depth, parent = work.pop()
            i = lo
            while i < hi:
                if len(self.sets[i]) == depth:  # ends where its parent ends
                    self.nodes[parent][5].append(i)
                    i += 1
                    continue
                j = i + 1
                while j < hi and self.sets[j][depth] == self.sets[i][depth]:
                    j += 1
                first, last = self.sets[i], self.sets[j - 1]
                m = min(len(first), len(last))
                differ = np.flatnonzero(first[depth:m] != last[depth:m])
                upto = depth + int(differ[0]) if len(differ) else m
                sizes = [len(s) for s in self.sets[i:j]]
                node = len(self.nodes)
                self.nodes.append((first[depth:upto], depth, min(sizes), max(sizes), [], []))
                (out if parent is None else self.nodes[parent][4]).append(node)
                work.append((i, j, upto, node))
                i = j
        return out

    def similar(self, probe: np.ndarray, percent: int) -> list[int]:
        """Numbers of the sets whose overlap with ``probe`` is large enough."""
        found, work, n = [], [(r, 0) for r in self.roots], len(probe)
        while work:
            at, overlap = work.pop()
            tokens, depth, least, most, children, ends = self.nodes[at]
            place = np.searchsorted(probe, tokens)
            hit = probe[np.minimum(place, n - 1)] == tokens
            overlap += int(hit.sum())
            left = n - int(place[-1]) - int(hit[-1])  # of the probe beyond the last token
            depth += len(tokens)
            if overlap + min(most - depth, left) < needed(n, max(least, depth), percent):
                continue
            for i in ends:
                if overlap >= needed(n, len(self.sets[i]), percent):
                    found.append(self.names[i])
            work += [(c, overlap) for c in children]
        return found


# --- the join --------------------------------------------------------------------------------------

def prefixes(rows: DataFrame, size: int, percent: int, classes: np.ndarray) -> DataFrame:
    """(key, id, n): the prefix of every set; and for each set a row without a key but with its
    parities."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(classes)  # BUCKETS bytes

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                hashed, owner, n = _document_sets(part, size)
                tokens, owner = ordered(hashed, owner, shared.value)
                counts = np.bincount(owner, minlength=n)
                place = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
                keep = place < prefix_length(counts, percent)[owner]
                ids = part.column("doc_id").take(pa.array(owner[keep]))
                none = [pa.nulls(int(keep.sum()), pa.int64())] * len(PARITIES)
                yield pa.RecordBatch.from_arrays([pa.array(tokens[keep].view(np.int64)), ids, pa.array(counts[owner[keep]]), *none], names)
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), part.column("doc_id"), pa.array(counts), *parities(tokens, owner, n)], names)

    names = ["key", "id", "n", *PARITIES]
    return rows.mapInArrow(tidy(run), f"key bigint, id {id_type}, n bigint, " + ", ".join(f"{w} bigint" for w in PARITIES))


def _sets(rows: DataFrame, size: int, classes: np.ndarray) -> DataFrame:
    """(id, tokens): whole sets in global order, eight bytes a token."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(classes)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                hashed, owner, n = _document_sets(part, size)
                tokens, owner = ordered(hashed, owner, shared.value)
                ends = np.searchsorted(owner, np.arange(n + 1))
                cut = [tokens[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(cut, pa.binary())], ["id", "tokens"])

    return rows.mapInArrow(tidy(run), f"id {id_type}, tokens binary")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough. In each batch the sets that meet the same
    ``a`` form a tree that the set of ``a`` walks."""
    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("of_b"))
    id_type = sets.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "of_b"):
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                of_a, of_b = part.column("of_a"), part.column("of_b")
                meets: dict = {}
                for i, x in enumerate(a):
                    meets.setdefault(x, []).append(i)
                found = []
                for rows in meets.values():
                    probe = np.frombuffer(of_a[rows[0]].as_py(), U)
                    tree = SetTree([np.frombuffer(of_b[i].as_py(), U) for i in rows])
                    found += [rows[i] for i in tree.similar(probe, percent)]
                kinds = batch.schema.field("a").type, batch.schema.field("b").type
                yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in found], kinds[0]), pa.array([b[i] for i in found], kinds[1])], ["a", "b"])

    return pairs.join(right, "b").join(left, "a").select("a", "b", "of_a", "of_b").mapInArrow(tidy(run), f"a {id_type}, b {id_type}")


def similarity_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable over links).

    Two documents link when 100 * intersection >= percent * union of their sets of ``size``-word
    shingles; letter case A-Z does not count. Fewer words are one shingle. Null texts and texts
    without words have no shingles, link with nothing and are components of their own. Rows that
    share an id share its links. Rows without an id are returned without a component. An empty
    table gives no rows; other columns are not read.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    profile = stored(profiles(rows, size), "profiles")
    docs = profile.where("slice is null").drop("slice", "counts")
    classes = frequency_classes(profile)
    by_set = ["n_shingles", "one", "two"]
    held = docs.where("n_shingles > 0 and doc_id is not null")
    groups = stored(held.groupBy(*by_set).agg(F.min("doc_id").alias("held_by"), F.count(F.lit(1)).alias("copies")), "classes")

    # a class takes part once: copies meet their own smallest id on the digest, not on shingles
    copies = held.join(groups.where("copies > 1"), by_set).where("doc_id <> held_by").select(F.col("doc_id").alias("id"), "held_by")
    copies = stored(copies, "copies")
    usable = rows.where("doc_id is not null")
    keys = prefixes(usable, size, percent, classes)
    twice = stored(held.groupBy("doc_id").count().where("count > 1"), "twice")
    gone = copies.select("id").distinct()
    once = twice.isEmpty()
    if not once:  # another row of the id may be the holder of its own set
        gone = gone.join(groups.select(F.col("held_by").alias("id")).distinct(), "id", "left_anti")
    keys = stored(keys.join(gone, "id", "left_anti"), "prefixes")

    n_a, n_b = F.col("n_a"), F.col("n_b")
    comparable = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    # a document may drop as many frequent shingles as its smallest partner shares at least
    spare = F.floor(SPARE * F.ceil(percent * F.col("n") / 100) / 100)
    enough = F.col("shared") >= 1 + F.floor(EXTRA * F.least(n_a, n_b) / 100) - F.floor(SPARE * F.ceil(percent * F.greatest(n_a, n_b) / 100) / 100)

    written: list[DataFrame] = []

    def verify(pairs: DataFrame) -> DataFrame:
        while written:  # what the call before returned has been written
            discard(written.pop())
        pairs = stored(pairs, "pairs")
        ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        sets = _sets(near.rows_of(usable, ids, "doc_id"), size, classes)
        sets = stored(sets if once else sets.distinct(), "sets")  # only equal rows of one id need a shuffle
        written.extend((pairs, sets))
        return _verify(pairs, sets, percent).distinct()

    def features(_: DataFrame) -> DataFrame | None:
        parity = stored(keys.where("key is null").drop("key", "n"), "parities") if once else None
        discard(keys)
        return parity

    # tokens in which two linked sets differ at most, against bits in which they do
    overlap = F.ceil(percent * (n_a + n_b) / (100 + percent))
    roots = near.link(keys.where("key is not null").select("key", "id", "n"), verify, enough, comparable, spare=spare, features=features,
                      possible=near.differing_bits() <= n_a + n_b - 2 * overlap if once else None, ratio=percent / 100)
    while written:
        discard(written.pop())
    linked = roots.select(F.col("id").alias("held_by"), "root")
    of_class = groups.join(linked, "held_by", "left").select(*by_set, F.coalesce("root", "held_by").alias("component_id"))
    # an id that several rows share ties their components together
    out = docs.join(of_class, by_set, "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    if once:
        return out.select("doc_id", "n_shingles", "component_id")
    out = stored(out, "rows")
    tied = components(out.select("doc_id", "component_id"), "doc_id", "component_id")
    return out.drop("component_id").join(tied.select(F.col("id").alias("doc_id"), F.col("root").alias("component_id")), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
