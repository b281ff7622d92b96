"""Substring dedup: near-copies of paragraphs by MinHash banding, and passages inside them.

Paragraphs are the lines of a text. Those of at least PARAGRAPH_WORDS words (the general functions
take the bound of passages unless told otherwise) are compared by their sets of five-word shingles: MinHash signatures in bands tuned for high recall (10 bands of 4 values:
0.995 at similarity 0.8, 0.9999 at 0.9), exact Jaccard on colliding pairs, and a distributed
union-find. Of each component one paragraph stays.

A passage can also recur in the middle of otherwise different paragraphs, where the similarity
of the whole says nothing. Texts are therefore cut once more, at the places where a shingle's
MinHash value is the least among WINDOW neighbours: the places depend on the words around them
alone, so a passage that recurs is cut alike wherever it stands. A segment reaches from one
place to the end of the shingle at the next; it is named by a hash of all its words. Runs of
neighbouring segments that each stand in a document of smaller id are repeated passages; runs of
at least MIN_WORDS words are removed. A passage of 51 words has 47 shingles, of which the
cuts can miss nine at either end, so at least 33 words of it lie in segments.

What is removed stays in the document of smallest id that has it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from starloom.llm import hashing, near
from starloom.llm.arrow import discard, slices, stored, tidy, unused
from starloom.llm.hashing import U, mix, seeded
from starloom.llm.minhash import PARITIES, bands, parities, signatures

SHINGLE, SIMILARITY, ROWS, BANDS = 5, 0.8, 4, 10
#: neighbouring shingles of which the least marks a cut; words of a removed run at least
WINDOW, MIN_WORDS = 10, 33
#: words of a compared paragraph at least: fewer have no shingle
PARAGRAPH_WORDS = SHINGLE


def _paragraphs(texts: list[bytes], w: hashing.Words) -> np.ndarray:
    """For every word the number of its paragraph among all of the batch, ascending."""
    if not len(w.hash):
        return np.zeros(0, np.int64)
    buffer = np.frombuffer(b"\n".join(texts), np.uint8)
    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    feeds = np.flatnonzero(buffer == 10)
    return np.searchsorted(feeds, (np.cumsum(lens) - lens)[w.row] + w.start)


def _cuts(shingle: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Numbers of the shingles that are the least of some window within their row."""
    if len(shingle) < WINDOW:
        return np.zeros(0, np.int64)
    order = mix(shingle ^ seeded(1, 29)[0])
    windows = np.lib.stride_tricks.sliding_window_view(order, WINDOW)
    inside = np.flatnonzero(owner[: len(windows)] == owner[WINDOW - 1 :])
    found = np.zeros(len(shingle), bool)
    for lo in range(0, len(inside), 1 << 18):
        at = inside[lo : lo + (1 << 18)]
        found[at + windows[at].argmin(1)] = True
    return np.flatnonzero(found)


def segments(rows: DataFrame) -> DataFrame:
    """(key, doc_id, first, last): hash of each segment, first word and word after the last."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 21):
                w = hashing.words(hashing.raw_texts(part.column("text")))
                shingle, owner, first = hashing.shingles(w, SHINGLE)
                cut = _cuts(shingle, owner)
                if len(cut) < 2:
                    continue
                at, row = first[cut], owner[cut]
                with np.errstate(over="ignore"):
                    place = np.arange(len(w.hash)) - np.repeat(at, np.diff(np.append(at, len(w.hash)))) if at[0] == 0 else None
                    if place is None:
                        place = np.concatenate((np.zeros(at[0], np.int64), np.arange(at[0], len(w.hash)) - np.repeat(at, np.diff(np.append(at, len(w.hash))))))
                    parts = mix(w.hash + place.astype(U) * U(0x9E3779B97F4A7C15))
                    body = np.add.reduceat(parts, at)[:-1]
                    key = mix(body + shingle[cut[1:]] * U(0xC2B2AE3D27D4EB4F))
                good = np.flatnonzero(row[1:] == row[:-1])
                start = w.first[row[good]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[good].view(np.int64)), part.column("doc_id").take(pa.array(row[good])),
                    pa.array((at[good] - start).astype(np.int32)), pa.array((at[good + 1] + SHINGLE - start).astype(np.int32))],
                    ["key", "doc_id", "first", "last"])

    return rows.mapInArrow(tidy(run), f"key bigint, doc_id {id_type}, first int, last int")


def repeated_passages(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, first, last, kept_in): words of every run of segments that stand in documents of
    smaller id. ``rows`` has doc_id and text, each id once."""
    # dealt by key once: what is found of the keys and the join with it work on what was dealt. Only
    # uses that read the same columns and rows share it, hence the length and the ids, which every segment has
    found = stored(segments(rows), "segments").where("doc_id is not null").repartition("key")
    spread = found.groupBy("key").agg(F.min("doc_id").alias("kept_in"), F.max("doc_id").alias("_hi"),
                                      F.max(F.col("last") - F.col("first")).alias("_words"))
    spread = spread.where("kept_in < _hi").where(F.col("_words") >= SHINGLE).select("key", "kept_in")
    again = found.join(spread.hint("shuffle_hash"), "key").where("doc_id > kept_in")
    # a run: segments of a document whose words follow without a gap
    inside = Window.partitionBy("doc_id").orderBy("first")
    opens = F.coalesce((F.col("first") > F.max("last").over(inside.rowsBetween(Window.unboundedPreceding, -1)) - SHINGLE), F.lit(True))
    runs = again.withColumn("_run", F.sum(opens.cast("int")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("doc_id", "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.min("kept_in").alias("kept_in"))
    return runs.where(F.col("last") - F.col("first") >= min_words).select("doc_id", "first", "last", "kept_in")


def _paragraph_sets(part: pa.RecordBatch, min_words: int):
    """Long enough paragraphs of a batch: row, first and last word, 64-bit id, distinct shingles
    and the paragraph each belongs to."""
    texts = hashing.raw_texts(part.column("text"))
    w = hashing.words(texts)
    paragraph = _paragraphs(texts, w)
    starts = np.flatnonzero(np.concatenate(([True], paragraph[1:] != paragraph[:-1]))) if len(paragraph) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(paragraph)))
    long = sizes >= min_words
    number = np.full(len(starts), -1)
    number[long] = np.arange(int(long.sum()))
    group = np.repeat(number, sizes)
    keep = group >= 0
    chosen = hashing.Words(w.hash[keep], w.row[keep], w.start[keep], w.end[keep], w.first)
    shingle, owner, _ = hashing.shingles(chosen, SHINGLE, group[keep])
    n = int(long.sum())
    with np.errstate(over="ignore"):
        place = np.arange(len(chosen.hash)) - np.repeat(np.cumsum(sizes[long]) - sizes[long], sizes[long])
        parts = mix(chosen.hash + place.astype(U) * U(0x9E3779B97F4A7C15))
        ids = mix(np.add.reduceat(parts, np.cumsum(sizes[long]) - sizes[long])) if n else np.zeros(0, U)
    row = w.row[starts[long]]
    first = starts[long] - w.first[row]
    hashed, owner = hashing.distinct(shingle, owner)
    return row, first, first + sizes[long], ids, hashed, owner, n


def paragraphs(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, first, last, id, n, keys) of every long enough paragraph; keys go once per portion."""
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 21):
                row, first, last, ids, hashed, owner, n = _paragraph_sets(part, min_words)
                if not n:
                    continue
                keys = bands(signatures(hashed, owner, n, ROWS * BANDS), ROWS)
                fresh = np.zeros(n, bool)
                fresh[np.unique(ids, return_index=True)[1]] = True
                offsets = pa.array(np.concatenate(([0], np.cumsum(np.where(fresh, BANDS, 0)))), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(row)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                    pa.array(ids.view(np.int64)), pa.array(np.bincount(owner, minlength=n)),
                    pa.ListArray.from_arrays(offsets, pa.array(keys[fresh].ravel()))], ["doc_id", "first", "last", "id", "n", "keys"])

    return rows.mapInArrow(tidy(run), f"doc_id {id_type}, first int, last int, id bigint, n bigint, keys array<bigint>")


def _sets(rows: DataFrame, min_words: int) -> DataFrame:
    """(id, shingles, parities): the distinct shingle hashes of each paragraph, eight bytes each."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 1 << 21):
                _, _, _, ids, hashed, owner, n = _paragraph_sets(part, min_words)
                ends = np.searchsorted(owner, np.arange(n + 1))
                cut = [hashed[a:b].tobytes() for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.view(np.int64)), pa.array(cut, pa.binary()), *parities(hashed, owner, n)], ["id", "shingles", *PARITIES])

    return rows.mapInArrow(tidy(run), "id bigint, shingles binary, " + ", ".join(f"{w} bigint" for w in PARITIES))


def _verify(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("of_a"), batch.column("of_b")):
                x, y = np.frombuffer(x.as_py(), U), np.frombuffer(y.as_py(), U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return near.with_both(pairs, sets, "shingles").mapInArrow(tidy(run), "a bigint, b bigint")


def repeated_paragraphs(rows: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, first, last, kept_in) of all paragraphs of a component but its first."""
    made = stored(paragraphs(rows, min_words), "paragraphs")
    keys = made.select(F.explode("keys").alias("key"), "id", "n")
    n_a, n_b = F.col("n_a"), F.col("n_b")
    comparable = F.least(n_a, n_b) >= similarity * F.greatest(n_a, n_b) - 1e-9

    sets: list[DataFrame] = []

    def features(shared: DataFrame) -> DataFrame:
        ids = stored(shared.select("id").distinct(), "ids")
        # one place of each wanted paragraph, so that only documents that have one are read
        places = near.rows_of(made.select("id", "doc_id"), ids, "id").groupBy("id").agg(F.min("doc_id").alias("doc"))
        docs = places.select(F.col("doc").alias("id")).distinct()
        found = near.semi(_sets(near.rows_of(rows, docs, "doc_id"), min_words), ids, "id")
        sets.append(stored(found.dropDuplicates(["id"]), "sets"))
        return sets[0].drop("shingles")

    roots = near.link(keys, lambda pairs: _verify(pairs, sets[0], similarity), comparable=comparable, features=features,
                      possible=near.differing_bits() <= near.most_differing(similarity), ratio=similarity)
    discard(sets[0])
    again = near.repeats(made.select("doc_id", F.col("first").alias("start"), "last", "id"), roots, "doc_id", "start")
    return again.select("doc_id", F.col("start").alias("first"), "last", F.col("first.doc_id").alias("kept_in"))


def _one_text(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows with the smallest text of each id, and those of the ids that had several, if any."""
    twice = stored(rows.groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    if twice.isEmpty():
        return rows, None
    least = stored(near.semi(rows, twice, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")), "least")
    return rows.join(twice, "doc_id", "left_anti").unionByName(least), least


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, min_words: int = MIN_WORDS,
                   paragraph_words: int | None = None) -> DataFrame:
    """What is to be removed: doc_id, kind, first, last (words of the text, the last excluded),
    kept_in (the document that keeps it). Passages have at least ``min_words`` words, paragraphs
    ``paragraph_words``, or as many as passages if None.

    Null and empty texts have nothing to remove. Rows without an id take no part. Of rows that
    share an id, that of the smallest text stands for the id. An empty table gives no rows;
    other columns are not read.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    return _spans(_one_text(rows)[0], similarity, min_words, paragraph_words)


def _spans(rows: DataFrame, similarity: float, min_words: int, paragraph_words: int | None) -> DataFrame:
    passages = repeated_passages(rows, min_words).withColumn("kind", F.lit("passage"))
    whole = repeated_paragraphs(rows, similarity, min_words if paragraph_words is None else max(paragraph_words, SHINGLE)).withColumn("kind", F.lit("paragraph"))
    return passages.unionByName(whole).select("doc_id", "kind", "first", "last", "kept_in")


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, min_words: int = MIN_WORDS,
                     paragraph_words: int | None = None) -> DataFrame:
    """All rows and columns of ``df`` with the repeated spans cut out of ``text_col``.

    White space that followed a removed span goes with it. Of rows that share an id those with its
    smallest text are cut alike, and other texts stay as they are. Null texts stay null.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    rows, least = _one_text(rows)
    spans = _spans(rows, similarity, min_words, paragraph_words)
    doc, cut_out, stands, names = unused(df, "_doc"), unused(df, "_gone"), unused(df, "_stands"), df.columns
    lists = spans.groupBy("doc_id").agg(F.collect_set(F.struct("first", "last")).alias(cut_out))
    if least is not None:
        lists = lists.join(least.withColumnRenamed("text", stands), "doc_id", "left")
    lists = lists.withColumnRenamed("doc_id", doc)
    joined = df.join(lists, F.col(id_col) == F.col(doc), "left").drop(doc)
    if least is not None:
        same = F.col(stands).isNull() | (F.col(stands) == F.col(text_col))
        joined = joined.withColumn(cut_out, F.when(same, F.col(cut_out))).drop(stands)

    def run(batches):
        for batch in batches:
            column, gone, texts = batch.column(text_col), batch.column(cut_out), []
            for i in range(batch.num_rows):
                entries, text = gone[i].as_py(), column[i].as_py()
                texts.append(_without(text, entries) if entries and text else text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in names], names)

    return joined.mapInArrow(tidy(run), df.schema)


def _without(text: str, spans: list[dict]) -> str:
    raw = text.encode("utf-8")
    w = hashing.words([raw])
    n = len(w.start)
    drop = np.zeros(n + 1, bool)
    for s in spans:
        drop[min(s["first"], n) : min(s["last"], n)] = True
    if not drop.any():
        return text
    edge = np.flatnonzero(drop[1:] != drop[:-1]) + 1
    edge = np.concatenate(([0], edge)) if drop[0] else edge
    out, at = [], 0
    for a, b in zip(edge[::2].tolist(), [*edge[1::2].tolist(), n]):
        out.append(raw[at : int(w.start[a])])
        at = int(w.start[b]) if b < n else len(raw)
    out.append(raw[at:])
    return b"".join(out).decode("utf-8").rstrip() if at == len(raw) else b"".join(out).decode("utf-8")
