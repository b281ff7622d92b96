"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions alone.

A window is as many consecutive words of a benchmark item as are asked for, or the whole of an
item that has fewer. Its set is that of its shingles, runs of a few words. A document contains
the window only if it holds every shingle of it, so with the shingles in one global order, rarest
in the documents first, a window's prefix is its first shingle: windows meet documents on that
one alone. The places of the shingle in the window and in the document give the place where the
window would stand; it must lie within the document (positions, lengths), and then the words
themselves are compared. Nothing is taken on the strength of a hash.

The documents are read twice: to count the windows' shingles, and to join. What joins is the
shingles of the documents against the windows. Windows are broadcast after their size was measured, and then
documents never move; beyond the bound the shingles are shuffled without the texts, and only
candidates meet their words again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.arrow import stored

WINDOW, SHINGLE = 10, 4
#: what lies between words: all of ASCII but digits and small letters
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: windows are broadcast up to this many bytes of words
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    """The words of a text, A-Z as a-z; none of a null."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL), GAPS), "")


def _shingles(hashes: Column, size: int) -> Column:
    """Hash of every run of ``size`` words, in order of their places; ``hashes`` are the words'."""
    runs = F.transform(F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(size))))
    return F.when(F.size(hashes) >= size, runs).otherwise(F.array().cast("array<bigint>"))


def _hashes(of: Column) -> Column:
    return F.transform(of, lambda word: F.xxhash64(word))


def windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(words, size, items): distinct windows with the ids of the items they are of."""
    worded = items.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    cut = worded.select("item", "w", F.explode(starts).alias("i")).select("item", F.expr(f"slice(w, i, {window})").alias("words"))
    return cut.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items")).select("words", F.size("words").alias("size"), "items")


def _worded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, w): the documents as words; id and digest name a text."""
    return docs.select(F.col(id_col).alias("id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("digest"), words(F.col(text_col)).alias("w"))


def _shingled(worded: DataFrame, sizes: list[int]) -> DataFrame:
    """Every shingle of every document with its place: id, digest, w, size, at (from 0), shingle;
    a null shingle where there are none.

    The arrays are made before they are opened, so that opening and joining them is one piece of
    generated code in which the words are not copied from row to row. They are opened with
    ``outer``: otherwise the optimizer tests the arrays' sizes first and so makes them twice."""
    hashed = worded.withColumn("h", _hashes(F.col("w")))
    runs = hashed.select("id", "digest", "w", F.array(*(_shingles(F.col("h"), s) for s in sizes)).alias("runs"))
    which = runs.select("id", "digest", "w", F.posexplode_outer("runs").alias("which", "run"))
    size = F.element_at(F.array(*(F.lit(s) for s in sizes)), F.col("which") + 1)
    return which.select("id", "digest", "w", "which", F.posexplode_outer("run").alias("at", "shingle")).withColumn("size", size)


def _window_shingles(cut: DataFrame, shingle: int) -> DataFrame:
    """(words, items, size, offset, shingle): the shingles of every window, of ``size`` words."""
    hashed = cut.withColumn("h", _hashes(F.col("words"))).withColumn("size", F.least(F.size("words"), F.lit(shingle)))
    each = F.lit(None).cast("array<bigint>")
    for s in range(1, shingle + 1):
        each = F.when(F.col("size") == s, _shingles(F.col("h"), s)).otherwise(each)
    return hashed.select("words", "items", "size", F.posexplode_outer(each).alias("offset", "shingle"))


def _same(a: str, b: str) -> Column:
    """Whether two rows are of the same text of the same id, which may be null."""
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.digest") == F.col(f"{b}.digest"))


def occurrences(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
                item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per place of a window in a document: id, digest (of the text), start (the number of its
    first word), size (words), items (ids of the items that have the window)."""
    shingle = min(shingle, window)
    cut = stored(windows(items, item_id, item_text, window), "windows")
    seen = cut.agg(F.sum(F.length(F.concat_ws(" ", "words")) + 24 * F.size("words") + 16 * F.size("items")).alias("bytes"),
                   F.collect_set(F.least(F.size("words"), F.lit(shingle))).alias("sizes")).first()
    sizes = sorted(seen["sizes"]) or [shingle]
    small = (seen["bytes"] or 0) <= broadcast_bytes
    hint = F.broadcast if small else (lambda df: df)
    worded = _worded(docs, doc_id, doc_text)
    runs = _shingled(worded, sizes)

    # rarity: how often the documents hold each shingle of a window
    of_windows = _window_shingles(cut, shingle)
    asked = of_windows.select("size", "shingle").distinct()
    counted = runs.select("size", "shingle").join(hint(asked), ["size", "shingle"], "left_semi").groupBy("size", "shingle").agg(F.count(F.lit(1)).alias("often"))
    ranked = of_windows.join(hint(counted), ["size", "shingle"]).groupBy("words", "items", "size").agg(
        F.count(F.lit(1)).alias("held"), F.min(F.struct("often", "shingle", "offset")).alias("first"))
    # a window with a shingle that no document holds stands in none
    whole = ranked.where(F.col("held") == F.size("words") - F.col("size") + 1)
    prefix = stored(whole.select("words", "items", F.size("words").alias("n"), "size", "first.shingle", "first.offset"), "prefixes")

    if small:
        met = runs.join(F.broadcast(prefix), ["size", "shingle"])
    else:
        met = runs.drop("w").join(prefix, ["size", "shingle"]).where(F.col("at") >= F.col("offset"))
        texts = worded.dropDuplicates(["id", "digest"])
        met = met.alias("m").join(texts.alias("t"), _same("m", "t")).select("m.*", "t.w")
    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.col("n") <= F.size("w"))
    exact = met.where(inside).where(F.expr("slice(w, greatest(at - offset, 0) + 1, n) = words"))
    return exact.select("id", "digest", start.alias("start"), F.col("n").alias("size"), "items")


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside any window that occurs), items (ids as
    strings, sorted, of the items with such windows), spans (stretches of hit words: first word,
    number of words).

    A null or empty text, or one of separators alone, has no words and no hits. Each row of
    ``docs`` gives a row, also where ids are null or repeated. An item without words has no
    window; windows of an item with a null id hit, but it is in no list; rows of one item id are
    one item. Empty tables give no rows, or rows without hits. Other columns are not read.
    """
    found = stored(occurrences(docs, items, doc_id, doc_text, item_id, item_text, window, shingle, broadcast_bytes), "occurrences")
    key = ["id", "digest"]
    places = found.groupBy(*key, "start").agg(F.max("size").alias("size"))  # longest window at each place
    end = F.col("start") + F.col("size")
    before = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reach = places.withColumn("reach", F.coalesce(F.max(end).over(before), F.lit(0)))
    own = F.greatest(end - F.greatest("start", "reach"), F.lit(0)).cast("bigint")
    # a stretch begins where no window before reaches; its end is the furthest until the next
    running = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    stretch = reach.withColumn("own", own).withColumn("span", F.sum((F.col("start") > F.col("reach")).cast("int")).over(running))
    spans = stretch.groupBy(*key, "span").agg(F.min("start").alias("first"), (F.max(end) - F.min("start")).alias("number"), F.sum("own").alias("own"))
    spans = spans.groupBy(*key).agg(F.sum("own").alias("n_hit"), F.sort_array(F.collect_list(F.struct("first", "number"))).alias("spans"))
    # items with the same windows come as one list: equal lists are dropped before any is opened
    lists = found.select(*key, "items").distinct().select(*key, F.explode(F.col("items").cast("array<string>")).alias("item"))
    lists = lists.groupBy(*key).agg(F.sort_array(F.collect_set("item")).alias("items"))
    text = F.coalesce(F.col(doc_text), F.lit(""))
    every = docs.select(F.col(doc_id).alias("id"), F.sha2(text, 256).alias("digest"), F.size(words(text)).cast("bigint").alias("n_words"))
    joined = every.alias("e").join(spans.alias("s"), _same("e", "s"), "left").join(lists.alias("l"), _same("e", "l"), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        F.col("e.id").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.coalesce("spans", F.array().cast("array<struct<first:int,number:int>>")).alias("spans"))
