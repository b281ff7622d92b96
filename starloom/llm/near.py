"""From keys that similar items share to components of similar items.

Items that share a key are candidates. Links are found in passes. The first ones compare
items with one centre of each key they have, so a group of n copies costs n comparisons; their
links are joined to components, and passes with other centres follow while they link enough. The
last takes the keys that still hold items of several components and compares their items across
components, so no candidate pair is left out that could change the result: what is skipped lies
in one component already.

A caller brings ``verify``: pairs of ids in, similar pairs out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.arrow import discard, stored, together
from starloom.llm.components import components
from starloom.llm.minhash import PARITIES

#: rows a broadcast may hold (a few numbers each, so some 20 MB); beyond it both sides are shuffled
BROADCAST_ROWS = 500_000
#: pairs a broadcast may hold with the parities of their items (some 150 bytes each, so 30 MB)
BROADCAST_PAIRS = 200_000

#: passes with further centres: two, and more while one pair in twenty of the last was similar
LEAST_TURNS, LINKED = 2, 20


def small(table: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """The broadcast hint, if the counted rows of ``table`` are few, else nothing."""
    return F.broadcast if table.count() <= BROADCAST_PAIRS else lambda df: df


def few(table: DataFrame) -> DataFrame:
    """The written ``table`` of ids and single numbers, with the broadcast hint if its counted rows are few."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def fitted(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in a few tasks, if it is made of so few ``rows``."""
    return together(df) if rows <= BROADCAST_ROWS else df


def semi(rows: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Rows with the columns of ``small``, which has one row per value of ``on``. It is broadcast
    only if its counted rows are few; otherwise both sides are shuffled."""
    return rows.join(few(small), on)


def with_both(pairs: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """The written distinct pairs (a, b) with what ``rows``, one per id, hold of both in ``column``, as
    of_a and of_b. A few pairs are sent to the rows, and only what they need of those is moved;
    both halves meet on the pair, so that a centre of many pairs is no task's own."""
    of_a, of_b = (rows.select(F.col("id").alias(x), F.col(column).alias(f"of_{x}")) for x in "ab")
    if pairs.count() > BROADCAST_PAIRS:
        return pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "of_a", "of_b")
    both = of_a.join(F.broadcast(pairs), "a").join(of_b.join(F.broadcast(pairs), "b"), ["a", "b"])
    return together(both.select("a", "b", "of_a", "of_b"))


def repeats(rows: DataFrame, roots: DataFrame, *at: str) -> DataFrame:
    """Rows of ``rows`` whose component has several, but for the ``first`` of each, the least in the
    columns ``at``. Only rows whose id occurs again or is linked are looked at together."""
    again = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    linked = roots.select("id", "root").unionByName(roots.select(F.col("root").alias("id"), "root").distinct())
    wanted = stored(again.join(linked, "id", "full").select("id", F.coalesce("root", "id").alias("root")), "wanted")
    found = stored(semi(rows, wanted, "id"), "found")
    first = stored(found.groupBy("root").agg(F.min(F.struct(*at)).alias("first")), "first")
    return semi(found, first, "root").where(F.struct(*at) != F.col("first"))


def shared_keys(rows: DataFrame, ratio: float | None = None) -> DataFrame:
    """Distinct rows (key, id, ...) whose key belongs to several ids, with ``centre``, the least of
    them, and ``held``, the rows of the key. Rows are dealt by key once: what is found of the keys,
    the join with it and the distinct rows all work on what was dealt, so that the rows are moved
    once however many keys are shared. Callers send equal rows once a portion, if they can.

    If similar items have sizes ``n`` of at least this ``ratio``, they lie in the same or in
    neighbouring classes of a logarithmic scale; per key one mask tells which classes there are,
    and a row goes whose key no item of its own or a neighbouring class shares.
    """
    spread = [F.min("id").alias("centre"), F.max("id").alias("_hi"), F.count(F.lit(1)).alias("held")]
    rows = rows.repartition("key")
    if ratio is None:
        found = rows.groupBy("key").agg(*spread).where("centre < _hi").select("key", "centre", "held")
        return rows.join(found.hint("shuffle_hash"), "key").distinct()
    # a little wider than the ratio, so that rounding parts no pair; 64 classes, then around again
    place = F.floor(F.log("n") / F.log(F.lit(1 / (ratio - 0.001))))
    rows = rows.withColumn("_bit", F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int")))
    around = F.shiftleft("_bit", 1).bitwiseOR(F.shiftrightunsigned("_bit", 63)).bitwiseOR(
        F.shiftrightunsigned("_bit", 1)).bitwiseOR(F.shiftleft("_bit", 63))
    found = rows.groupBy("key").agg(*spread, F.bit_or("_bit").alias("_classes")).where("centre < _hi")
    # a key of two or three rows in far classes goes before the join
    found = found.drop("_hi").withColumn("_alike", F.col("held") > F.bit_count("_classes"))
    turned = F.shiftleft("_classes", 1).bitwiseOR(F.shiftrightunsigned("_classes", 63))
    found = found.where(F.col("_alike") | (F.col("_classes").bitwiseAND(turned) != 0))
    here = rows.join(found.hint("shuffle_hash"), "key")
    return here.where(F.col("_alike") | (F.col("_classes").bitwiseAND(around) != 0)).drop("_bit", "_classes", "_alike").distinct()


def without_hottest(shared: DataFrame, spare: Column) -> DataFrame:
    """The rows without the ``spare`` most frequent keys of each item, ties by key.

    Of the keys two items have in common, each drops a most frequent part that is at most
    ``spare`` long, so all but the larger of both spares stay common.
    """
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("held"), "key"))
    return shared.withColumn("_place", place).where(F.col("_place") > spare).drop("_place")


def rows_of(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose id is among the distinct ``ids`` (column ``id``)."""
    ids = stored(ids.select(F.col("id").alias(id_col)), "ids")
    return semi(df, ids, id_col)


def differing_bits() -> Column:
    """Bits in which the parities of a pair differ."""
    return reduce(add, [F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in PARITIES])


def most_differing(similarity: float) -> Column:
    """Elements in which two sets of n_a and n_b can differ at most at this similarity."""
    both = F.col("n_a") + F.col("n_b")
    return both - 2 * F.ceil(similarity * both / (1 + similarity) - 1e-9)


def rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with ``root``: the root of their id, the id itself where it has no link."""
    return rows.join(few(roots), "id", "left").withColumn("root", F.coalesce("root", "id"))


def several_components(shared: DataFrame, roots: DataFrame, order: Column) -> DataFrame:
    """Rows with ``root`` of the keys that hold several components, with ``centre``, the last id of
    the key in ``order``, its root and, where the rows have one, its size ``centre_n``."""
    mixed = rooted(shared, roots).repartition("key")
    of_centre = [F.max_by(c, order).alias("centre" if c == "id" else f"centre_{c}") for c in ("id", "root", "n") if c in mixed.columns]
    several = mixed.groupBy("key").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"), *of_centre).where("_lo < _hi")
    return mixed.join(several.drop("_lo", "_hi").hint("shuffle_hash"), "key")


def tied(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after the written ``links`` between any ids: only the roots that links join are looked at."""
    n = links.count()
    ends, known = links, few(roots)
    for side in ("a", "b"):
        ends = ends.join(known.select(F.col("id").alias(side), F.col("root").alias(f"_{side}")), side, "left").withColumn(
            side, F.coalesce(f"_{side}", side)).drop(f"_{side}")
    joined = components(ends.where("a <> b"), few=n <= BROADCAST_ROWS)
    up = few(joined)
    moved = roots.join(up.select(F.col("id").alias("root"), F.col("root").alias("_up")), "root", "left")
    return stored(moved.select("id", F.coalesce("_up", "root").alias("root")).unionByName(joined), "roots")


def link(keys: DataFrame, verify: Callable[[DataFrame], DataFrame], enough: Column | None = None, comparable: Column | None = None,
         spare: Column | None = None, features: Callable[[DataFrame], DataFrame | None] | None = None,
         possible: Column | None = None, ratio: float | None = None) -> DataFrame:
    """Components (id, root) of items linked by any verified pair that shares a key.

    ``keys`` has key, id and, where the conditions use it, n. ``comparable`` is a condition on a
    pair, ``enough`` one on the number ``shared`` of keys a pair has in common; both may use n
    of either side as n_a and n_b, and both must hold for every pair of similar items.
    ``spare`` is the number of an item's most frequent keys that need not be compared, from its n;
    ``ratio`` the least ratio of the sizes n of similar items.
    ``features`` gets the rows of shared keys before the first call of ``verify`` and returns a
    table with id, once each, and columns on which ``possible`` decides for a pair, as name_a
    and name_b, before the pair leaves the join; it must hold for every similar pair.
    """
    sized = "n" in keys.columns
    comparable = F.lit(True) if comparable is None else comparable
    shared = shared_keys(keys, ratio)
    shared = stored(shared if spare is None else without_hottest(shared, spare), "shared")
    described = features(shared) if features is not None else None

    # first pass: an item against the centre it shares most keys with
    star = shared.where("id > centre").select("id", "centre").repartition("id").groupBy("id", "centre").agg(F.count(F.lit(1)).alias("shared"))
    best = star.groupBy("id").agg(F.max(F.struct("shared", "centre")).alias("_b"))
    first = best.select(F.col("_b.centre").alias("a"), F.col("id").alias("b"))
    if sized:
        sizes = shared.groupBy("id").agg(F.max("n").alias("n"))
        first = first.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("n_a")), "a")
        first = first.join(sizes.select(F.col("id").alias("b"), F.col("n").alias("n_b")), "b").where(comparable)
    first = stored(first.select("a", "b"), "pairs")
    links = stored(verify(first), "links")
    roots = stored(components(links, few=links.count() <= BROADCAST_ROWS), "roots")
    for read in (links, first):
        discard(read)

    # further centres for the keys that still hold several components: the greatest id, and any;
    # once a key holds one component it never holds several again, so every pass reads the last
    own = ["key", "id", "n"] if sized else ["key", "id"]
    more_columns = [c for c in described.columns if c != "id"] if described is not None else []
    left, turn = shared, 0
    while True:
        order = F.xxhash64("id", F.lit(turn)) if turn else F.col("id")
        held = left.count()
        mixed = stored(fitted(several_components(left.select(*own), roots, order), held), "mixed")
        discard(left)
        left = mixed
        star = mixed.where(F.col("root") != F.col("centre_root"))
        if sized:  # what sizes rule out goes before pairs are made distinct
            star = star.withColumns({"n_a": F.col("n"), "n_b": F.col("centre_n")}).where(comparable)
        star = stored(fitted(star.select("id", "centre", *(["n_a", "n_b"] if sized else [])).distinct(), held), "star")
        pairs, hint = star, small(star)
        if described is not None:
            for x, side in (("a", "id"), ("b", "centre")):
                pairs = hint(pairs).join(described.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{x}") for c in more_columns]), side)
            pairs = pairs.where(possible & comparable)
        pairs = pairs.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
        pairs = stored(fitted(pairs, held), "pairs")
        discard(star)
        roots, compared, found = _with_pairs(roots, pairs, verify)
        turn += 1
        if turn >= LEAST_TURNS and found * LINKED < compared or not found:
            break

    # last pass: what the same key holds in different components
    rows = several_components(left.select(*own), roots, F.col("id")).select(*own, "root")
    rows = stored(fitted(rows, left.count()), "mixed")
    discard(left)
    if described is not None:
        bare, rows = rows, stored(small(rows)(rows).join(described, "id"), "described")
        discard(bare)
    one, two = (rows.select("key", *[F.col(c).alias(f"{c}_{side}") for c in [*own[1:], "root", *more_columns]]) for side in "ab")
    fit = (F.col("id_a") < F.col("id_b")) & (F.col("root_a") != F.col("root_b")) & comparable
    pairs = one.join(two, "key").where(fit if described is None else fit & possible)
    pairs = pairs.withColumnsRenamed({"id_a": "a", "id_b": "b"})
    if enough is None:
        pairs = pairs.select("a", "b").distinct()
    else:
        pairs = pairs.groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("shared")).where(enough).select("a", "b")
    pairs = stored(pairs, "pairs")
    discard(rows)
    return _with_pairs(roots, pairs, verify)[0]


def _with_pairs(roots: DataFrame, pairs: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, int, int]:
    """``roots`` after those of the written ``pairs`` that are similar; numbers of both."""
    compared = pairs.count()
    if not compared:
        return roots, 0, 0
    links = stored(verify(pairs), "links")
    found = links.count()
    after = tied(roots, links) if found else roots
    for read in (pairs, links, *([roots] if found else [])):
        discard(read)
    return after, compared, found
