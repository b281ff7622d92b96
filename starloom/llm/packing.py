"""Best-fit packing of token sequences by a configuration linear program.

A configuration is a multiset of lengths that fits one sequence. The linear program asks for the
fewest configurations that cover the length histogram. It is solved by multiplicative weights:
each length has a price that falls as it is covered, and in every round the dearest configurations
are found by knapsack dynamic programming and taken in fractional amounts; the prices also give a
lower bound on any packing. Rounding keeps the whole part of every amount; what that leaves is
packed best-fit, longest first, on the histogram. A greedy fill by the same tables and best fit
alone are tried as well, and the fewest sequences win.

Spark tokenizes, cuts and counts; the program itself sees only the histogram, which has at most
``capacity`` entries however many documents there are, and yields at most a few thousand
configurations. Each piece then gets a number among the pieces of its length, and that number
names its place.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from starloom.llm import hashing
from starloom.llm.arrow import held, map_texts, stored, tidy

CAPACITY, END_ID = 4096, 1
#: share of the rest that a round must cover to go on, rounds of multiplicative weights, share of
#: a length taken per round, decay of its weight, lengths priced per round
STALL = 1e-3
ROUNDS, STEP, DECAY, PRICED = 120, 0.5, 6.0, 256
#: the program: rounds at most, rate of the prices, lengths that get a configuration of their own
#: in a round, share of the bound at which it stops
MW_ROUNDS, RATE, FORCED, GAP = 120, 0.1, 48, 0.002
#: share of the best weight that one step of a configuration may lose
SLACK = 1e-4
#: how much more a token of the longest length is worth: short pieces are kept for filling up
CONVEX = 0.2
#: words, and parts of words, a worker keeps before it forgets all of them
TABLE_WORDS = 1_000_000

# --- ids -----------------------------------------------------------------------------------

# how the tokenizer itself cuts lower-cased ASCII text (a fixed value)
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\r0-9a-z]+")


class WordIds:
    """Words, named by their hashes, to their ids, filled a batch of texts at a time; bounded.

    Words are what lies between ASCII white space: the tokenizer never joins across it. Letter
    case A-Z does not count, as the tokenizer lowers it. Within words the letter runs are looked up by themselves, since most new words are
    known ones with a capital or a comma. New runs of letters are tokenized as one text; each
    ends with the one token that ends a word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()
        self.parts: dict[str, bytes] = {}
        self.special = tuple(t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values())
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _forget(self) -> None:
        # hashes of the words, ascending; where their ids begin in ``flat``, and how many they are
        self.hash, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, word: str) -> list[str]:
        if word.isascii():
            return [word] if word.isalpha() else _PARTS.findall(word)
        if word[-1] in ".," and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return [word]

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Take in words that are not known, by ascending hash."""
        cut = [self._cut(w) for w in words]
        parts = set(itertools.chain.from_iterable(cut)).difference(self.parts)
        if len(self.parts) + len(parts) > TABLE_WORDS:
            self.parts.clear()
            parts = set(itertools.chain.from_iterable(cut))
        plain = [p for p in parts if p.isalpha()]
        rest = parts.difference(plain)
        if plain:
            ids = np.frombuffer(self._encode([" ".join(plain)])[0], "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(plain) and stops[-1] == len(ids):
                raw, starts = ids.tobytes(), [0, *stops[:-1].tolist()]
                self.parts.update({p: raw[4 * a : 4 * b] for p, a, b in zip(plain, starts, stops.tolist())})
            else:
                rest = parts
        rest = list(rest)
        self.parts.update(zip(rest, self._encode(rest)))
        get = self.parts.__getitem__
        known = [get(c[0]) if len(c) == 1 else b"".join(map(get, c)) for c in cut]
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        start = len(self.flat) + np.cumsum(size) - size
        at = np.searchsorted(self.hash, hashes)
        self.flat = np.concatenate((self.flat, np.frombuffer(b"".join(known), "<u4")))
        self.hash, self.start, self.size = np.insert(self.hash, at, hashes), np.insert(self.start, at, start), np.insert(self.size, at, size)

    def _unknown(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the hashes that are not in the table."""
        if not len(self.hash):
            return np.arange(len(hashes))
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.flatnonzero(self.hash[at] != hashes)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text. Every distinct word of the batch is looked up once."""
        words = hashing.words(texts)
        if not len(words.hash):
            return [b""] * len(texts)
        hashes, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        new = self._unknown(hashes)
        if len(self.hash) + len(new) > TABLE_WORDS:
            self._forget()
            new = np.arange(len(hashes))
        if len(new):
            at = first[new]
            places = zip(words.row[at].tolist(), words.start[at].tolist(), words.end[at].tolist())
            self._learn(hashes[new], [str(texts[r][a:b].lower(), "utf-8") for r, a, b in places])  # ASCII case only
        at = np.searchsorted(self.hash, hashes)[which]
        flat, starts, counts = self.flat, self.start[at], self.size[at]
        ends = np.cumsum(counts)
        out = flat[np.arange(int(ends[-1])) + np.repeat(starts - (ends - counts), counts)]
        bounds = np.concatenate(([0], ends))[words.first]
        made = [out[a:b].tobytes() for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
        for i, text in enumerate(texts):
            low = text.lower() if b"<" in text else b""
            if any(s in low for s in self.special):  # a special token's name, whatever its case
                made[i] = self._encode([str(text, "utf-8")])[0]
        return made


def _words(path: str) -> WordIds:
    return held(f"words {path}", lambda: WordIds(path))


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece, with ``_part`` and ``_rank``: the task and the number of the piece
    among the pieces of its length in that task."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def make():
        from pyspark import TaskContext

        words, end = _words(path), np.array([end_id], "<u4").tobytes()
        here, seen, width = TaskContext.get().partitionId(), Counter(), 4 * capacity

        def work(part):
            out = []
            texts = hashing.raw_texts(part.column("text"))
            for doc, ids in zip(part.column("doc_id").to_pylist(), words.ids(texts)):
                ids += end
                for n, at in enumerate(range(0, len(ids), width)):
                    cut = ids[at : at + width]
                    length = len(cut) // 4
                    out.append((doc, n, at // 4, length, zlib.crc32(cut), here, seen[length]))
                    seen[length] += 1
            return list(zip(*out))

        return work

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, "text", f"doc_id {id_type}, piece int, start bigint, length bigint, "
                                   "ids_crc32 bigint, _part int, _rank bigint", make)


# --- the program on the histogram ------------------------------------------------------------

def knapsack(sizes: np.ndarray, weights: np.ndarray, capacity: int) -> np.ndarray:
    """Largest total weight for every room up to ``capacity``, sizes used any number of times."""
    value = np.zeros(capacity + 1)
    for s, w in zip(sizes.tolist(), weights.tolist()):
        for lo in range(s, capacity + 1, s):  # within a stretch of s no entry feeds another
            hi = min(lo + s, capacity + 1)
            np.maximum(value[lo:hi], value[lo - s : hi - s] + w, out=value[lo:hi])
    return value


def _filled(value: np.ndarray, sizes: np.ndarray, weights: np.ndarray, left: np.ndarray, room: int) -> list[int]:
    """Sizes that reach the largest weight in ``room`` but for ``SLACK`` a step, among equals
    those of which most is left; ``sizes`` ascend."""
    out = []
    while room >= sizes[0]:
        n = int(np.searchsorted(sizes, room, side="right"))
        gain = value[room - sizes[:n]] + weights[:n]
        good = np.where(gain >= (1 - SLACK) * value[room], left[:n], -1.0)
        i = int(good.argmax())
        if good[i] < 0:
            room -= 1  # this much room is not used up
            continue
        out.append(int(sizes[i]))
        room -= int(sizes[i])
    return out


def solve(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> dict[tuple, float]:
    """Amounts of configurations filled greedily; no length is covered beyond its count.

    One table of the dynamic program prices a whole round: for each length in it, the best
    configuration that holds this length is taken, the lengths that lag behind first.
    """
    sizes = np.array(sorted(histogram), np.int64)
    count = np.array([histogram[s] for s in sizes.tolist()], float)
    left, amounts = count.copy(), {}
    at = {s: i for i, s in enumerate(sizes.tolist())}
    for _ in range(rounds):
        live = np.flatnonzero(left > 1e-6 * count)
        if not len(live):
            break
        if len(live) > PRICED:
            mass = left[live] * sizes[live]
            live = np.sort(live[np.argpartition(-mass, PRICED)[:PRICED]])
        covered = 1 - left[live] / count[live]
        weight = sizes[live] * (1 + CONVEX * sizes[live] / capacity + 0.02 * np.exp(-DECAY * covered))
        before = left[live].sum()
        value = knapsack(sizes[live], weight, capacity)
        for forced in live[np.argsort(covered, kind="stable")].tolist():
            size = int(sizes[forced])
            key = tuple(sorted(Counter([size, *_filled(value, sizes[live], weight, left[live], capacity - size)]).items()))
            amount = min(left[at[s]] / n for s, n in key)
            amount = amount if amount <= 2 else STEP * amount
            if amount < 1e-6:
                continue
            amounts[key] = amounts.get(key, 0.0) + amount
            for s, n in key:
                left[at[s]] -= n * amount
        if left[live].sum() > (1 - STALL) * before:
            break
    return amounts


def _priced(value: np.ndarray, sizes: np.ndarray, prices: np.ndarray, room: int) -> list[int]:
    """Numbers of the sizes of a dearest configuration that fits in ``room``."""
    out = []
    while room >= sizes[0]:
        n = int(np.searchsorted(sizes, room, side="right"))
        gain = value[room - sizes[:n]] + prices[:n]
        i = int(gain.argmax())
        if gain[i] < value[room] * (1 - 1e-12):
            room -= 1  # this much room is not used up
            continue
        out.append(i)
        room -= int(sizes[i])
    return out


def program(histogram: dict[int, int], capacity: int, rounds: int = MW_ROUNDS) -> tuple[dict[tuple, float], float]:
    """Amounts of configurations that cover every length, and a lower bound on any packing.

    Multiplicative weights: a length's price falls by the factor exp(-RATE * what a step covers
    of it). Each round one knapsack table gives the dearest configuration under the prices, and
    the dearest ones that hold the lengths covered least; those whose price is near the dearest
    are taken, as much of each as covers one of its lengths. Prices over the dearest
    configuration's price are a feasible dual, hence the bound, of which the best is kept.
    """
    sizes = np.array(sorted(histogram), np.int64)
    count = np.array([histogram[s] for s in sizes.tolist()], float)
    log_price, cover, amounts, bound = np.log(sizes / capacity), np.zeros(len(sizes)), {}, 0.0
    for _ in range(rounds if len(sizes) else 0):
        prices = np.exp(log_price - log_price.max())
        value = knapsack(sizes, prices, capacity)
        bound = max(bound, float(count @ prices / value[capacity]))
        if cover.min() > 0 and sum(amounts.values()) / cover.min() <= (1 + GAP) * bound:
            break
        for i in [None, *np.argsort(cover, kind="stable")[:FORCED].tolist()]:
            held_ = _priced(value, sizes, prices, capacity - (0 if i is None else int(sizes[i])))
            at, n = np.unique(held_ if i is None else [*held_, i], return_counts=True)
            if i is not None and prices[at] @ n < (1 - RATE) * value[capacity]:
                continue
            amount = float((count[at] / n).min())
            key = tuple(zip(sizes[at].tolist(), n.tolist()))
            amounts[key] = amounts.get(key, 0.0) + amount
            cover[at] += amount * n / count[at]
            log_price[at] -= RATE * amount * n / count[at]
    least = cover.min() if len(sizes) else 1.0
    scale = least if least > 0 else max(cover.max(), 1.0)
    return {k: v / scale for k, v in amounts.items()}, bound


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple, int]]:
    """Longest first, each time the longest that still fits; whole runs of equal sequences at
    once, so the work follows the number of lengths."""
    left = {s: n for s, n in histogram.items() if n > 0}
    order, out = sorted(left), []
    while order:
        found, room = Counter(), capacity
        while True:
            i = bisect.bisect_right(order, room) - 1
            while i >= 0 and found[order[i]] >= left[order[i]]:
                i -= 1
            if i < 0:
                break
            take = min(room // order[i], left[order[i]] - found[order[i]])
            found[order[i]] += take
            room -= take * order[i]
        times = min(left[s] // n for s, n in found.items())
        out.append((tuple(sorted(found.items())), times))
        for s, n in found.items():
            left[s] -= n * times
            if not left[s]:
                del order[bisect.bisect_left(order, s)]
    return out


def _whole(amounts: dict[tuple, float], histogram: dict[int, int], capacity: int) -> list[tuple[tuple, int]]:
    """Whole parts of the amounts, the rest by best fit."""
    left, out = Counter(histogram), []
    for key, amount in sorted(amounts.items(), key=lambda kv: (-kv[1], kv[0])):
        times = min([int(amount + 1e-6)] + [left[s] // n for s, n in key])
        if times > 0:
            out.append((key, times))
            for s, n in key:
                left[s] -= n * times
    return out + best_fit(left, capacity)


def configurations(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """Whole amounts of configurations that hold every piece exactly once: those of the program,
    of the greedy fill or of best fit alone, whichever are the fewest."""
    left, full = {s: n for s, n in histogram.items() if n > 0}, []
    if left.get(capacity):
        full.append((((capacity, 1),), left.pop(capacity)))
    amounts, bound = program(left, capacity)
    tried = [best_fit(left, capacity)]
    for made in (lambda: amounts, lambda: solve(left, capacity)):
        if min(map(_sequences, tried)) > math.ceil(bound - 1e-6):  # else none can be better
            tried.append(_whole(made(), left, capacity))
    return full + min(tried, key=_sequences)


def _sequences(found: list[tuple[tuple, int]]) -> int:
    return sum(times for _, times in found)


def slots(found: list[tuple[tuple, int]]) -> dict[int, np.ndarray]:
    """Per length the runs of places: first piece number, first sequence, copies in a
    sequence, offset of the first copy."""
    runs, used, sequence = {}, Counter(), 0
    for key, times in found:
        offset = 0
        for size, n in sorted(key, reverse=True):
            runs.setdefault(size, []).append((used[size], sequence, n, offset))
            used[size] += n * times
            offset += n * size
        sequence += times
    return {s: np.array(r, np.int64) for s, r in runs.items()}


def pack(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all rows into sequences of at most ``capacity`` tokens.

    Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty
    texts are the end id alone. Longer texts are cut into pieces of ``capacity``; no other is
    cut. Repeated ids and rows are packed one by one. Clashing extra columns are not read. An
    empty table gives no rows.
    """
    made = stored(pieces(df, path, capacity, end_id, id_col, text_col), "pieces")
    by_part = made.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counted = stored(by_part.select("length", "_part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "lengths")
    # at most one row per length
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(configurations(histogram, capacity))

    def place(batches):
        import pyarrow as pa

        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for at in np.split(order, cuts) if len(order) else []:
                size = int(length[at[0]])
                runs = places[size]
                run = runs[np.searchsorted(runs[:, 0], rank[at], side="right") - 1]
                nth = rank[at] - run[:, 0]
                sequence[at] = run[:, 1] + nth // run[:, 2]
                offset[at] = run[:, 3] + nth % run[:, 2] * size
            columns = [batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    numbered = made.join(counted.drop("n"), ["length", "_part"]).select(
        *names, (F.col("base") + F.col("_rank")).alias("number"))
    id_type = made.schema["doc_id"].dataType.simpleString()
    return numbered.mapInArrow(tidy(place), f"doc_id {id_type}, piece int, start bigint, length bigint, "
                                      "ids_crc32 bigint, sequence_id bigint, offset bigint")
