"""SentencePiece byte-pair encoding and decoding by vectorised merge rounds.

The distinct words of a batch lie as one flat numpy array of symbols. In every round each word
finds the smallest rank among its neighbouring pairs (a segmented minimum), all words merge
their leftmost pair of that rank at once, and the arrays are compacted; words without a pair
leave. A word is cut beforehand wherever two neighbouring characters stand side by side in no
piece, since no merge can reach across: rounds stay few however long a run without spaces is.

Words seen before in the same Python worker come from a bounded table.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from starloom.llm.arrow import held, map_texts, tidy

SPACE = "▁"
#: entries a worker keeps before it forgets all of them
TABLE_WORDS = 600_000
#: what the library writes for the unknown id (a fixed value)
UNKNOWN = " \u2047 "
NONE = np.iinfo(np.int64).max


class PieceModel:
    """Vocabulary, merge ranks and byte fallback of a sentencepiece BPE model file.

    Only models are accepted whose normalizer leaves text as it is but for the space symbol
    and the symbol put in front, and whose pieces hold the space symbol at the start alone.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "a  b\nﬁ \t"
        if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model's normalizer changes text")
        self.end, self.unknown = sp.eos_id(), sp.unk_id()
        size = sp.get_piece_size()
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.piece = [sp.id_to_piece(i) for i in range(size)]
        special = {sp.unk_id(), sp.bos_id(), sp.eos_id(), sp.pad_id(), *self.byte_id.tolist()}
        special |= {i for i in range(size) if sp.is_control(i) or sp.is_unknown(i)}
        if len(set(self.byte_id.tolist())) != 256 or any(sp.is_unused(i) for i in range(size)):
            raise ValueError("the model has no byte fallback, or pieces it never uses")
        self.ids = {self.piece[i]: i for i in range(size) if i not in special}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("pieces reach across words")
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.special = special
        self._bytes = {int(i): b for b, i in enumerate(self.byte_id)}
        # what each id shows when decoded, nothing for bytes: those are put together first
        self.shown = [None if i in self._bytes else UNKNOWN if i == self.unknown else "" if i in special else p.replace(SPACE, " ")
                      for i, p in enumerate(self.piece)]
        self.number = list(map(str, range(size)))
        self._tables()

    def _tables(self) -> None:
        # symbols: the ids of pieces, then characters that occur only inside of pieces
        names = dict(self.ids)
        for p in self.ids:
            for c in p:
                names.setdefault(c, len(self.piece) + len(names))
        self.char = np.full(0x110000, -1, np.int64)
        for p, i in names.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.width = max(names.values()) + 1
        order = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        pairs, near = {}, set()
        for p, i in self.ids.items():
            near.update((ord(a) << 21) | ord(b) for a, b in zip(p, p[1:]))
            for k in range(1, len(p)):
                a, b = names.get(p[:k]), names.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.width + b] = (order[self.score[p]], i)
        self.pair_keys = np.array(sorted(pairs) or [-1], np.int64)
        self.pair_rank = np.array([pairs[k][0] for k in self.pair_keys.tolist()] if pairs else [0])
        self.pair_made = np.array([pairs[k][1] for k in self.pair_keys.tolist()] if pairs else [0])
        self.near = np.array(sorted(near) or [-1], np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and what it becomes; NONE where no piece is made."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        found = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_rank[at], NONE), self.pair_made[at]

    def merge(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        if not len(points):
            return [[] for _ in words]
        lens = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), lens)
        joined = np.zeros(len(points), bool)
        key = (points[:-1] << 21) | points[1:]
        at = np.minimum(np.searchsorted(self.near, key), len(self.near) - 1)
        joined[1:] = (self.near[at] == key) & (word[1:] == word[:-1])
        final = self._rounds(self.char[points], ~joined)
        # final: symbol at the first character of each piece, -2 inside of one
        keep = final != -2
        ids, place, owner = final[keep], np.flatnonzero(keep), word[keep]
        raw = (ids < 0) | (ids >= len(self.piece))
        if raw.any():
            spelled = [chr(c).encode("utf-8") for c in points[place[raw]].tolist()]
            counts = np.ones(len(ids), np.int64)
            counts[raw] = [len(b) for b in spelled]
            ids, owner = np.repeat(ids, counts), np.repeat(owner, counts)
            ids[np.repeat(raw, counts)] = self.byte_id[np.frombuffer(b"".join(spelled), np.uint8)]
        ends = np.searchsorted(owner, np.arange(len(words)), side="right")
        flat, out, start = ids.tolist(), [], 0
        for end in ends.tolist():
            out.append(flat[start:end])
            start = end
        return out

    def _rounds(self, symbol: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Merge until no pair remains; ``first`` marks where segments begin."""
        final = symbol.copy()
        sym, place = symbol, np.arange(len(symbol))
        rank, made = np.full(len(sym), NONE), np.zeros(len(sym), np.int64)
        inner = np.flatnonzero(~first[1:])
        rank[inner], made[inner] = self._ranks(sym[inner], sym[inner + 1])
        starts = np.flatnonzero(first)
        while len(starts):
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(sym)))
            live = best != NONE
            if not live.all():  # words without a pair leave
                stay = np.repeat(live, sizes)
                final[place[~stay]] = sym[~stay]
                sym, place, rank, made = sym[stay], place[stay], rank[stay], made[stay]
                best, sizes = best[live], sizes[live]
                starts = np.cumsum(sizes) - sizes
                if not len(starts):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            owner = np.searchsorted(starts, hits, side="right") - 1
            at = hits[np.concatenate(([True], owner[1:] != owner[:-1]))]  # leftmost of each word
            sym[at] = made[at]
            gone = at + 1
            final[place[gone]] = -2
            rank[at] = rank[gone]  # whether a right neighbour exists is still known there
            last = np.append(starts[1:], len(sym)) - 1
            keep = np.ones(len(sym), bool)
            keep[gone] = False
            right = gone < last  # the merged symbol has a neighbour to its right
            r, m = self._ranks(sym[at[right]], sym[gone[right] + 1])
            rank[at] = NONE
            rank[at[right]], made[at[right]] = r, m
            left = at > starts
            r, m = self._ranks(sym[at[left] - 1], sym[at[left]])
            rank[at[left] - 1], made[at[left] - 1] = r, m
            sym, place, rank, made = sym[keep], place[keep], rank[keep], made[keep]
            starts = np.cumsum(sizes - 1) - (sizes - 1)
        return final

    def words(self, text: str) -> list[str]:
        """The text as words that no piece reaches across, joined again to the whole."""
        return _WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; bytes that are no UTF-8 become the replacement character each."""
        out = self.decode_word(ids)
        return out[1:] if out.startswith(" ") and self._first_is_space(ids) else out

    def _first_is_space(self, ids) -> bool:
        first = next((i for i in ids if i not in self.special or i in self._bytes or i == self.unknown), None)
        return first is not None and self.piece[first].startswith(SPACE)

    def decode_word(self, ids: list[int]) -> str:
        """Text of the ids with the space symbol in front still there."""
        parts = [self.shown[i] for i in ids]
        if None not in parts:
            return "".join(parts)
        out, run = [], bytearray()
        for i, part in zip([*ids, None], [*parts, ""]):
            if part is None:
                run.append(self._bytes[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            out.append(part)
        return "".join(out)


_WORDS = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")


def _utf8(raw: bytes) -> str:
    """Valid characters as they are, every other byte as one replacement character."""
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + n].decode("utf-8"))
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


class WordTable:
    """Bounded table of words already encoded: count of ids, ids as text, decoded text."""

    def __init__(self, model: PieceModel):
        self.model, self.known = model, {}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > TABLE_WORDS:
            self.known.clear()
            new = list(words)
        number, decode = self.model.number, self.model.decode_word
        for w, ids in zip(new, self.model.merge(new)):
            self.known[w] = (len(ids), " ".join([number[i] for i in ids]), decode(ids))


def _table(path: str) -> WordTable:
    return held(f"pieces {path}", lambda: WordTable(load(path)))


def encode_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: number of ids with the end id, digest of the ids, digest of the decoded text.

    A null text counts as empty and gives the end id alone. Repeated ids and rows stay as they
    are; other columns are not read. Rows are mapped where they lie: no shuffle.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def make():
        table = _table(path)
        end = str(table.model.end)

        def work(part):
            texts = [t or "" for t in part.column("text").to_pylist()]
            split = [table.model.words(t) for t in texts]
            table.learn(set().union(*split))
            get, counts, ids, decoded = table.known.__getitem__, [], [], []
            for words in split:
                sizes, listed, shown = zip(*map(get, words)) if words else ((), (), ())
                counts.append(sum(sizes) + 1)
                ids.append(hashlib.sha256(" ".join((*listed, end)).encode()).hexdigest())
                text = "".join(shown)[1:]  # without the symbol put in front
                decoded.append(hashlib.sha256(text.encode("utf-8")).hexdigest())
            return [part.column("doc_id"), counts, ids, decoded]

        return work

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, "text", f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id`` and the list ``ids`` with the end id; null text as empty."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def make():
        model = load(path)

        def work(part):
            split = [model.words(t or "") for t in part.column("text").to_pylist()]
            words = list(set().union(*split))
            known = dict(zip(words, model.merge(words)))
            ids = [[i for w in s for i in known[w]] + [model.end] for s in split]
            return [part.column("doc_id"), ids]

        return work

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, "text", f"doc_id {id_type}, ids array<int>", make)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: ``doc_id`` and the text of its ids; null ids give the empty text."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        model = load(path)
        for batch in batches:
            texts = [model.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(tidy(run), f"doc_id {id_type}, text string")
