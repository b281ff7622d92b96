"""Token counts of a unigram segmentation, from forward scores in a trie of pre-tokens.

Each distinct pre-token is inserted into a trie. A node stands for a prefix and holds the best
forward score of that prefix and the number of tokens on that best path; both follow from nodes
further up, one for each vocabulary piece that ends here, and so are computed once for all
pre-tokens that share the prefix. The node where a pre-token ends holds its count. A text's
count is the sum over its pre-tokens, since no piece reaches across two of them.

Scores are those of the vocabulary file. Among equal scores the path whose last piece starts
first wins. A character in no piece costs ten less than the lowest score and counts its bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.llm.arrow import held, map_texts
from starloom.llm.pieces import load

#: nodes and pre-tokens a worker keeps before it begins anew; counts do not depend on it
TRIE_NODES, TABLE_WORDS = 1_000_000, 1_500_000
#: a character without a piece costs so much more than the lowest score (a fixed value)
UNKNOWN_PENALTY = 10.0


class ScoredTrie:
    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        # only so many characters back can a piece start that ends in a given character
        self.reach: dict[str, int] = {}
        for piece in scores:
            self.reach[piece[-1]] = max(len(piece), self.reach.get(piece[-1], 1))
        self.counts: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best, self.tokens = [0.0], [0]

    def count(self, word: str) -> int:
        """Tokens of one pre-token; walks along known prefixes and adds the missing nodes."""
        known = self.counts.get(word)
        if known is not None:
            return known
        if len(self.counts) >= TABLE_WORDS:
            self.counts.clear()
        if len(self.best) >= TRIE_NODES:
            self._clear()
        if len(word) > TRIE_NODES:  # a word longer than a whole trie leaves no nodes behind
            return self._long(word)
        path, node, best, tokens = [0], 0, self.best, self.tokens
        for end in range(1, len(word) + 1):
            key = (node, word[end - 1])
            node = self.child.get(key, -1)
            if node < 0:
                back = self._back(word, end)
                above = path[-back:]
                score, count = self._forward(word, end, [best[n] for n in above], [tokens[n] for n in above])
                node = self.child[key] = len(best)
                best.append(score)
                tokens.append(count)
            path.append(node)
        self.counts[word] = tokens[node]
        return tokens[node]

    def _back(self, word: str, end: int) -> int:
        return min(end, self.reach.get(word[end - 1], 1))

    def _forward(self, word: str, end: int, best: list[float], tokens: list[int]) -> tuple[float, int]:
        """Best score and token count of ``word[:end]``; ``best`` and ``tokens`` belong to the
        prefixes where a last piece can start, the shortest first."""
        top, count, scores = None, 0, self.scores
        start = end - len(best)
        for back, before in enumerate(best):
            score = scores.get(word[start + back : end])
            if score is None:
                continue
            if top is None or before + score > top:
                top, count = before + score, tokens[back] + 1
        char = word[end - 1]
        if char not in scores and (top is None or best[-1] + self.unknown > top):
            top, count = best[-1] + self.unknown, tokens[-1] + len(char.encode("utf-8"))
        return top, count

    def _long(self, word: str) -> int:
        best, tokens = [0.0], [0]
        keep = max(self.reach.values())
        for end in range(1, len(word) + 1):
            back = self._back(word, end)
            score, count = self._forward(word, end, best[-back:], tokens[-back:])
            best.append(score)
            tokens.append(count)
            if len(best) > 4 * keep:
                del best[:-keep], tokens[:-keep]
        return tokens[-1]


def _trie(path: str) -> ScoredTrie:
    return held(f"trie {path}", lambda: ScoredTrie(load(path).score))


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words`` (pre-tokens) and ``n_tokens``.

    Null and empty texts have none of either. Repeated ids and rows stay as they are; other
    columns are not read. Rows are mapped where they lie: no shuffle.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def make():
        words_of, trie = load(path).words, _trie(path)

        def work(part):
            n_words, n_tokens = [], []
            for text in part.column("text").to_pylist():
                words = words_of(text or "")
                known = trie.counts
                got = [known.get(w) for w in words]
                if None in got:
                    got = [trie.count(w) if g is None else g for w, g in zip(words, got)]
                n_words.append(len(words))
                n_tokens.append(sum(got))
            return [part.column("doc_id"), n_words, n_tokens]

        return work

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_texts(rows, "text", f"doc_id {id_type}, n_words bigint, n_tokens bigint", make)
