"""Rows the tests of the training-data operators share."""

import random

import public_tokenizers

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

#: names that the operators use themselves, as further columns of the input
CLASHING = ["id", "key", "n", "a", "b", "u", "v", "root", "keys", "first", "last", "number", "host", "length", "rank",
            "score", "centre", "shared", "_gone", "_doc", "kept_in", "n_removed"]

ODD_TEXTS = [
    None, "", " ", "\n\n", "  a  b ", "x", "日本語のテキスト 漢字", "emoji 😀😃 é", "a" * 3000, "the " * 3000,
    "\x00 \x01a", "<s> </s> <|endoftext|> don't", "\t tab and wide", "▁x▁▁y", "Ünïcödé ΑΣ İ",
]


def documents(spark, texts, first=0):
    """doc_id, text, lang, source, n_chars, and the clashing columns."""
    rows = [(first + i, t, "en", "s", len(t or ""), *["z"] * len(CLASHING)) for i, t in enumerate(texts)]
    names = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {names}")


def prose(seed, words, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def edited(text, every, mark):
    words = text.split(" ")
    words[every // 2 :: every] = [f"{mark}{i}" for i in range(len(words[every // 2 :: every]))]
    return " ".join(words)
