"""Tables that workers keep: what is known is not worked out again."""

import numpy as np
import public_tokenizers
import pytest

from starloom.llm import packing, pieces

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXT = "The cat, the CAT and THE dog's 12 naïve übermäßig \U0001f600 wörds. <|endoftext|x"


class Sliced(bytes):
    """A text that counts the words read from it."""

    n = 0

    def __getitem__(self, at):
        Sliced.n += isinstance(at, slice)
        return super().__getitem__(at)


def _plain(table: packing.WordIds, text: str) -> list[int]:
    return table.tokenizer.encode(text, add_special_tokens=False).ids


def test_known_words_are_not_read_from_the_text_again():
    table, text = packing.WordIds(WORDS), Sliced(TEXT.encode())
    first = table.ids([text])
    read = Sliced.n
    assert read and table.ids([text, b"", text]) == [first[0], b"", first[0]]
    assert Sliced.n == read
    assert np.frombuffer(first[0], "<u4").tolist() == _plain(table, TEXT)


def test_a_full_table_of_words_is_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "TABLE_WORDS", 6)
    table = packing.WordIds(WORDS)
    for text in ("a b c d", "c d e f g", "one two three four five six seven eight", "a c one", "", "a b c d"):
        assert np.frombuffer(table.ids([text.encode()])[0], "<u4").tolist() == _plain(table, text)
        assert (np.diff(table.hash.astype(object)) > 0).all()


def test_every_id_shows_what_the_library_decodes():
    import sentencepiece

    sp, model = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.load(PIECES)
    a = sp.piece_to_id("a")  # in front, as the library drops a space at the start
    for i, shown in enumerate(model.shown):
        if shown is not None:
            assert "a" + shown == sp.decode([a, i]) == model.decode_word([a, i])
    assert sum(s is None for s in model.shown) == 256


@pytest.mark.parametrize("text", ["", "plain words", "\U0001f600 in bytes \U0001f601\U0001f602", "a▁b  c\n\n\x01"])
def test_decoding_goes_through_the_ids(text):
    import sentencepiece

    sp, model = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.load(PIECES)
    ids = [i for w in model.merge(model.words(text)) for i in w]
    assert ids == sp.encode(text)
    assert model.decode(ids) == sp.decode(ids)
    assert model.decode([*ids[1:], *ids[:1], 5, 300]) == sp.decode([*ids[1:], *ids[:1], 5, 300])
