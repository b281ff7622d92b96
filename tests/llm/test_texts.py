"""Tokenizers, packing, page text and language ID against libraries and plain loops."""

import hashlib
import bisect
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from starloom.llm import html_text, language, packing, pieces, token_counts
from tests.llm.fixtures import ODD_TEXTS, PIECES, WORDS, documents, prose


def noise(n, seed=1):
    rng = random.Random(seed)
    alphabet = "ab the'sdTlv \n.,éЖ漢😀$#<>0x\t\x1c\x85\xa0́Σ|▁"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(n)]


TEXTS = ODD_TEXTS + noise(300) + [prose(2, 500)] * 2


def test_sentencepiece_equals_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r["doc_id"]: tuple(r)[1:] for r in pieces.encode_decode(documents(spark, TEXTS), PIECES).collect()}
    for i, text in enumerate(TEXTS):
        ids = [*sp.encode(text or ""), sp.eos_id()]
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), sp.decode(ids))]
        assert got[i] == (len(ids), *digests), repr(text)


def test_sentencepiece_round_trip_through_ids(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoded = pieces.encode(documents(spark, TEXTS), PIECES)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(encoded, PIECES).collect()}
    assert back == {i: sp.decode(sp.encode(t or "")) for i, t in enumerate(TEXTS)}


def test_decoding_any_ids_equals_the_library():
    sp, model, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.load(PIECES), random.Random(4)
    for _ in range(2000):
        ids = [rng.randrange(32000) if rng.random() < 0.3 else rng.randrange(300) for _ in range(rng.randint(0, 12))]
        assert model.decode(ids) == sp.decode(ids)


def test_token_counts_equal_a_unigram_model(spark):
    scores = pieces.load(PIECES).score
    vocabulary = [("<unk>", 0.0)] + [(f"<0x{b:02X}>", -1e12) for b in range(256)] + sorted(scores.items())
    unigram = Tokenizer(models.Unigram(vocabulary, 0, True))
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(documents(spark, TEXTS), PIECES).collect()}
    for i, text in enumerate(TEXTS):
        want = len(unigram.encode("▁" + text.replace(" ", "▁")).ids) if text else 0
        assert got[i] == want, repr(text)


def test_counts_do_not_depend_on_the_size_of_the_trie(monkeypatch):
    scores, words = pieces.load(PIECES).score, pieces.load(PIECES).words(" ".join(t for t in TEXTS if t))
    want = [token_counts.ScoredTrie(scores).count(w) for w in words[:300]]
    monkeypatch.setattr(token_counts, "TRIE_NODES", 5)
    monkeypatch.setattr(token_counts, "TABLE_WORDS", 5)
    small = token_counts.ScoredTrie(scores)
    assert [small.count(w) for w in words[:300]] == want


def check_packing(rows, texts, capacity=packing.CAPACITY):
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    seen, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        cut = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["length"] == len(cut) and r["ids_crc32"] == zlib.crc32(np.array(cut, "<u4").tobytes())
        assert r["start"] == r["piece"] * capacity
        seen[r["doc_id"]].append((r["piece"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i in ids:
        lengths = [n for _, n in sorted(seen[i])]
        assert sum(lengths) == len(ids[i]) and all(n == capacity for n in lengths[:-1])
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(map(len, ids.values())) // capacity)


def test_packing_holds_every_token_once(spark):
    texts = TEXTS + [prose(s, 200 * s) for s in range(1, 20)]
    used, least = check_packing(packing.pack(documents(spark, texts), WORDS).collect(), texts)
    assert used <= least + 1


def test_packing_of_hard_histograms():
    rng = random.Random(3)
    for lengths, most in (
        ([3000] * 500 + [1500] * 800 + [1096] * 300, 900),
        ([rng.randint(1, 4096) for _ in range(20_000)], None),
        ([rng.choice([1025, 1366, 2049, 700]) for _ in range(20_000)], None),
        ([4096] * 7 + [1], 8), ([], 0),
    ):
        histogram = {s: lengths.count(s) for s in set(lengths)}
        found = packing.configurations(histogram)
        held = defaultdict(int)
        for key, times in found:
            assert sum(s * n for s, n in key) <= 4096
            for s, n in key:
                held[s] += n * times
        assert dict(held) == histogram
        used = sum(times for _, times in found)
        assert most is None or used == most
        # never worse than longest first, each into the fullest sequence that has room
        room, sequences = [], 0
        for n in sorted(lengths, reverse=True):
            i = bisect.bisect_left(room, n)
            left = room.pop(i) if i < len(room) else 4096
            sequences += left == 4096
            bisect.insort(room, left - n)
        assert used <= sequences


def test_the_program_of_few_lengths_and_its_bound():
    """Four lengths of which the fewest sequences are known; the bound holds everywhere."""
    assert sum(n for _, n in packing.configurations({1500: 2000, 1300: 2000, 1296: 2000, 2100: 2000})) == 3334
    rng = np.random.default_rng(2)
    for lengths in (rng.choice([300, 450, 700, 900, 1100, 1400, 1900, 2300], 8000), rng.integers(1024, 2049, 3000),
                    np.clip(rng.lognormal(6.5, 0.9, 20_000).astype(int), 1, 4096)):
        histogram = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
        amounts, bound = packing.program(histogram, 4096)
        assert all(sum(s * n for s, n in key) <= 4096 for key in amounts)
        used = sum(n for _, n in packing.configurations(histogram))
        assert bound <= used <= sum(n for _, n in packing.best_fit(histogram, 4096))
        assert used <= 1.09 * bound
    assert packing.program({}, 4096) == ({}, 0.0) and packing.configurations({}) == []


def test_word_ids_equal_the_library():
    tokenizer, words = Tokenizer.from_file(WORDS), packing.WordIds(WORDS)
    texts = [t or "" for t in TEXTS] + noise(500, 9) + ["<|ENDOFTEXT|> x<|startoftext|>", "don't 'S 're'd ''s x's."]
    for text, got in zip(texts, words.ids([t.encode() for t in texts])):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1><a href=/>Home</a></header>
<div id="cookie-notice"><p>We use cookies, to improve, your experience. Accept.</p></div><div class="wrap">
<div class="sidebar"><p>Some long sidebar text, with punctuation, and more words. Yes it is.</p></div>
<div class="post"><h2>Title here</h2><p>First &lt;paragraph&gt; text, with several   words, and punctuation.
<p>Second paragraph has &eacute; more text, as well. And <a href=x>a link</a> inside it.</p><ul><li>one<li>two</ul></div>
<div class="comments"><h3>Comments</h3><p>Reader says, this is a great article, with many words. Thanks.</p></div>
<form><input value="x"><p>Subscribe, now, to our letter. It is great.</p></form></div><footer>c</footer>
<script>if(a<b){x="</p>"}</script></body></html>"""


def test_page_text(spark):
    pages = [PAGE, None, "", "<p>a", "just text & more <", "<div>" * 2000 + "deep, text", "<script>x", "<!-- c",
             "<article><nav>m</nav><p>A &amp; B<br>c</p><aside>no</aside><p>D</p></article><footer>f</footer>"]
    df = spark.createDataFrame([(i, f"u{i}", p, "z") for i, p in enumerate(pages * 2)], "page_id long, url string, html string, text string")
    rows = html_text.extract(df).collect()
    got = [r["text"] for r in sorted(rows)]
    assert got[: len(pages)] == got[len(pages) :]
    assert got[0] == ("Title here\n\nFirst <paragraph> text, with several words, and punctuation.\n\n"
                      "Second paragraph has é more text, as well. And a link inside it.\n\none\n\ntwo")
    assert got[1:9] == ["", "", "a", "just text & more <", "deep, text", "", "", "A & B c\n\nD"]
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("open_, close", [
    ("<div class='content has-sidebar'>", "</div>"), ("<div class='page with-widgets'>", "</div>"), ("<form id=aspnet action=/>", "</form>"),
    ("<article class='post tag-search category-legal'>", "</article>"), ("<div class='sidebar-page'><div id=banner>", "</div></div>")])
def test_wrappers_of_a_page_stay_whatever_their_name(open_, close):
    article = "<div class='entry-header'><h1>The title</h1></div>" + "".join(f"<p>Paragraph {i} has many words, and some commas, as text has.</p>" for i in range(6))
    page = f"<body>{open_}<div class=post>{article}</div><div class='comments'><p>Nice, I like it.</p></div>{close}<footer><p>Us, 2020.</p></footer></body>"
    assert html_text.main_text(page) == "\n\n".join(["The title"] + [f"Paragraph {i} has many words, and some commas, as text has." for i in range(6)])


def test_long_comments_are_not_the_article():
    said = "<p>A reader says, at length, what was said before. And again.</p>" * 9
    page = f"<body><div class=post><p>First, a text with words. It is short.</p><p>Second, a text with words.</p></div><div id=comments>{said}</div></body>"
    assert html_text.main_text(page) == "First, a text with words. It is short.\n\nSecond, a text with words."


def test_page_text_of_given_pages(spark, sf_dir):
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_text.extract(pages).collect():
        page = raw[r["page_id"]]
        article = page[page.find("<article>") + 9 : page.find("</article>")]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)


SENTENCES = {
    "en": "the quick brown fox jumps over the lazy dog and then it runs through the forest with all of its friends",
    "de": "der schnelle braune fuchs springt über den faulen hund und läuft dann mit seinen freunden durch den wald",
    "fr": "le rapide renard brun saute par-dessus le chien paresseux et il court ensuite dans la forêt avec ses amis",
}


def test_language_of_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    train, rest = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1 and n_chars > 60")
    model = language.fit(train.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared")))
    got = language.identify(rest, "doc_id", "text", model=model).collect()
    truth = {r["doc_id"]: r["lang"] for r in rest.collect()}
    assert np.mean([r["lang"] == truth[r["id"]] for r in got]) > 0.97


def test_language_evidence_and_odd_rows(spark):
    rows = [(i, " ".join(random.Random(i).sample(s.split(), 12)), lang, f"http://a.{lang}.example.{lang}/x") for i, (lang, s) in enumerate(list(SENTENCES.items()) * 20)]
    rows += [(900, None, "en", None), (901, "", None, "http://b.fr/"), (902, "12345 !!! ***", "de", "b"), (903, "Привет как дела, друзья мои и товарищи", None, None),
             (904, "on", "fr", "http://a.fr.example.fr/y"), (0, rows[0][1], "en", None), (None, rows[0][1], "en", None)]
    df = spark.createDataFrame([(*r, "z", "z") for r in rows], "doc_id long, text string, lang string, source string, id string, keep string")
    got = defaultdict(list)
    for r in language.identify(df, "doc_id", "text", "lang", "source").collect():
        got[r["id"]].append((r["lang"], r["keep"]))
    assert sum(len(g) for g in got.values()) == len(rows)
    for i, (lang, _) in enumerate(list(SENTENCES.items()) * 20):
        assert got[i][0] == (lang, True)
    assert all(got[i] == [("und", False)] for i in (900, 901, 902, 903))
    assert got[904] == [("fr", True)]  # two letters say little; its host and declaration decide
    kept = {r["doc_id"] for r in language.keep_identified(df).collect()}
    assert kept == {None, 904, *range(60)}
    assert language.keep_identified(df).columns == df.columns
    assert language.identify(df.limit(0), "doc_id", "text", "lang", "source").count() == 0


@pytest.mark.parametrize("make", [
    lambda df: pieces.encode_decode(df, PIECES), lambda df: token_counts.token_counts(df, PIECES), lambda df: packing.pack(df, WORDS)])
def test_empty_tables(spark, make):
    assert make(documents(spark, ["x"]).limit(0)).count() == 0
