"""Rows that share an id but not the text."""

from starloom.llm import ngram_join, substring_dedup
from tests.llm.fixtures import edited, prose


def test_texts_under_one_id(spark):
    passage, other = prose(1, 60), "zz " + prose(2, 90)
    texts = [(0, passage), (5, f"a {prose(3, 30)} {passage}"), (5, other), (6, prose(4, 50))]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in substring_dedup.dedup_substrings(df).collect())
    assert [t for t in got if t[0] != 5] == [texts[0], texts[3]]
    assert got[2] == (5, other) and len(got[1][1].split()) <= 31 + 18


def test_near_copies_of_the_set_a_copying_id_holds(spark):
    a, b = prose(1, 50), prose(2, 200)
    rows = [(3, a), (5, a), (5, b), (8, edited(b, 150, "x"))]
    got = {(r["doc_id"], r["component_id"]) for r in ngram_join.similarity_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(3, 3), (5, 3), (8, 3)}
