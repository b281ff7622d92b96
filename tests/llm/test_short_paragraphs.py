"""Paragraphs shorter than a passage are compared by the query and the pipeline."""

from starloom.llm import queries
from tests.llm.fixtures import documents, prose


def test_short_paragraphs_are_compared(spark, tmp_path):
    import corpus_pipeline

    line, wrapped = prose(1, 31), prose(2, 7)
    near = " ".join([*line.split()[:-1], "other"])
    texts = [f"{prose(10 + s, 40)}\n{line if s < 2 else near}\n{wrapped}\none two" for s in range(3)]
    docs = documents(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spans = {(r["doc_id"], r["kind"], r["first"], r["last"], r["kept_in"]) for r in queries.op9_substring_dedup(spark, str(tmp_path)).collect()}
    assert spans == {(s, "paragraph", a, b, 0) for s in (1, 2) for a, b in ((40, 71), (71, 78))}
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.dedup_substrings(spark, docs, "").collect()}
    assert got == {0: texts[0], 1: f"{prose(11, 40)}\none two", 2: f"{prose(12, 40)}\none two"}
