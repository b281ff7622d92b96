"""Lines of a few characters are compared like any other."""

from starloom.llm import line_dedup
from tests.llm.fixtures import documents, prose


def test_short_lines_stay_once(spark):
    texts = [f"{prose(s, 20)}\nAll rights reserved\n\n全ての権利を保有します。\nOK\n\nline {s}" for s in range(4)] + ["ok\nAll rights reserve\nall right"]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(documents(spark, texts)).collect()}
    assert got[0] == (texts[0], 0)
    assert all(got[s] == (f"{prose(s, 20)}\n\n\nline {s}", 3) for s in range(1, 4))
    assert got[4] == ("all right", 2)  # equal but for case, similar, and neither
