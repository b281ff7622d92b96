"""Languages of few rows are modelled, and unknown declared ones kept."""

from starloom.llm import language
from tests.llm.test_texts import SENTENCES

RUSSIAN = "привет как дела друзья мои и товарищи мы идем в лес с нашими детьми"


def test_a_language_of_few_rows_is_modelled_and_an_unknown_one_kept(spark):
    rows = [(i, SENTENCES["en"], "en") for i in range(900)] + [(1000 + i, RUSSIAN, "ru-RU") for i in range(4)]
    rows += [(2000, "καλημέρα σε όλους τους φίλους μου και στα παιδιά", "el"), (2001, "123 !!", "el"), (2002, RUSSIAN, None),
             (2003, "καλημέρα σε όλους τους φίλους μου και στα παιδιά", None), (2004, "ωωω ψψψ ξξξ ωωω ψψψ ξξξ", "und")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, source string")
    names, _ = language.fit(df.selectExpr("doc_id as id", "text", "lang as declared"), sample=20)
    assert names == ["en", "ru", language.UNDETERMINED]
    got = {r["id"]: (r["lang"], r["keep"]) for r in language.identify(df, "doc_id", "text", "lang", "source").collect()}
    assert all(got[1000 + i] == ("ru", True) for i in range(4)) and got[2002] == ("ru", True)
    assert got[2000] == ("el", True)
    assert all(got[i] == ("und", False) for i in (2001, 2003, 2004))
    kept = {r["doc_id"] for r in language.keep_identified(df).collect()}
    assert kept == {r[0] for r in rows} - {2001, 2003, 2004}
