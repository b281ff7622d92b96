"""Main text of long, deep and broken pages, of lists with links, and of pages full of remarks."""

import time

import pytest

from starloom.llm import html_text


@pytest.mark.parametrize("page", [
    "<div>x y." * 100_000, "<a " * 300_000, '<a "' * 250_000, '<a "' * 250_000 + '">', "<a <b " * 170_000 + '">"',
    '<a x="' * 160_000, '<a x="' * 160_000 + '">',
    "<" + "a" * 1_000_000 + "<", "<div>" * 100_000 + "<li></li>" * 50_000, "<div class=comment>text. " * 40_000,
    "".join(f"<p class=c{i}>Some text, and more.</p>" for i in range(25_000))],
    ids=["nested", "open tags", "open quotes", "open quotes and an end", "tags in tags", "open values", "open values and an end", "long name", "items", "remarks", "many paths"])
def test_work_grows_with_the_page(page):
    def seconds(text):
        best = 9e9
        for _ in range(3):
            start = time.process_time()
            html_text.main_text(text)
            best = min(best, time.process_time() - start)
        return best

    # twice the page, about twice the time: four times would be the square
    half, whole = seconds(page[: len(page) // 2]), seconds(page)
    assert whole < 10 and whole < 3.2 * half + 0.2


def test_linked_items_stay_among_items_of_text():
    page = "<body><article><p>One text here.</p><ul><li>one</li><li><a>two linked</a></li><li>three.</li></ul></article>"
    assert html_text.main_text(page) == "One text here.\n\none\n\ntwo linked\n\nthree."
    links = "<ul><li><a>here</a></li><li><a>there</a></li></ul>"
    assert html_text.main_text(f"<body><article><p>One text here.</p>{links}</article>") == "One text here."


def test_remarks_are_not_the_article_whatever_their_share():
    remarks = "<div id=comments>" + "<p>I think that is right, and so on.</p>" * 30 + "</div>"
    assert html_text.main_text(f"<body><div class=post><p>Short news.</p></div>{remarks}") == "Short news."
    wrapper = "<body><h1>Title</h1><div class='comments-on'><p>All the text of it, in full.</p><p>And more.</p></div>"
    assert html_text.main_text(wrapper).endswith("All the text of it, in full.\n\nAnd more.")


def test_markup_with_quotes_and_brackets():
    page = """<body><p title="a > b">One, <b class='x>y'>two</b> < three.</p><p data-x=it's>Four.</p><p>"Five" isn't.</p>"""
    assert "One, two < three." in html_text.main_text(page) and "isn't" in html_text.main_text(page)
