"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each under its path of tags from the root. Per path the text
length, punctuation and linked text of its blocks are summed; the ratios per block are smoothed
along the tree (a path takes part of what its parent's other paths have), fused, and paths above
a share of the page's best are content paths. The smallest subtree that holds nearly all content
is the article; its blocks, headings and short lines included, are the main text. Subtrees that
by their tag or their declared name are menus, notices and the like are left out first, but not
one that holds most of the page's unlinked text: that is a wrapper of the page, whatever its name
or form, unless an article stands outside of it.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame, functions as F

from starloom.llm.arrow import map_texts

# fixed values: tags of the markup language, by role
RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes"}
DROPPED = {
    "head", "script", "style", "noscript", "template", "title", "textarea", "iframe", "object", "embed",
    "svg", "math", "canvas", "audio", "video", "map", "nav", "footer", "aside", "menu", "dialog",
    "button", "select", "option", "datalist", "input", "xmp", "noembed", "noframes",
}
# left out unless they hold most of the page
DOUBTED = {"form", "fieldset", "label"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
    "sup", "time", "tt", "u", "var", "img", "wbr", "nobr", "center",
}
# a start tag of the key ends an open element of the values
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "body": {"head"},
}
LIST_ROOTS = {"ul", "ol", "dl", "table"}
# words in class, id or role that name what is not the article
NAMED = {
    "nav", "navbar", "navigation", "menu", "menubar", "sidebar", "sidenav", "aside", "footer", "masthead", "banner",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "ad", "ads", "adv", "advert",
    "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "comment", "comments",
    "reply", "replies", "respond", "disqus", "share", "sharing", "social", "related", "recommended", "breadcrumb",
    "breadcrumbs", "newsletter", "subscribe", "subscription", "signup", "popup", "modal", "overlay", "login", "search",
    "pagination", "pager", "widget", "widgets", "copyright", "legal", "disclaimer", "skip", "toolbar", "contentinfo",
    "complementary", "header", "topbar", "paywall", "tags", "toc", "feedback",
}
# what readers say may be longer than the article
REMARKS = {"comment", "comments", "reply", "replies", "respond", "disqus"}
# first words of class names that tell of the page or its subject, and words that make a header the article's own
MODIFIERS = {"has", "with", "without", "no", "tag", "category", "cat"}
OWN_HEADER = {"entry", "post", "article", "story", "content"}
ROOTS = {"html", "body", "main", "article"}

#: share of the smoothed best a path must reach, weight of the neighbours in smoothing, share of
#: content the article's subtree must hold
THRESHOLD, SMOOTH, SHARE = 0.2, 0.3, 0.9
#: share of the page's unlinked text beyond which a subtree stays in spite of its name
WRAPS = 0.5

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_BROKEN = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)([^<>]*+)(?:>|$)")
_PLAIN = re.compile(r"""[^>"']*+""")
_OTHER = re.compile(r"<!--.*?(?:-->|$)|<[!?/][^>]*(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style|type)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/>]|$)""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SENTENCE = re.compile(r"[.!?…。！？]")
_PUNCT = re.compile(r"[.,;:!?…。，！？、]")


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(raw)} if raw.strip() else {}


def _hidden(attributes: dict[str, str]) -> bool:
    hidden = "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
    return hidden or "display:none" in attributes.get("style", "").replace(" ", "").lower()


def _names(tag: str, attributes: dict[str, str], inside: bool) -> set[str]:
    """Words of the declared name that say that this is not the article."""
    if tag in ROOTS and tag != "article":
        return set()
    found = set()
    for token in (t for k in ("class", "id", "role") for t in attributes.get(k, "").split()):
        words = [w.lower() for w in _WORD.findall(token)]
        if words and words[0] in MODIFIERS and len(words) > 1:
            continue
        hits = NAMED.intersection(words)
        if inside or OWN_HEADER.intersection(words):
            hits.discard("header")
        found |= hits
    return found


HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
LEAVES = HEADINGS | {
    "p", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "table",
    "tr", "td", "th", "figure", "figcaption", "address", "details", "summary", "hgroup", "caption",
}


class _Paths:
    """Paths of tags as numbered nodes, parents before children; node 0 is the empty path."""

    def __init__(self):
        self.parent, self.name, self.depth, self.numbers = [0], [""], [0], {}

    def below(self, node: int, name: str) -> int:
        found = self.numbers.setdefault((node, name), len(self.parent))
        if found == len(self.parent):
            self.parent.append(node)
            self.name.append(name)
            self.depth.append(self.depth[node] + 1)
        return found

    def tag(self, node: int) -> str:
        return self.name[node].split(".")[0].split("#")[0]


class _Page:
    """Walks the markup once and keeps (path, text, linked characters) of every block, with the
    innermost doubtful subtree it is in and whether it is part of an article."""

    def __init__(self):
        self.paths = _Paths()
        self.found: list[tuple[int, str, int, int, bool]] = []
        # tag, path, dropped from here, doubtful subtree, within an article; how often a tag is open
        self.stack: list[tuple[str, int, bool, int, bool]] = []
        self.open: dict[str, int] = {}
        # of each doubtful subtree the one around it, whether it holds remarks, whether it is part of an article
        self.doubts: list[tuple[int, bool, bool]] = []
        self.text: list[str] = []
        self.linked, self.in_link = 0, 0
        # quotes met in a tag without an end, and the last run without quotes or ends
        self.unclosed: set[int] = set()
        self.run = (0, -1)

    @property
    def top(self) -> tuple[str, int, bool, int, bool]:
        return self.stack[-1] if self.stack else ("", 0, False, -1, False)

    def leave(self, least: int) -> None:
        """Close all elements from place ``least`` of the stack on."""
        while len(self.stack) > least:
            self.open[self.stack.pop()[0]] -= 1

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            _, path, _, doubt, inside = self.top
            self.found.append((path, text, self.linked, doubt, inside))
        self.text, self.linked = [], 0

    def blocks(self) -> list[tuple[int, str, int]]:
        """Blocks outside of doubtful subtrees, but for those that hold most unlinked text; readers'
        remarks stay only where no sentence stands outside of all doubtful subtrees."""
        total, held, article, sentence = 0, [0] * len(self.doubts), False, False
        for path, text, linked, doubt, inside in self.found:
            own = max(len(text) - linked, 0)
            total += own
            if doubt >= 0:
                held[doubt] += own
            elif own:
                article = article or inside
                sentence = sentence or self.paths.tag(path) not in HEADINGS and bool(_SENTENCE.search(text))
        for d in range(len(held) - 1, -1, -1):
            if self.doubts[d][0] >= 0:
                held[self.doubts[d][0]] += held[d]
        stays = []
        for h, (around, remarks, inside) in zip(held, self.doubts):
            good = h > WRAPS * total and (inside or not article) and not (remarks and sentence)
            stays.append(good and (around < 0 or stays[around]))
        return [b[:3] for b in self.found if b[3] < 0 or stays[b[3]]]

    def data(self, raw: str) -> None:
        if raw and not self.top[2]:
            self.text.append(entities.unescape(raw))
            if self.in_link:
                self.linked += len(raw)

    def start(self, tag: str, raw: str) -> None:
        if tag == "br" or tag == "hr":
            self.text.append(" ")
        if tag == "a":
            self.in_link = 1
        if tag in VOID:
            return
        attributes = _attributes(raw)
        inside = self.top[4]
        # inline elements count as part of the text unless they are hidden or named as noise
        names, hidden = _names("span" if tag in INLINE else tag, attributes, inside), _hidden(attributes)
        if tag in INLINE and not names and not hidden:
            return
        self.flush()
        if tag not in INLINE and self.top[0] == "p":
            self.leave(len(self.stack) - 1)
        ends = CLOSES.get(tag, ())
        while self.stack and self.top[0] in ends:
            self.leave(len(self.stack) - 1)
        if tag == "li" and self.open.get("li"):  # an item left open ends with the next one of the same list
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in LIST_ROOTS:
                    break
                if self.stack[i][0] == "li":
                    self.leave(i)
                    break
        _, path, dropped, doubt, inside = self.top
        away = dropped or tag in DROPPED or hidden and (tag not in ROOTS or tag == "article") or (tag == "header" and not inside)
        if not away and (names or tag in DOUBTED):
            self.doubts.append((doubt, bool(names & REMARKS), inside))
            doubt = len(self.doubts) - 1
        label = ".".join([tag, *attributes.get("class", "").split()[:2]]) + ("#" + attributes["id"] if attributes.get("id") else "")
        self.stack.append((tag, self.paths.below(path, label), away, doubt, inside or tag in ("article", "main")))
        self.open[tag] = self.open.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = 0
        if self.open.get(tag):
            self.flush()
            while self.top[0] != tag:
                self.leave(len(self.stack) - 1)
            self.leave(len(self.stack) - 1)
        elif tag == "p" or tag == "br":
            self.text.append(" ")

    def tag_end(self, page: str, at: int) -> int:
        """Place of the > that ends a tag whose name ended at ``at``, outside of quotes; -1 if none.
        No place is passed twice in vain: the quotes met on the way to no end are kept."""
        opened = []
        while True:
            if not self.run[0] <= at <= self.run[1]:
                self.run = (at, _PLAIN.match(page, at).end())
            at = self.run[1]
            if at < len(page) and page[at] == ">":
                return at
            if at >= len(page) or at in self.unclosed:
                break
            opened.append(at)
            before = at - 1
            while page[before].isspace():
                before -= 1
            if page[before] != "=":  # a quote opens only a value
                at += 1
                continue
            close = page.find(page[at], at + 1)
            if close < 0:
                break
            at = close + 1
        self.unclosed.update(opened)
        return -1

    def feed(self, page: str) -> None:
        at, size = 0, len(page)
        while at < size:
            lt = page.find("<", at)
            if lt < 0:
                self.data(page[at:])
                break
            if lt > at:
                self.data(page[at:lt])
            name = _OPEN.match(page, lt)
            close = self.tag_end(page, name.end()) if name else -1
            if close >= 0:
                closing, tag, raw, after = name[1], name[2], page[name.end() : close], close + 1
            elif name and (found := _BROKEN.match(page, lt)):
                closing, tag, raw, after = found[1], found[2], found[3], found.end()
            else:
                found = _OTHER.match(page, lt)
                if found and found.end() > lt:
                    at = found.end()
                else:
                    self.data("<")
                    at = lt + 1
                continue
            tag, at = tag.lower(), after
            if closing:
                self.end(tag)
                continue
            self.start(tag, raw)
            if tag in RAW and not raw.endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(page, at) if tag.isalnum() else None
                at = end.end() if end else size
                self.end(tag)
        self.flush()


def _content_paths(sums: dict[int, list[float]], paths: _Paths) -> set[int]:
    """Paths whose smoothed, fused ratios reach the threshold. ``sums`` has characters,
    punctuation, linked characters and blocks of every path."""
    ratio = {path: (chars - linked) / n * (1 + puncts / n) for path, (chars, puncts, linked, n) in sums.items()}
    around: dict[int, list[float]] = {}
    for path, r in ratio.items():
        near = around.setdefault(paths.parent[path], [0.0, 0])
        near[0] += r
        near[1] += 1
    smooth = {}
    for path, r in ratio.items():
        total, n = around[paths.parent[path]]
        smooth[path] = (1 - SMOOTH) * r + SMOOTH * total / n
    top = max(smooth.values(), default=0.0)
    return {p for p, s in smooth.items() if top > 0 and s >= THRESHOLD * top}


def _article(sums: dict[int, list[float]], content: set[int], paths: _Paths) -> int:
    """The longest path that still holds nearly all characters under content paths."""
    sizes = [0] * len(paths.parent)
    for path in content:
        sizes[path] = sums[path][0]
    best: dict[int, tuple] = {}
    for node in range(len(sizes) - 1, 0, -1):
        if sizes[node]:
            above = paths.parent[node]
            sizes[above] += sizes[node]
            best[above] = max(best.get(above, (0, "", 0)), (sizes[node], paths.name[node], node))
    root = 0
    # a single kind of block, such as all paragraphs, is not a subtree of its own
    while root in best and best[root][0] >= SHARE * sizes[0] and paths.tag(best[root][2]) not in LEAVES:
        root = best[root][2]
    return root


def main_text(page: str | None) -> str:
    """Main text of one page: blocks in page order, joined by an empty line. The work is in
    proportion to the page, however deep its tags or broken its markup."""
    if not page:
        return ""
    walk = _Page()
    walk.feed(page)
    blocks, paths = walk.blocks(), walk.paths
    sums: dict[int, list[float]] = {}
    for path, text, linked in blocks:
        s = sums.setdefault(path, [0, 0, 0, 0])
        s[0] += len(text)
        s[1] += len(_PUNCT.findall(text))
        s[2] += min(linked, len(text))
        s[3] += 1
    content = _content_paths(sums, paths)
    if not content:
        return "\n\n".join(text for path, text, linked in blocks if linked < len(text))
    root = _article(sums, content, paths)
    found = paths.tag(root) not in ("", "html", "body")
    # below the root, and there within a list item
    inside, item = [False] * len(paths.parent), [False] * len(paths.parent)
    for node in range(len(inside)):
        above = paths.parent[node]
        inside[node] = node == root or node > 0 and inside[above]
        item[node] = inside[node] and node != root and (item[above] or paths.tag(node) == "li")
    declared, node = False, root
    while node:
        declared = declared or paths.tag(node) in ("article", "main")
        node = paths.parent[node]
    kept = []
    for path, text, linked in blocks:
        chars, _, of_path, _ = sums[path]
        # a linked list item goes with a list of links, and stays among items of text
        links = of_path >= chars if item[path] else 2 * linked >= len(text)
        if not inside[path] or item[path] and links:
            continue
        tail = paths.depth[path] - paths.depth[root]
        heading = tail > 0 and paths.tag(path) in HEADINGS
        if path in content or declared or not links and (found or heading or tail <= 1):
            kept.append(text)
    return "\n\n".join(kept)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars. Null and empty pages give the empty text. Repeated
    rows stay; other columns are not read; rows are mapped where they lie, so nothing shuffles."""
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def make():
        def work(part):
            texts = [main_text(page) for page in part.column("html").to_pylist()]
            return [part.column("page_id"), part.column("url"), texts, list(map(len, texts))]

        return work

    id_type = rows.schema["page_id"].dataType.simpleString()
    return map_texts(rows, "html", f"page_id {id_type}, url string, text string, n_chars bigint", make)
