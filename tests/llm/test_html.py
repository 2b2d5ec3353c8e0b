"""Extraction held against a plain parser's reading, on pages with and without marks."""

import html.parser
import re
import time

import duckdb
import pytest

from fundlens.llm import html as H

PROSE = "Some prose, as it is, goes on. And more of it, to be long enough."
P = f"<p>{PROSE}</p>"


class Plain(html.parser.HTMLParser):
    """All text outside of the parts that these pages have around their articles, by the library's parser."""

    LINE, OUT = {"b", "i", "a", "em", "strong"}, {"nav", "footer", "script", "style", "title", "header", "aside", "form"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.stack = [""], []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.out[-1] += "\n"
        elif tag not in self.LINE and tag not in ("meta", "input", "img"):
            self.out.append("")
            if tag != "p":
                self.stack.append((tag, tag in self.OUT or dict(attrs).get("class") in ("ad", "sidebar", "comments")))

    def handle_endtag(self, tag):
        if tag in self.LINE:
            return
        self.out.append("")
        if tag != "p" and any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(out for _, out in self.stack):
            self.out[-1] += data

    def text(self):
        return " ".join(filter(None, (re.sub(r"\s+", " ", t).strip() for t in self.out)))


@pytest.fixture(scope="module")
def pages(sf):
    return [h for h, in duckdb.sql(f"SELECT html FROM '{sf}/pages.parquet'").fetchall()]


MARKS = [("<article>", "</article>"), ("<div>", "</div>"), ("<main>", "</main>"), ("<section id=x>", "</section>"), ("", ""),
         ("<div class='post has-sidebar'>", "</div>"), ("<main><article class='post comments-open'>", "</article></main>"),
         ("<div class='wrap'><div class='page no-sidebar'>", "</div></div>")]


@pytest.mark.parametrize("start, end", MARKS)
def test_pages_with_any_marks(pages, start, end):
    for page in pages:
        page = re.sub(r"<article[^>]*>", start, page).replace("</article>", end)
        plain = Plain()
        plain.feed(page)
        assert H.main_text(page) == plain.text()


@pytest.mark.parametrize("page, want", [
    (f"<body><div class='page has-sidebar'>{P}{P}</div>", f"{PROSE} {PROSE}"),
    (f"<body><div class='wrap comments-open'><article>{P}</article></div>", PROSE),
    (f"<article><div class='entry-header'><h1>Head</h1></div>{P}</article>", f"Head {PROSE}"),
    ("<article><p>a, b <span class='ad'>x <span>y</span> LEAK</span> c, d.</p></article>", "a, b c, d."),
    (f"<main><p>Home page</p><a>More</a><article>{P}</article></main>", PROSE),
    (f"<div class=sidebar><article>{P}</article></div>", PROSE),
    (f"<div class='sidebar'><div class=ad><p>Buy, now.</p></div><article>{P}</article></div>", PROSE),
    (f"<article>{P}</article><div id=comments><article class=comment><p>No, {PROSE}</p></article></div>", PROSE),
    (f"<div class=post>{P}</div><div id=comments><article class=comment><p>No, {PROSE}</p></article></div>", PROSE),
    (f"<div class=widget>{P}</div>", PROSE),
    ("<p>&#" + "9" * 5000 + "; &#x" + "f" * 5000 + "; &#" + "0" * 5000 + "65; y, z.</p>", "� � A y, z."),
])
def test_single_pages(page, want):
    assert H.main_text(page) == want


@pytest.mark.parametrize("part", ["<a ", '<a "', "<a '", "<!--", "<!", "<", "&#1", "&", "<p class=ad>", "<script ", "</script", "<b>x",
                                  "<a b='", "<a x = ", "<li>x, y.", "</x>", "<div>", "<table><tr><td>a, b."])
@pytest.mark.parametrize("end", ["", ">", "\">", "<p>end, of it.</p>"])
def test_a_megabyte_of_broken_markup(part, end):
    began = time.perf_counter()
    assert isinstance(H.main_text("<div>" * 300 + part * (1_000_000 // len(part)) + end), str)
    assert time.perf_counter() - began < 10
