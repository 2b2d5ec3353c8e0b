"""Main text of web pages by tag-path ratios.

A page is cut into blocks, each with its root-to-leaf tag path. For each path
the text characters and punctuation of its blocks are added up; the ratio of a
path is its text per block, weighted by its punctuation per block (prose has
both, menus have neither). Ratios are smoothed along the page by a Gaussian
over neighbouring blocks, the smoothed text and punctuation ratios are
fused by their product, and paths above a share of the page's deviation are
content. The content node is the article-like element that holds the most fused score (an <article> goes before what
is around it if it holds ``MOST`` of that), or else the
deepest node that holds ``MOST`` of it, several content blocks (if there are several), and every block of the
content paths that it has any of; paths with no block in it are outliers. All its
blocks belong to the text, so a short paragraph in an article is not lost.

Never content, by tag or by names in class, id or role: menus, headers and
footers of the page, sidebars, notices, adverts, forms, scripts, styles, reader comments. A class that states a
layout (has-sidebar, comments-open) names no part, and neither does the header of an article or the id of a heading,
within an <article>, or of a section within an article-like element. An element that only its names
speak against stays if it holds the page's only <article> or <main>, or all its text.

Cases: a null or empty page has an empty text; pages are read whole, in time
linear in their length; broken markup (unclosed or stray tags, comments and
entities cut off) is read as far as it goes; equal rows give equal results; an
empty table gives an empty result; other columns are passed over.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tags that never hold main text, whole with what is in them.
SKIPPED = frozenset("script style noscript template head title nav header footer aside form button select option "
                    "textarea iframe object svg canvas dialog menu figure-ad".split())
# Tags whose content is no markup.
RAW = frozenset("script style textarea title noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Tags that stand within a line of text.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s "
                   "samp small span strike strong sub sup time tt u var wbr br img".split())
# Words in class, id or role of elements that are no main text.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion promoted sponsor sponsored sponsoredlinks "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager "
    "sidebar aside complementary widget widgets "
    "footer contentinfo copyright header masthead topbar "
    "cookie cookies consent gdpr notice notices popup modal overlay subscribe newsletter signup login search searchbox "
    "comment comments disqus reply replies respond discussion "
    "share sharing social related recommended recommendations toolbar toc hidden".split())
# Elements that a page's main text is usually marked with.
ARTICLE_TAGS = frozenset(("article", "main"))
ARTICLE_WORDS = frozenset("article main content post story entry".split())
#: Width of the smoothing over neighbouring blocks, and the share of the deviation that content paths exceed.
SIGMA, THRESHOLD = 1.0, 0.5
#: Share of the content paths' score that the content node holds.
MOST = 0.8
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Words by which a class states a layout instead of naming a part.
STATES = frozenset("has no not is with without open opened closed enabled disabled on off active inactive".split())
#: Tags whose quotes do not close before the page ends, after which quotes are no longer heeded.
MAX_UNCLOSED = 16

_MARKUP = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?])")
_TAG_END = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
# Character references with more digits than any has, zeros in front included.
_LONG_REFERENCE = re.compile(r"&#(?:0*([0-9]+)|[xX]0*([0-9a-fA-F]+));?")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}


class Node:
    """An element: its tag, path, parent, and whether it is boilerplate (by its tag or only by its names) or article-like.

    ``skipped`` holds for all within a skipped element, ``named`` is the outermost element around it that
    only its names speak against; below that, ``marked_in`` tells of an article and ``again`` of further such names. Paths are numbers, equal for equal paths of a page.
    """

    __slots__ = ("again", "article", "depth", "in_article", "in_marked", "marked_in", "named", "parent", "parts", "path", "skipped", "tag")

    def __init__(self, tag: str, parent: Node | None, attributes: str, paths: dict[tuple[int, str], int]):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.path = paths.setdefault((parent.path if parent else -1, tag), len(paths))
        words: set[str] = set()
        against: set[str] = set()
        ids: set[str] = set()
        hidden = False
        if attributes and "=" in attributes or "hidden" in attributes:
            for name, *values in _ATTR.findall(attributes):
                name = name.lower()
                hidden |= name == "hidden"
                if name not in ("class", "id", "role"):
                    continue
                for token in "".join(values).lower().split():
                    own = set(_WORD.findall(token))
                    words |= own
                    if not own & STATES:
                        # The header of an article, entry or post heads that.
                        own -= {"header"} if own & ARTICLE_WORDS else set()
                        (ids if name == "id" else against).update(own & BOILERPLATE)
        inside = parent is not None and parent.in_marked
        self.article = tag in ARTICLE_TAGS or bool(words & ARTICLE_WORDS) and tag in ("div", "section")
        self.in_marked = inside or tag in ARTICLE_TAGS
        # Whether an id names a part of the text.
        parts = parent is not None and (parent.in_article or tag == "section" and parent.parts)
        self.in_article = tag == "article" or parent is not None and parent.in_article
        self.parts = self.article or parent is not None and parent.parts
        if not (tag in HEADINGS or parts):
            against |= ids
        if inside or parent is not None and parent.parts and tag != "header":
            against.discard("header")
        # A header within an article heads the article, not the page.
        by_tag = hidden or tag in SKIPPED and not (tag == "header" and inside)
        by_name = bool(against) and tag not in ("html", "body", "main") and not (tag == "article" and words & ARTICLE_WORDS)
        self.skipped = bool(parent and parent.skipped) or by_tag or by_name and tag in INLINE
        above = parent.named if parent else None
        self.named = above or (self if by_name else None)
        self.marked_in = above is not None and (parent.marked_in or tag in ARTICLE_TAGS)
        self.again = above is not None and (parent.again or by_name)


def _references(text: str) -> str:
    """Character references decoded, of whatever length."""
    if "&" not in text:
        return text
    if len(text) > 1000:
        text = _LONG_REFERENCE.sub(lambda m: m[0] if len(m[0]) < 40 else
                                   "\ufffd" if len(m[1] or m[2]) > 8 else f"&#{'x' if m[2] else ''}{m[1] or m[2]};", text)
    return html.unescape(text)


def blocks(page: str) -> list[tuple[Node, str]]:
    """The page's blocks of text in order, each with the element that it stands in."""
    paths: dict[tuple[int, str], int] = {}
    root = Node("#", None, "", paths)
    open_nodes, out, parts = [root], [], []
    opened: Counter[str] = Counter()
    unclosed, last = 0, page.rfind(">")

    def end_block() -> None:
        if parts:
            text = _SPACE.sub(" ", _references("".join(parts))).strip()
            parts.clear()
            node = open_nodes[-1]
            while node.tag in INLINE and node.parent is not None:
                node = node.parent
            if text and not node.skipped:
                out.append((node, text))

    def close(tag: str) -> None:
        if not opened[tag]:
            return
        for n in range(len(open_nodes) - 1, 0, -1):
            opened[open_nodes[n].tag] -= 1
            if open_nodes[n].tag == tag:
                del open_nodes[n:]
                return

    def add(text: str) -> None:
        # Text of a skipped element within a line is left out of the line.
        if text and not (open_nodes[-1].skipped and open_nodes[-1].tag in INLINE):
            parts.append(text)

    at = taken = 0  # up to here the page is read, up to here its text is taken
    while m := _MARKUP.search(page, at):
        slash, tag = m[2], (m[3] or "").lower()
        attributes = ""
        if m[1]:
            end = page.find("-->", m.end())
            end = end + 3 if end >= 0 else len(page)
        elif not tag:
            end = page.find(">", m.end()) + 1 or len(page)
        elif m.end() > last:
            break  # no tag ends any more
        else:
            whole = _TAG_END.match(page, m.end()) if unclosed < MAX_UNCLOSED else None
            unclosed += whole is None
            end = whole.end() if whole else page.index(">", m.end()) + 1
            attributes = page[m.end():end - 1]
        add(page[taken:m.start()])
        at = taken = end
        if not tag:
            continue  # a comment or declaration
        if tag == "br":
            add("\n")
            continue
        if tag not in INLINE:
            end_block()
        if slash:
            close(tag)
            continue
        if tag in VOID:
            continue
        if tag not in INLINE and opened["p"]:
            close("p")  # a block ends an open paragraph, and what is open in it
        if tag in ("li", "tr", "td", "th", "dt", "dd", "option") and open_nodes[-1].tag == tag:
            opened[tag] -= 1
            open_nodes.pop()
        if attributes.endswith("/"):
            continue
        if tag in RAW:
            raw = _RAW_END[tag].search(page, at)
            at = taken = raw.end() if raw else len(page)
            continue
        if len(open_nodes) < 500:  # deeper elements count as their parent
            open_nodes.append(Node(tag, open_nodes[-1], attributes, paths))
            opened[tag] += 1
    add(page[taken:])
    end_block()
    return out


def _named_out(found: list[tuple[Node, str]]) -> list[tuple[Node, str]]:
    """Without what only names speak against, as far as that isn't the page itself."""
    kept = [(n, t) for n, t in found if n.named is None]
    if len(kept) == len(found):
        return found
    if not any(n.in_marked for n, _ in kept):
        # Elements with such names around the page's articles or all of it: these are judged by the names within them.
        around = {id(n.named) for n, _ in found if n.marked_in}
        if around or not kept:
            return [(n, t) for n, t in found if n.named is None or (id(n.named) in around or not kept) and not n.again] or found
    return kept


def path_scores(found: list[tuple[Node, str]]) -> dict[int, float]:
    """The fused score of each tag path: smoothed text ratio times smoothed punctuation ratio."""
    text, marks, count = {}, {}, {}
    for node, t in found:
        p = node.path
        text[p] = text.get(p, 0) + len(t)
        marks[p] = marks.get(p, 0) + len(_PUNCTUATION.findall(t))
        count[p] = count.get(p, 0) + 1
    reach = max(1, round(2 * SIGMA))
    kernel = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-reach, reach + 1)]

    def smoothed(values: list[float]) -> list[float]:
        out = []
        for n in range(len(values)):
            total = weight = 0.0
            for d, k in zip(range(-reach, reach + 1), kernel, strict=True):
                if 0 <= n + d < len(values):
                    total, weight = total + k * values[n + d], weight + k
            out.append(total / weight)
        return out

    ratios = smoothed([text[n.path] / count[n.path] for n, _ in found])
    points = smoothed([marks[n.path] / count[n.path] for n, _ in found])
    score = dict.fromkeys(text, 0.0)
    for (node, _), r, p in zip(found, ratios, points, strict=True):
        score[node.path] += math.log1p(r) * (0.1 + math.log1p(p)) / count[node.path]
    return score


def _article(found: list[Node], held: dict[int, float]) -> Node:
    """Of article-like elements the one with the most score. An <article> in it that holds ``MOST`` of that goes
    before it; of equal ones, the outermost <article>, or else the innermost."""
    top = max(held[id(n)] for n in found)
    marked = [n for n in found if n.tag == "article" and held[id(n)] >= MOST * top]
    if marked:
        return max(marked, key=lambda n: (held[id(n)], -n.depth))
    return max(found, key=lambda n: (held[id(n)], n.depth))


def main_text(page: str | None) -> str:
    """The main text of a page: its content node's blocks, joined by a space."""
    found = _named_out(blocks(page)) if page else []
    if not found:
        return ""
    scores = path_scores(found)
    values = [scores[n.path] for n, _ in found]
    mean = sum(values) / len(values)
    deviation = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
    limit = min(max(values), THRESHOLD * deviation)
    content = [(n, t) for n, t in found if scores[n.path] >= limit]
    # What each element holds of the content paths' score and blocks, and of the blocks of paths that it holds whole.
    held: dict[int, float] = {}
    nodes: dict[int, Node] = {}
    inside_of: Counter[int] = Counter()
    whole: Counter[int] = Counter()
    own: dict[int, dict[int, Node]] = {}
    of_path = Counter(n.path for n, _ in content)
    for node, t in content:
        held[id(node)] = held.get(id(node), 0.0) + scores[node.path] * len(t)
        inside_of[id(node)] += 1
        own.setdefault(node.path, {})[id(node)] = node
        nodes[id(node)] = node
    for path, level in own.items():  # up to the one element around all of a path's blocks
        while len(level) > 1:
            level = {id(n.parent): n.parent for n in level.values()}
        whole[next(iter(level))] += of_path[path]
    by_depth: dict[int, dict[int, Node]] = {}
    for k, n in nodes.items():
        by_depth.setdefault(n.depth, {})[k] = n
    for depth in range(max(by_depth), 0, -1):
        for k, n in by_depth.get(depth, {}).items():
            up = id(n.parent)
            by_depth.setdefault(depth - 1, {})[up] = nodes[up] = n.parent
            held[up] = held.get(up, 0.0) + held[k]
            inside_of[up] += inside_of[k]
            whole[up] += whole[k]
    articles = [k for k, n in nodes.items() if n.article]
    if articles:
        root = _article([nodes[k] for k in articles], held)
        # Several articles of one page (a series) stand in the same parent: all are main text.
        tops = [n for n in nodes.values() if n.tag == root.tag and n.parent is root.parent and n.article]
    else:
        most = max(held.values())
        tops = [max((n for k, n in nodes.items() if held[k] >= MOST * most and inside_of[k] == whole[k]
                     and inside_of[k] >= min(2, len(content))), key=lambda n: n.depth)]
    inside = {id(n): True for n in tops}

    def within(node: Node) -> bool:
        passed = []
        at: Node | None = node
        while at is not None and id(at) not in inside:
            passed.append(id(at))
            at = at.parent
        answer = at is not None and inside[id(at)]
        inside.update(dict.fromkeys(passed, answer))
        return answer

    return " ".join(t for n, t in found if within(n))


EXTRACTED = "text string, n_chars long"


def extracted(page):
    """Struct column EXTRACTED of a column of html."""

    @F.pandas_udf(EXTRACTED)
    def extract(pages: pd.Series) -> pd.DataFrame:
        texts = [main_text(p) for p in pages]
        return pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    return extract(page)


def extract_pages(df: DataFrame, html_col: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per page: the keys, text, n_chars."""
    return df.select(*keys, extracted(F.col(html_col)).alias("_x")).select(*keys, "_x.*")
