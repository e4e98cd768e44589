"""Main text of web pages by tree scoring.

A page is read once into a tree of block elements and the text blocks they hold. Elements that are
menus, forms, adverts and the like by tag, role or name are left out whole. Every other
block gives points to its parent (for being there, for its commas and its length), half of them to the
grandparent and less to those above; points are discounted by the share of the text
that is link text. The element with most points holds the article; if it lies in an ``article`` or ``main``
element, that is taken. Where siblings of it, or of an element around it, hold plain text, what lies around
them is the article, and its parts are judged one by one: those with a fifth of the points of the best, those with
a run of plain text and the headings beside them are kept, unless a quarter or more of their text is link text.

Unclosed and crossed tags are taken as browsers do where it matters: a block closes an open
paragraph, an end tag without its start is nothing, inline tags don't nest blocks. A left-out element
without an end goes to the next article or the end of what holds it.

Work is linear in the page: each tag is read once, and ends of left-out elements are looked up in a
table made in one pass.

Defined results: a null page is empty; an empty page, or one with nothing but left-out elements, has an
empty text; repeated rows are read each; an empty table gives no rows; other columns stay out.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PART = re.compile(r"[a-z]+|[0-9]+|[A-Z][a-z]+")

#: Elements whose content isn't markup.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template", "svg", "math", "object", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
LEFT_OUT = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "fieldset", "search", "datalist", "label"}
ROLES = {"navigation", "banner", "complementary", "contentinfo", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent gdpr "
    "notice notices popup modal overlay nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside footer masthead topbar comment comments disqus respond "
    "reply replies discussion share sharing social related recommended recommendations newsletter subscribe subscription signup login search widget widgets pagination "
    "pager toolbar skip".split()
)
#: Of a part of the article itself, only these names leave it out.
OWN_NAMES = set("ad ads advert advertisement comment comments sponsored promo reply replies related teaser".split())


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(text)}


def _unwanted(tag: str, attributes: str, inside: bool) -> str:
    """Why an element is left out: by its tag, by its name, or not at all; ``inside`` an article."""
    if tag in LEFT_OUT or tag == "header" and not inside:
        return "tag"
    if not attributes or tag in ("html", "body", "main"):
        return ""
    own = _attributes(attributes)
    if "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "").lower():
        return "tag"
    if own.get("role", "").lower() in ROLES:
        return "tag"
    parts = {p.lower() for p in _NAME_PART.findall(f"{own.get('class', '')} {own.get('id', '')}")}
    names = OWN_NAMES if tag == "article" else NAMES if inside else NAMES | {"header"}
    return "name" if parts & names else ""


def _tokens(page: str) -> list[tuple[int, int, str, str, str]]:
    """(begin, end, slash, tag, attributes) of tags; comments and raw elements have no tag."""
    out, at = [], 0
    last = page.rfind(">") + 1  # no tag ends behind it, so none is looked for there
    while m := _TOKEN.search(page, at, last):
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        slash, attributes = m[1] or m[4] or "", m[3] or m[6] or ""
        if tag in RAW and not slash and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            out.append((m.start(), at, "", "", ""))
        else:
            out.append((m.start(), at, slash, tag, attributes))
    comment = page.find("<!--", max(at, last))
    if comment >= 0:
        out.append((comment, len(page), "", "", ""))
    return out


def _ends(tokens: list) -> dict[int, int]:
    """For each start tag with an end tag: where that is, as tags of one name nest."""
    opened: dict[str, list[int]] = {}
    ends = {}
    for i, (_, _, slash, tag, _) in enumerate(tokens):
        if slash:
            if opened.get(tag):
                ends[opened[tag].pop()] = i
        elif tag:
            opened.setdefault(tag, []).append(i)
    return ends


class _Tree:
    def __init__(self):
        self.tag, self.parent = ["#page"], [-1]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters of links

    def add(self, tag: str, parent: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        return len(self.tag) - 1


def _tree(page: str) -> _Tree:
    tokens = _tokens(page)
    ends, tree = _ends(tokens), _Tree()
    articles = [0]  # start tags of articles up to each token
    for _, _, slash, tag, _ in tokens:
        articles.append(articles[-1] + (not slash and tag in ("article", "main")))
    stack = [0]
    article = 0  # open article and main elements
    pieces: list[str] = []
    links, in_link = 0, False

    def flush() -> None:
        nonlocal links, in_link
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            tree.blocks.append((stack[-1], text, links))
        pieces.clear()
        links, in_link = 0, False

    def close(place: int) -> None:
        nonlocal article
        for node in stack[place:]:
            article -= tree.tag[node] in ("article", "main")
        del stack[place:]

    at, skip_to = 0, -1
    for i, (begin, end, slash, tag, attributes) in enumerate(tokens):
        if i <= skip_to:
            at = end
            continue
        if begin > at:
            text = page[at:begin]
            pieces.append(text)
            if in_link:
                links += len(text)
        at = end
        if not tag:
            continue
        if slash:
            if tag == "a":
                in_link = False
            elif tag in BLOCKS:
                flush()
                for place in range(len(stack) - 1, 0, -1):
                    if tree.tag[stack[place]] == tag:
                        close(place)
                        break
            continue
        if tag in VOID and tag != "hr":
            pieces.append(" ")
            continue
        why = _unwanted(tag, attributes, article > 0)
        if why:
            to = ends.get(i)
            if to is None:
                to = _without_end(tokens, i)
            if why == "tag" or tag == "article" or articles[to] == articles[i + 1] or _attributes_named(attributes):
                if tag in BLOCKS:
                    flush()
                else:
                    pieces.append(" ")
                skip_to = to
                continue
        if tag == "a":
            in_link = True
        elif tag in BLOCKS:
            flush()
            top = tree.tag[stack[-1]]
            if top == "p" or top == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option") or top in HEADINGS and tag in HEADINGS:
                close(len(stack) - 1)
            if tag != "hr":
                stack.append(tree.add(tag, stack[-1]))
                article += tag in ("article", "main")
    pieces.append(page[at:] if skip_to < len(tokens) - 1 or not tokens else page[max(at, tokens[-1][1]) :])
    flush()
    return tree


def _attributes_named(attributes: str) -> bool:
    """Whether an element is left out even if it holds articles, as lists of comments do."""
    own = _attributes(attributes)
    return bool({p.lower() for p in _NAME_PART.findall(f"{own.get('class', '')} {own.get('id', '')}")} & {"comment", "comments", "replies", "disqus", "respond", "related"})


def _without_end(tokens: list, i: int) -> int:
    """The last token of an element that is never closed: before the next article, or before its parent ends."""
    depth = 0
    for j in range(i + 1, len(tokens)):
        _, _, slash, tag, _ = tokens[j]
        if tag in ("article", "main") and not slash:
            return j - 1
        if tag in BLOCKS:
            depth += -1 if slash else 1
            if depth < 0:
                return j - 1
    return len(tokens) - 1


def _scores(tree: _Tree) -> list[float]:
    n = len(tree.tag)
    points, chars, links = [0.0] * n, [0] * n, [0] * n
    for node, text, linked in tree.blocks:
        own = 1 + text.count(",") + text.count("，") + min(len(text) / 100, 3)
        if tree.tag[node] in HEADINGS:
            own = 1.0
        # The element of a block passes its points on unless it is a container itself.
        up = node if tree.tag[node] in ("div", "section", "article", "main", "body", "td", "#page") else tree.parent[node]
        share = 1
        while up >= 0 and share < 6:
            points[up] += own / (share if share < 2 else 2 * (share - 1))
            up, share = tree.parent[up], share + 1
        chars[node] += len(text)
        links[node] += linked
    for node in range(n - 1, 0, -1):
        chars[tree.parent[node]] += chars[node]
        links[tree.parent[node]] += links[node]
    return [p * (1 - min(1.0, k / c)) if c else 0.0 for p, k, c in zip(points, links, chars, strict=True)]


def _beside(tree: _Tree, scores: list[float], best: int) -> set[int]:
    """Elements beside the best, or beside one around it, that belong to the same article."""
    n = len(tree.tag)
    chars, links, longest = [0] * n, [0] * n, [0] * n
    for node, text, linked in tree.blocks:
        chars[node] += len(text)
        links[node] += linked
        if linked < 0.25 * len(text):
            longest[node] = max(longest[node], len(text))
    children: list[list[int]] = [[] for _ in range(n)]
    for node in range(n - 1, 0, -1):
        up = tree.parent[node]
        children[up].append(node)
        chars[up] += chars[node]
        links[up] += links[node]
        longest[up] = max(longest[up], longest[node])
    kept, headings, node = set(), set(), best
    while node > 0:
        others = [k for k in children[tree.parent[node]] if k != node]
        plain = [k for k in others if links[k] < 0.25 * chars[k] and (longest[k] > 80 or scores[k] >= 0.2 * scores[best])]
        headings |= {k for k in others if tree.tag[k] in HEADINGS}
        # Headings farther up count only if text beside them does.
        if plain or node == best:
            kept |= headings | set(plain)
            headings = set()
        node = tree.parent[node]
    return kept


def main_text(page: str | None) -> str:
    tree = _tree(page or "")
    if not tree.blocks:
        return ""
    scores = _scores(tree)
    best = max(range(len(scores)), key=lambda i: (scores[i], -i))
    up = best
    while up > 0:
        if tree.tag[up] in ("article", "main"):
            best = up
            break
        up = tree.parent[up]
    kept = {best}
    if tree.tag[best] not in ("article", "main"):
        kept |= _beside(tree, scores, best)
    inside = [False] * len(tree.tag)
    for node in range(len(tree.tag)):
        inside[node] = node in kept or node > 0 and inside[tree.parent[node]]
    return " ".join(text for node, text, _ in tree.blocks if inside[node])


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column(2)]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars per page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(_extracted, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
