"""Main text of web pages by composite text density.

Each node of a page has a density: its characters per tag, adjusted by how many of both are
links, relative to the page. A container of paragraphs has a high sum of its children's
densities. The node with the highest sum holds the article; the smallest density on the path
from the body down to it is the threshold above which other branches off that path belong to
the article as well. Inside the element that encloses the article, text standing beside the
chosen node belongs to it as well: headings, leaf blocks and direct text.

Where ``article`` or ``main`` holds a fair share of the page's unlinked text, only nodes in it are
candidates. Sections beside a chosen section are parts of one article.

Elements that are furniture by their kind, role or name (menus, adverts, comments and the
like) are left out beforehand. Names are whole class names or, for containers, their first or
last part. A form or an element with such a name stays if it holds the page's only article or,
on a page without one, most of its text; reader comments only if there is hardly any other text.

A page is read in one go by a tolerant tag scanner; nodes are lists in page order, so deep
nesting needs no recursion. Null pages are empty pages, with empty text; pages without markup
are one block. Repeated rows give equal texts. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from rankflow.llm.common import map_batches, picked, texts_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
UNREAD = frozenset("script style noscript template textarea iframe object svg math title".split())
FURNITURE = frozenset("head nav footer aside button select dialog menu".split()) | UNREAD
FORMS = frozenset("form fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "alert popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead topbar toolbar comment "
    "comments disqus respond reply replies share sharing social related recommended newsletter subscribe subscription signup login "
    "search pagination pager widget widgets "
    "cookie-notice cookie-banner cookie-consent site-footer site-navigation main-navigation main-menu comment-list comments-area "
    "share-buttons social-links related-posts newsletter-signup search-form ad-container ad-slot commentlist commentarea".split()
)
COMMENTS = frozenset("comment comments commentlist commentarea disqus respond reply replies".split())
COMMENT_REST = 0.05
"""Comments hold the article only where no more than this share of the page's text is elsewhere."""
CONTAINERS = frozenset("div section ul ol dl table form fieldset figure iframe center".split())
"""Elements that parts of names are read of; a paragraph of class ``market-share`` is none."""
WHOLE_ONLY = frozenset("widget widgets menu alert search social overlay".split())
"""Names that are common parts of other names."""
LAYOUT = frozenset("has with no without right left one two layout".split())
"""First parts that tell of a page's layout: ``has-sidebar`` names what has one."""
FAIR_SHARE = 0.25
MOST_LINKS = 2
"""A paragraph of links alone stays if it has so many; more are a list."""
PARAGRAPHS = frozenset("p blockquote figcaption dd dt h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())
ARTICLES = frozenset(("article", "main"))
CLOSED_BY = {  # an opening tag ends these if one is open below the nearest barrier
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
BARRIERS = frozenset("ul ol dl table body html article section main div blockquote td th select".split())
LINKED = 0.5

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^<>]*)>|<[!?/][^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_NAMED = re.compile(r"\b(?:class|id|role|hidden|aria-hidden|style)\b", re.I)


def _is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    """Furniture whatever it holds."""
    if tag in FURNITURE or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body", "article", "main") or not _NAMED.search(attributes):
        return False
    if re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attributes, re.I):
        return True
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value in ROLES or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _suspicion(tag: str, attributes: str) -> str:
    """The name by which an element is furniture unless it holds the article; empty if there is none."""
    if tag in ("html", "body", "article", "main") or not _NAMED.search(attributes):
        return tag if tag in FORMS else ""
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for word in "".join(values).lower().split():
                if word in NAMES:
                    return word
                parts = re.split("[-_]+", word.strip("-_"))
                if tag in CONTAINERS and len(parts) > 1 and parts[0] not in LAYOUT:
                    for part in (parts[0], parts[-1]):
                        if part in NAMES and part not in WHOLE_ONLY:
                            return part
    return tag if tag in FORMS else ""


class Page:
    """Nodes in page order, each after its parent, and the stretches of text between tags."""

    def __init__(self, source: str):
        self.tags, self.parents, self.in_article = ["body"], [-1], [False]
        self.stretches: list[tuple[int, int, str]] = []  # node, block, text
        self.block = 0
        self.suspects: dict[int, str] = {}
        closed: list[int] = []  # places in the stack of the open suspects
        stack, skipping, at, end = [0], 0, 0, len(source)
        for m in _MARKUP.finditer(source):
            if m.start() < at:
                continue
            if m.start() > at and not skipping:
                self._text(stack[-1], source[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                skipping = self._close(tag, stack, skipping, closed[-1] if closed else 0)
                while closed and closed[-1] >= len(stack):
                    closed.pop()
                continue
            attributes = m[3] or m[6] or ""
            if skipping:
                if tag not in VOID and not attributes.endswith("/"):
                    self._open(tag, stack)
            elif tag in VOID:
                if tag in ("br", "hr"):
                    self._text(stack[-1], " ")
            elif tag not in ("html", "body"):
                for i in self._implied(tag, stack, closed[-1] if closed else 0):
                    del stack[i:]
                self._open(tag, stack)
                if _is_furniture(tag, attributes, self.in_article[stack[-2]]):
                    skipping = len(stack)
                elif name := _suspicion(tag, attributes):
                    self.suspects[stack[-1]] = name
                    closed.append(len(stack) - 1)
            if tag in UNREAD and not attributes.endswith("/"):
                closing = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
                at = closing.start() if closing else end
        if at < end and not skipping:
            self._text(stack[-1], source[at:])
        if self.suspects:
            self._drop_suspects()

    def _drop_suspects(self) -> None:
        """Leave out the text of suspects, but for those that hold the article."""
        n = len(self.tags)
        linked, suspected = [False] * n, [False] * n
        for i in range(1, n):
            linked[i] = linked[self.parents[i]] or self.tags[i] == "a"
            suspected[i] = suspected[self.parents[i]] or i in self.suspects
        chars, plain = [0] * n, [0] * n
        for node, _, text in self.stretches:
            size = len(text.strip())
            chars[node] += size
            plain[node] += 0 if linked[node] else size
        holds = [False] * n
        for i in range(n - 1, 0, -1):
            up = self.parents[i]
            chars[up] += chars[i]
            plain[up] += plain[i]
            holds[up] = holds[up] or holds[i] or (self.tags[i] in ARTICLES and chars[i] > 0)
        elsewhere = any(self.tags[i] in ARTICLES and chars[i] and not suspected[i] for i in range(1, n))
        gone = [False] * n
        for i in range(1, n):
            least = (1 - COMMENT_REST if self.suspects.get(i) in COMMENTS else 0.5) * plain[0]
            held = not elsewhere and (holds[i] or plain[i] > least)
            gone[i] = gone[self.parents[i]] or (i in self.suspects and not held)
        self.stretches = [s for s in self.stretches if not gone[s[0]]]

    def _text(self, node: int, text: str) -> None:
        self.stretches.append((node, self.block, text))

    def _open(self, tag: str, stack: list[int]) -> None:
        self.block += tag not in INLINE
        self.tags.append(tag)
        self.parents.append(stack[-1])
        self.in_article.append(self.in_article[stack[-1]] or tag in ("article", "main"))
        stack.append(len(self.tags) - 1)

    def _implied(self, tag: str, stack: list[int], floor: int) -> list[int]:
        """Where to cut the stack because ``tag`` ends open elements."""
        if tag in CLOSED_BY:
            ends, barriers = CLOSED_BY[tag], BARRIERS - {"td", "th"}
        elif tag not in INLINE:
            ends, barriers = {"p"}, BARRIERS
        else:
            return []
        cut = []
        for i in range(len(stack) - 1, floor, -1):
            name = self.tags[stack[i]]
            if name in ends:
                cut.append(i)
            elif name in barriers:
                break
        return cut

    def _close(self, tag: str, stack: list[int], skipping: int, suspect: int) -> int:
        """Close the nearest open ``tag``; a stray end tag inside furniture does not leave it."""
        floor = (skipping - 1 if skipping else suspect) if tag not in ("article", "main", "body", "html") else 0
        for i in range(len(stack) - 1, max(floor, 1) - 1, -1):
            if self.tags[stack[i]] == tag:
                del stack[i:]
                self.block += tag not in INLINE
                break
        return skipping if len(stack) >= skipping else 0


def _densities(page: Page) -> tuple[list[float], list[int], list[int], list[int]]:
    """Composite density, characters, link characters and links of each node."""
    n = len(page.tags)
    chars, linked, tags, links = [0] * n, [0] * n, [0] * n, [0] * n
    for node, _, text in page.stretches:
        chars[node] += len(text.strip())
    for i in range(n - 1, 0, -1):
        if page.tags[i] == "a":
            linked[i], links[i] = chars[i], links[i] + 1
        up = page.parents[i]
        chars[up] += chars[i]
        linked[up] += linked[i]
        links[up] += links[i]
        tags[up] += tags[i] + 1
    share = linked[0] / chars[0] if chars[0] else 0.0
    density = []
    for c, lc, t, lt in zip(chars, linked, tags, links, strict=True):
        if not c:
            density.append(0.0)
            continue
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        ratio = c / max(lc, 1) * max(t, 1) / max(lt, 1)
        per_tag = c / max(t, 1)
        density.append(per_tag * math.log(max(ratio, 1.0)) / math.log(base) if base > 1.0001 else per_tag * math.log(max(ratio, math.e)))
    return density, chars, linked, links


def _candidates(page: Page, chars: list[int], linked: list[int]) -> list[int]:
    """Nodes that may hold the article: those of the largest ``article`` or ``main`` if it has a fair share of the text."""
    n = len(page.tags)
    named = [i for i in range(n) if page.tags[i] in ARTICLES]
    most = max(named, key=lambda i: (chars[i] - linked[i], -i), default=0)
    if not named or chars[most] == linked[most] or chars[most] - linked[most] < FAIR_SHARE * (chars[0] - linked[0]):
        return list(range(n))
    within = [False] * n
    for i in range(most, n):
        within[i] = i == most or within[page.parents[i]]
    return [i for i in range(most, n) if within[i]]


def _article(page: Page) -> list[bool]:
    """Which nodes belong to the article."""
    density, chars, linked, links = _densities(page)
    n = len(page.tags)
    sums = [0.0] * n
    for i in range(1, n):
        sums[page.parents[i]] += density[i]
    best = max(_candidates(page, chars, linked), key=lambda i: (sums[i], -i))
    path = [best]
    while path[-1]:
        path.append(page.parents[path[-1]])
    threshold = min(density[i] for i in path)
    inside = [False] * n
    on_path = set(path)
    # What encloses the article: the nearest such element, else the parent of the chosen node.
    at = next((k for k, i in enumerate(path) if page.tags[i] in ARTICLES), None)
    at = int(len(path) > 2) if at is None else at
    named = page.tags[path[at]] == "article"
    enclosing = set(path[: at + 1])
    direct = {block for node, block, text in page.stretches if node in enclosing and text.strip()}
    block_of = {node: block for node, block, _ in reversed(page.stretches)}
    for i in range(n):
        up = page.parents[i]
        linky = linked[i] > LINKED * chars[i]
        poor = chars[i] and linky and density[i] < threshold and page.tags[i] not in INLINE
        poor = poor and not (page.tags[i] in PARAGRAPHS and links[i] <= MOST_LINKS)
        if i in enclosing:
            inside[i] = True
        elif up == best:
            inside[i] = not poor
        elif up in on_path:
            # A branch off the path, or text beside it under a block of its own.
            beside = up == page.parents[best] and page.tags[i] == page.tags[best]
            rich = density[i] >= threshold and (sums[i] > 0 or page.tags[i] == "p" or beside)
            inside[i] = not linky and chars[i] > 0 and (rich or (beside and page.tags[i] == "section"))
            if up in enclosing and not inside[i]:
                if page.tags[i] in INLINE:
                    inside[i] = not linky or block_of.get(i) in direct
                else:
                    leaf = sums[i] == 0 or page.tags[i] in HEADINGS
                    inside[i] = not linky and (leaf or named)
        elif i and inside[up]:
            inside[i] = not poor
    return inside


def main_text(source: str) -> str:
    """The article's blocks in page order, white space as single blanks."""
    page = Page(source)
    inside = _article(page) if len(page.tags) > 1 else [True]
    blocks: dict[int, list[str]] = {}
    for node, block, text in page.stretches:
        if inside[node]:
            blocks.setdefault(block, []).append(text)
    plain = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return " ".join(text for text in plain if text)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``(key, url, text, n_chars)`` per page; ``n_chars`` counts the text's code points."""
    rows = picked(pages, key=key, url=url, html=source)
    kinds = [rows.schema[c].dataType.simpleString() for c in ("key", "url")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(t) for t in texts_of(batch, "html")]
        lengths = pa.array([len(t) for t in texts], pa.int64())
        columns = [batch.column("key"), batch.column("url"), pa.array(texts, pa.string()), lengths]
        return pa.record_batch(columns, ["key", "url", "text", "n_chars"])

    return map_batches(rows, run, f"key {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
