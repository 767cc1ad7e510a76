"""Main text of web pages by line-block distribution.

Markup is stripped to lines (one per block element), menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments count as
lines without text, and the text lengths are summed over a sliding window of
lines. Text starts where the sum surges and ends where it dives to nothing.

A page that marks its article (``article``, ``main`` or ``role=main``) counts
only lines inside it, and any text there is a surge. Without such a mark, lines
that are mostly links count nothing and a surge needs more than ``surge``
characters or a third of the page's largest window, whichever is less; the text
lines right before a surge, and those in one container with kept lines, belong
to it.

Elements around ``main`` never make it chrome. An ``article`` inside a sidebar,
header, form or the like counts if the page has no article outside of them.
Class and id tokens are chrome by their last part, or by their first before a
part like ``-list``; tokens such as ``has-sidebar`` say nothing, and headers
inside an article are text.

Defined cases: a null, empty or text-less page gives an empty text; unclosed
and stray tags are tolerated (an unclosed script, style, textarea or title takes
the rest of the page, any other raw element only its tag), in time that grows
with the length of the page; repeated pages give repeated rows; ``url`` and
extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import steps

# Element names and name parts of HTML pages.
RAW = "script style noscript template svg math iframe object textarea title select canvas audio video".split()
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "head"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
CHROME_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice overlay pager pagination popup promo promoted "
    "related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
# Chrome that may also be a wrapper of the whole page, and chrome that is text inside an article.
SOFT = {"form", "header", "masthead", "banner", "sidebar", "modal", "overlay", "notice", "toolbar", "menu", "widget", "widgets"}
HEADINGS = {"header", "masthead", "banner"}
CONDITIONS = {"no", "not", "non", "without", "with", "has", "have", "hide", "show", "hidden", "is", "layout"}
ENDINGS = set("area bar block box buttons count form icons inner item items left link links list posts right section slot text title top bottom".split())
CONTAINERS = {"body", "div", "section", "td"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())

# Raw elements whose text ends only with their end tag, or the page; those that ``/>`` closes.
ENDLESS = {"script", "style", "textarea", "title"}
FOREIGN = {"svg", "math"}

_OPEN = re.compile(r"<(?:(?P<comment>!--)|(?P<cdata>!\[CDATA\[)|(?P<other>[!?])|(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:_.-]*))")
_QUOTED = re.compile(r"=\s*([\"'])")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_ATTR = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PARTS = re.compile(r"[a-z0-9]+")


def _tokens(html: str):
    """(start, end, end tag, name, attributes) of comments (name empty), raw elements
    (name empty) and tags, in page order.

    A quoted attribute value may hold ``>``. What is found to be missing from
    some place on (an end sign, a closing quote, the end tag of a raw element) is
    looked for only once, so the time grows with the page, however broken."""
    missing: set[str] = set()
    at = 0

    def find(what: str, start: int) -> int:
        if what in missing:
            return -1
        found = html.find(what, start)
        if found < 0:
            missing.add(what)
        return found

    def tag_end(start: int) -> int:
        """The place of the ``>`` that ends a tag, or -1."""
        first = end = find(">", start)
        while end >= 0:
            quoted = _QUOTED.search(html, start, end)
            closing = find(quoted[1], quoted.end()) if quoted else -1
            if closing < 0:
                return end
            start = closing + 1
            if end < start:
                end = find(">", start)
        return first

    while True:
        m = _OPEN.search(html, at)
        if not m:
            return
        start, tag = m.start(), m["tag"]
        if m["comment"] or m["cdata"]:
            mark = "-->" if m["comment"] else "]]>"
            end = find(mark, m.end())
            at = len(html) if end < 0 else end + len(mark)
            yield start, at, False, "", ""
            continue
        end = find(">", m.end()) if m["other"] else tag_end(m.end())
        if end < 0:
            if m["other"] or ">" in missing:
                return  # no tag ends from here on: the rest is text
            at = m.end()
            continue
        at = end + 1
        if m["other"]:
            yield start, at, False, "", ""
            continue
        name, attrs = tag.lower(), html[m.end() : end]
        if name in _RAW_END and not m["close"] and not (name in FOREIGN and attrs.endswith("/")):
            close = None if name in missing else _RAW_END[name].search(html, at)
            if close:
                at = close.end()
            else:
                missing.add(name)
                if name in ENDLESS:
                    at = len(html)
            name = ""
        elif name in _RAW_END:
            name = ""
        yield start, at, bool(m["close"]), name, attrs


class Line:
    __slots__ = ("article", "chrome", "container", "linked", "text", "wrapped")

    def __init__(self, text: str, chrome: bool, article: bool, wrapped: bool, linked: int, container: int):
        self.text, self.chrome, self.article, self.wrapped, self.linked, self.container = text, chrome, article, wrapped, linked, container


def _chrome_name(token: str) -> str:
    """The part that makes a class or id token chrome, or nothing."""
    parts = _NAME_PARTS.findall(token)
    if not parts or CONDITIONS.intersection(parts):
        return ""
    if parts[-1] in CHROME_NAMES:
        return parts[-1]
    return parts[0] if parts[0] in CHROME_NAMES and ENDINGS.issuperset(parts[1:]) else ""


def _kind(tag: str, attrs: str, in_article: bool) -> str:
    """``chrome``, ``soft`` chrome, ``article``, ``main`` or nothing special."""
    if tag in CHROME or (tag == "header" and not in_article):
        return "soft" if tag in SOFT else "chrome"
    names: set[str] = set()
    seen = set()
    for name, a, b, c in _ATTR.findall(attrs) if attrs else ():
        name = name.lower()
        if name not in ("class", "id", "role") or name in seen:
            continue
        seen.add(name)
        tokens = (a or b or c).lower().split()
        if name == "role":
            if CHROME_ROLES.intersection(tokens):
                return "chrome"
            if "main" in tokens:
                return "main"
        else:
            names.update(_chrome_name(t) for t in tokens)
    names.discard("")
    if tag == "main":
        return "main"
    if tag == "article":
        return "chrome" if names & {"comment", "comments", "reply"} else "article"
    if in_article:
        names -= HEADINGS
    if not names or tag in ("body", "html"):
        return ""
    return "soft" if names <= SOFT else "chrome"


def _inside(state: tuple[int, int, int, bool], kind: str) -> tuple[int, int, int, bool]:
    """(chrome, soft chrome, articles, article in soft chrome) inside an element of a kind."""
    chrome, soft, article, wrapped = state
    if kind == "main":
        return 0, 0, article + 1, False
    if kind == "article":
        return (chrome, 0, 1, True) if soft and not chrome and not article else (chrome, soft, article + 1, wrapped)
    return chrome + (kind == "chrome"), soft + (kind == "soft"), article, wrapped


def page_lines(html: str) -> list[Line]:
    """Text of each block element in page order, with what surrounds it."""
    lines: list[Line] = []
    # Open elements that are of a kind, and those nested in them by the same name, with the state outside of them.
    stack: list[tuple[str, tuple[int, int, int, bool]]] = []
    opened: Counter[str] = Counter()  # names on the stack
    boxes: list[tuple[str, int]] = [("", 0)]  # open containers, by number
    open_boxes = dict.fromkeys(CONTAINERS, 0)
    held: list[str] = []
    state = (0, 0, 0, False)
    anchors = linked = at = n_boxes = 0

    def flush():
        nonlocal linked
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            lines.append(Line(text, state[0] + state[1] > 0, state[2] > 0, state[3], linked, boxes[-1][1]))
        linked = 0

    for start, end, close, tag, attrs in _tokens(html):
        piece = html[at:start]
        at = end
        if piece:
            held.append(piece)
            if anchors:
                linked += len(piece)
        if not tag:
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag == "a":
            anchors = 0 if close else 1
            continue
        if close:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None) if opened[tag] else None
            if tag in BLOCKS or depth is not None:
                flush()
            if depth is not None:
                state = stack[depth][1]
                opened.subtract(name for name, _ in stack[depth:])
                del stack[depth:]
            if open_boxes.get(tag):
                while True:
                    name, _ = boxes.pop()
                    open_boxes[name] -= 1
                    if name == tag:
                        break
            continue
        if tag in BLOCKS and stack and stack[-1][0] == "p":  # a block ends an open paragraph
            flush()
            state = stack.pop()[1]
            opened["p"] -= 1
        kind = _kind(tag, attrs, state[2] > 0)
        if tag in BLOCKS or kind:
            flush()
        if tag not in VOID and not attrs.endswith("/") and (kind or opened[tag]):
            stack.append((tag, state))
            opened[tag] += 1
            state = _inside(state, kind)
        if tag in CONTAINERS and not attrs.endswith("/"):
            n_boxes += 1
            boxes.append((tag, n_boxes))
            open_boxes[tag] += 1
    held.append(html[at:])
    flush()
    return lines


def main_text(html: str | None, window: int = 3, surge: int = 80) -> str:
    """Blocks between surge and dive points, joined by an empty line."""
    lines = page_lines(html or "")
    articles = [x for x in lines if x.article and not x.chrome]
    marked, outside = bool(articles), any(not x.wrapped for x in articles)
    lengths = []
    for x in lines:
        skip = x.chrome or (marked and not x.article) or (outside and x.wrapped) or (not marked and 2 * x.linked > len(x.text))
        lengths.append(0 if skip else len(x.text))
    sums = [sum(lengths[i : i + window]) for i in range(len(lengths))]
    least = 0 if marked else min(surge, max(sums, default=0) // 3)
    keep, i = [False] * len(lines), 0
    while i < len(sums):
        if sums[i] <= least:
            i += 1
            continue
        end = i  # the dive: no text in the window that starts here
        while end < len(sums) and sums[end] > 0:
            end += 1
        for j in range(i, min(end + window - 1, len(lines))):
            keep[j] = keep[j] or lengths[j] > 0
        while i > 0 and lengths[i - 1] > 0 and not keep[i - 1]:
            i -= 1
            keep[i] = True
        i = end
    kept = {x.container for x, k in zip(lines, keep, strict=True) if k}
    keep = [k or (n > 0 and x.container in kept) for x, k, n in zip(lines, keep, lengths, strict=True)]
    return "\n\n".join(x.text for x, k in zip(lines, keep, strict=True) if k)


def _extract(window: int, surge: int):
    def run(batches):
        for whole in batches:
            for batch in steps([whole], "html"):
                texts = [main_text(h, window, surge) for h in batch.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return run


def extract_main_text(pages: DataFrame, window: int = 3, surge: int = 80) -> DataFrame:
    """(page_id, url, text) for every page."""
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(_extract(window, surge), "page_id long, url string, text string")
