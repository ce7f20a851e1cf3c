"""HTML extraction: composite text density over the DOM."""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import DataFrame

from .common import map_arrow

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text up to their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that never hold article text.
DROPPED = frozenset(
    "script style noscript template head title nav footer aside button select textarea input label "
    "iframe object embed svg canvas audio video map dialog menu noembed noframes xmp".split()
)
#: Elements that are dropped unless most of the page is in them.
WRAPPERS = frozenset(("form", "fieldset"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that hold text rather than blocks: they are never the main subtree themselves.
LEAVES = HEADINGS | frozenset("p pre li dt dd a b i em strong span br td th caption summary".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody tfoot thead tr ul".split()
)
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - {"body", "head", "html", "caption", "tbody", "tfoot", "thead", "tr", "option", "optgroup"}
#: Start tag: the open elements it ends, up to the nearest of the elements that bound the search.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
}
#: Words of class, id and role values that mark what is not the article. A value's token counts if
#: it is such a word, or a compound of such words and of COMPANIONS alone.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs complementary consent "
    "contentinfo cookie cookies disqus footer footnav gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promotion recommended related share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription toolbar widget widgets".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist replies respond".split())
COMPANIONS = frozenset("site page global top bottom left right upper lower area bar block box buttons container form group icons inner item items left links list outer panel section slot unit wrap wrapper".split())
#: What may also stand beside words for comments and for other pages.
OTHERS = frozenset("post posts article articles story stories user users reader readers".split())
_BESIDE_OTHERS = COMMENT_WORDS | frozenset("related recommended share sharing social nav navigation pagination".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</([A-Za-z][^\s/>]*+)[^>]*+(?:>|\Z)|<([A-Za-z][^\s/>]*+)",
    re.S,
)
_ATTRIBUTES = re.compile(r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_TO_END = re.compile(r"([^>]*+)>")
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?(?=[\s/>]|\Z)", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PART = re.compile("[A-Za-z][a-z]*|[A-Z]+")
#: How sure the marks of an element are that it is not the article.
PLAIN, MARKED, COMMENTS, HIDDEN = range(4)


def _kind_of(token: str) -> int:
    """Whether a class, id or role names something beside the article."""
    parts = {w.lower() for w in _PART.findall(token)}
    own = parts & (ASIDE_WORDS | COMMENT_WORDS)
    beside = COMPANIONS | OTHERS if parts & _BESIDE_OTHERS else COMPANIONS
    if not own or parts - own - beside:
        return PLAIN
    return COMMENTS if own & COMMENT_WORDS else MARKED


def _marks(attributes: str) -> int:
    found = PLAIN
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            return HIDDEN
        if name in ("class", "id", "role"):
            found = max([found, *map(_kind_of, value.split())])
    return found


class _Page:
    """The DOM as parallel lists in document order, and the text events between block boundaries."""

    def __init__(self, source: str):
        self.tag, self.parent, self.dropped, self.mark = ["#"], [-1], [False], [PLAIN]
        self.events: list[tuple[int, str | None]] = []  # (node, text), or (-1, None) for a block boundary
        open_ = [0]
        at = 0
        events = self.events
        attributes = _ATTRIBUTES
        while m := _TOKEN.search(source, at):
            start, end = m.start(), m.end()
            if m[2] is not None:
                rest = attributes.match(source, end)
                if rest is None:  # quotes don't pair up from here on; tags end at the next mark
                    attributes = _TO_END
                    rest = attributes.match(source, end)
                if rest is None:  # cut off at the end of the page: no element, and no text
                    if start > at:
                        events.append((open_[-1], source[at:start]))
                    at = len(source)
                    break
                end = rest.end()
            if start > at:
                events.append((open_[-1], source[at:start]))
            at = end
            if (name := m[2]) is not None:
                name = name.lower()
                self._imply(name, open_)
                if name in BLOCK:
                    events.append((-1, None))
                elif name in ("br", "td", "th"):
                    events.append((open_[-1], " "))
                node = len(self.tag)
                self.tag.append(name)
                self.parent.append(open_[-1])
                mark = _marks(rest[1]) if rest[1] else PLAIN
                if name in ("html", "body", "article", "main"):  # an article may be a reader's comment, never a menu
                    mark = mark if mark in (COMMENTS, HIDDEN) and name == "article" else PLAIN
                if name in WRAPPERS or (name == "header" and not any(self.tag[k] in ("article", "main") for k in open_)):
                    mark = max(mark, MARKED)
                self.mark.append(mark)
                self.dropped.append(self.dropped[open_[-1]] or name in DROPPED or mark == HIDDEN)
                if name in VOID:
                    continue
                if name in RAW:
                    end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(source, at)
                    at = end.start() if end else len(source)
                open_.append(node)
            elif (name := m[1]) is not None:
                name = name.lower()
                if name == "p" and not any(self.tag[k] == "p" for k in open_):
                    events.append((-1, None))
                for depth in range(len(open_) - 1, 0, -1):
                    if self.tag[open_[depth]] == name:
                        del open_[depth:]
                        break
                if name in BLOCK:
                    events.append((-1, None))
                elif name in ("td", "th"):
                    events.append((open_[-1], " "))
        if at < len(source):
            events.append((open_[-1], source[at:]))

    def _imply(self, name: str, open_: list[int]) -> None:
        if name in ENDS_P:
            for depth in range(len(open_) - 1, 0, -1):
                t = self.tag[open_[depth]]
                if t == "p":
                    self.events.append((-1, None))
                    del open_[depth:]
                    break
                if t in ("table", "td", "th", "button", "object", "caption") or t in BLOCK:
                    break
        if name in IMPLIED:
            ends, bounds = IMPLIED[name]
            for depth in range(len(open_) - 1, 0, -1):
                t = self.tag[open_[depth]]
                if t in ends:
                    del open_[depth:]
                    break
                if t in bounds:
                    break


def _cut_marked(page: _Page, chars: list[int]) -> None:
    """Drops marked elements but those that hold the page's body.

    Comments go unless there is nothing else. Of the rest of the text, a form that holds
    half of it is the page's body; so is any other marked element that holds half of it with an
    article, main element or first heading, or nine tenths of it.
    """
    n = len(page.tag)
    for comments in (True, False):
        held, body = [0 if page.dropped[i] else chars[i] for i in range(n)], [not page.dropped[i] and page.tag[i] in ("article", "main", "h1") for i in range(n)]
        for i in range(n - 1, 0, -1):
            held[page.parent[i]] += held[i]
            body[page.parent[i]] |= body[i]
        for i in range(1, n):
            share = held[i] / held[0] if held[0] else 0.0
            if page.dropped[page.parent[i]]:
                page.dropped[i] = True
            elif comments:
                page.dropped[i] |= page.mark[i] == COMMENTS and share < 1
            elif page.mark[i] == MARKED:
                page.dropped[i] |= share < (0.5 if body[i] or page.tag[i] in WRAPPERS else 0.9)


def _densities(page: _Page, chars: list[int]) -> tuple[list[float], list[float], list[float]]:
    """Link-adjusted characters per tag of each node, and of its own text alone, from its own text's *chars*; and the share of links in each."""
    n = len(page.tag)
    link = [t == "a" for t in page.tag]
    for i in range(1, n):
        link[i] = link[i] or link[page.parent[i]]
    c, t = [0 if page.dropped[i] else chars[i] for i in range(n)], [0] * n
    lc = [c[i] if link[i] else 0 for i in range(n)]
    lt = [0] * n
    own = c[:]
    for i in range(n - 1, 0, -1):
        if not page.dropped[i]:
            p = page.parent[i]
            c[p] += c[i]
            lc[p] += lc[i]
            t[p] += t[i] + 1
            lt[p] += lt[i] + (page.tag[i] == "a")
    share = lc[0] / c[0] if c[0] else 0.0
    nodes = [_density(c[i], t[i], lc[i], lt[i], share) for i in range(n)]
    alone = [_density(own[i], 0, own[i] * link[i], link[i], share) for i in range(n)]
    return nodes, alone, [lc[i] / c[i] if c[i] else 0.0 for i in range(n)]


def _density(c: int, t: int, lc: int, lt: int, share: float) -> float:
    """Composite density of a node with *c* characters in *t* tags, of which *lc* and *lt* are of links."""
    if not c:
        return 0.0
    base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
    return c / max(1, t) * math.log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt)) + 1) / max(1.0, math.log(base) + 1)


def _select(page: _Page, chars: list[int]) -> list[bool]:
    """Which nodes hold the main text: the subtree whose children's densities sum to the most, and what belongs to it on its way to the body.

    Beside a node of that way belong headings before it and whatever is no list
    of links and either as dense as the thinnest node of the way or of the kind of the
    node itself, as one section of an article is beside another.
    """
    n = len(page.tag)
    density, sums, links = _densities(page, chars)
    for i in range(n - 1, 0, -1):
        if not page.dropped[i]:
            sums[page.parent[i]] += density[i]
    inside = [i for i in range(n) if not page.dropped[i] and density[i] > 0]
    chosen = [False] * n
    if not inside:
        return chosen
    body = next((i for i in inside if page.tag[i] == "body"), 0)
    top = max((i for i in inside if page.tag[i] not in LEAVES), key=lambda i: (sums[i], i), default=0)
    way = [top]
    while way[-1] not in (body, 0):
        way.append(page.parent[way[-1]])
    threshold = min(density[i] for i in way)
    chosen[top] = True
    on = dict(zip(way[1:], way, strict=False))  # the way's node below each node of the way
    for i in inside:
        child = on.get(page.parent[i])
        if child is None or child == i or i in on or links[i] > 0.5:
            continue
        heading = page.tag[i] in HEADINGS and i < child
        chosen[i] = heading or density[i] >= threshold or (page.tag[i] == page.tag[child] != "div")
    for i in range(1, n):
        chosen[i] = (chosen[i] or chosen[page.parent[i]]) and not page.dropped[i]
    if way[-1] != top or top == 0:  # text that lies bare beside the way
        for i in on:
            chosen[i] = chosen[i] or (chars[i] > 0 and links[i] <= 0.5 and not page.dropped[i])
    return chosen


def extract_text(source: str | None) -> str:
    """The main text of one page: blocks in page order, parted by an empty line."""
    if not source:
        return ""
    page = _Page(source)
    chars = [0] * len(page.tag)
    events = []
    for node, text in page.events:
        if text is None:
            events.append((node, text))
        elif not page.dropped[node]:
            text = html.unescape(text) if "&" in text else text
            events.append((node, text))
            chars[node] += len(text.strip())
    _cut_marked(page, chars)
    chosen = _select(page, chars)
    blocks: list[str] = []
    held: list[str] = []
    for node, text in events:
        if text is None:
            if held:
                blocks.append("".join(held))
                held = []
        elif chosen[node]:
            held.append(text)
    blocks.append("".join(held))
    clean = (" ".join(b.split()) for b in blocks)
    return "\n\n".join(b for b in clean if b)


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: *id_col*, *url_col*, text and n_chars (its code points).

    Scripts, styles, menus, footers, sidebars, controls and hidden parts go by
    their element. Forms, headers outside an article, and elements with a class, id or
    role that names something beside the article (a whole token, or a compound of
    such words alone: ``cookie-notice`` but not ``with-sidebar``) go unless they
    hold the page's body. Of the rest, every node gets its composite text density
    (characters per tag, adjusted for links); the subtree whose children's
    densities sum to the most is the main text, with those neighbours on its way
    to the body that are headings before it or as dense as the thinnest node of the way.

    Null and empty html give an empty text, and so does a page without text; a tag
    that the end of the page cuts off is no text. The whole html is read, whatever its
    length; other columns are not read; each row is judged alone, so repeated rows and
    equal ids get a row each; an empty table gives an empty result.
    """
    kind = {c: df.schema[c].dataType.simpleString() for c in (id_col, url_col)}

    def kernel(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [extract_text(h) for h in batch.column(2).to_pylist()]
            counts = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], ["a", "b", "text", "n_chars"])

    out = map_arrow(df.select(id_col, url_col, html_col), kernel, f"a {kind[id_col]}, b {kind[url_col]}, text string, n_chars long")
    return out.withColumnsRenamed({"a": id_col, "b": url_col})
