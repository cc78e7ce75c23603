"""HTML extraction: the main text of a page by composite text density."""

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrowtext import slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)",
    re.S,
)
#: The rest of a start tag: a quote counts only as an attribute's value, and is then closed.
_TAG_END = re.compile(r"((?:[^>=]|=\s*+(?:\"[^\"]*\"|'[^']*'|(?![\"'])))*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = {"script", "style", "xmp", "noembed", "noframes"}
_RAW_TEXT = {"textarea", "title"}
_CLOSE = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for t in _RAW | _RAW_TEXT}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav"
    " ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINERS = set("article main section div body td blockquote center figure dl ul ol table".split())
#: A start tag of the key closes an open element of the value, unless one of a wider kind is open.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
#: Elements that are never part of the main text.
_NEVER = set(
    "head script style noscript template nav footer aside button select textarea input label"
    " iframe object embed applet canvas audio video svg math map dialog menu datalist title"
    " xmp noembed noframes".split()
)
_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar"
    " toolbar tablist status note".split()
)
#: Words of a class or id that name what stands around an article.
_AROUND = set(
    "nav navbar navigation menu menubar sidebar aside ad ads adv advert adverts advertisement"
    " advertising adsense sponsor sponsored sponsors promo promos promotion banner cookie cookies"
    " consent gdpr notice notices notification alert comment comments commentlist disqus replies"
    " breadcrumb breadcrumbs share sharing social related recommended recommendations newsletter"
    " subscribe subscription popup modal overlay login signin signup widget widgets toolbar"
    " pagination pager footer footnav colophon masthead topbar skip teaser teasers".split()
)
_AROUND_OUTSIDE = {"header"}
#: Elements that may stand around an article or wrap it, and are set aside as a name would do it.
_WRAPPERS = {"form", "fieldset"}
#: A text with fewer characters outside links is not an article's.
_LEAST_CHARS = 200
_WORD = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class _Node:
    __slots__ = (
        "tag", "parent", "outside", "in_article", "parts", "chars", "tags", "link_chars",
        "link_tags", "density", "total", "named",
    )

    def __init__(self, tag, parent, outside, in_article):
        self.tag, self.parent, self.outside, self.in_article = tag, parent, outside, in_article
        self.parts = []  # texts and nodes in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.named = 0  # 1: of _WRAPPERS, or a class or id has a word of _AROUND, 2: begins with one


def _standing(tag, attributes, in_article):
    """Whether an element is never main text, and how its class and id name it."""
    if tag in _NEVER or (tag == "header" and not in_article):
        return True, 0
    named = 1 if tag in _WRAPPERS else 0
    if tag in ("html", "body", "main") or not attributes:
        return False, named
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), html.unescape(a or b or c).lower())
    if "hidden" in found or found.get("aria-hidden") == "true":
        return True, 0
    if found.get("role") in _ROLES or _HIDDEN.search(found.get("style", "")):
        return True, 0
    around = _AROUND if in_article else _AROUND | _AROUND_OUTSIDE
    for token in (found.get("class", "") + " " + found.get("id", "")).split():
        words = [w.rstrip("0123456789") for w in _WORD.findall(token)]  # "ad-3" and "ad3" alike
        if words and words[0] in around:
            return False, 2
        if not around.isdisjoint(words):
            named = 1
    return False, named


def _set_named_aside(root):
    """Names put a subtree aside if it cannot be the main text: if it has no more than half of the
    page's characters outside links, or few, or an article elsewhere has enough of its own. What
    holds an article goes only in the last case, and what holds <main> never."""
    order, pending = [], [(root, False, False)]
    # Characters outside links, whether there is an article or <main>, and characters of articles
    # that no name within the article puts aside.
    below = {}
    while pending:
        node, link, named = pending.pop()
        order.append(node)
        link = link or node.tag == "a"
        if node.tag in ("article", "main"):
            named = node.named == 2
        else:
            named = named or node.named > 0
        chars = 0 if link else sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        free = chars if node.in_article and not named else 0
        below[node] = [chars, node.tag == "article", node.tag == "main", free]
        pending += [(p, link, named) for p in node.parts if isinstance(p, _Node) and not p.outside]
    for node in reversed(order):
        if node.parent is not None:
            above, own = below[node.parent], below[node]
            above[0] += own[0]
            above[1], above[2] = above[1] or own[1], above[2] or own[2]
            above[3] += own[3]
    for node in order:
        if node.named:
            chars, article, main, free = below[node]
            others = below[root][3] - free
            elsewhere = others >= _LEAST_CHARS
            if main:
                continue
            if article:
                node.outside = elsewhere and others > free and node.named == 2
            else:
                node.outside = elsewhere or chars < _LEAST_CHARS or 2 * chars <= below[root][0]


def parse(page: str) -> _Node:
    """A tree of the page's elements; missing end tags are supplied where HTML lets them be left
    out, and end tags without a start are ignored."""
    root = _Node("html", None, False, False)
    stack, at, size, quotes, any_named = [root], 0, len(page), True, False
    match = _TOKEN.search
    while at < size:
        found = match(page, at)
        if not found:
            stack[-1].parts.append(html.unescape(page[at:]))
            break
        if found.start() > at:
            stack[-1].parts.append(html.unescape(page[at : found.start()]))
        at = found.end()
        end, start = found.groups()
        if end:
            end = end.lower()
            if end in ("html", "body"):
                continue
            if end == "br":
                stack[-1].parts.append(" ")
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == end:
                    del stack[i:]
                    break
                # The end of an inline element does not reach out of a block.
                if end not in _BLOCKS and stack[i].tag in _BLOCKS:
                    break
        elif start:
            tag = start.lower()
            rest = _TAG_END.match(page, at) if quotes else None
            if rest:
                attributes, at = rest.group(1), rest.end()
            else:  # a quote is never closed: from here on tags end at the next bracket
                quotes, close = False, page.find(">", at)
                if close < 0:
                    stack[-1].parts.append(html.unescape(page[found.start() :]))
                    break
                attributes, at = page[at:close], close + 1
            if tag == "html" or (tag == "body" and stack[-1].tag == "body"):
                continue
            if tag in _BLOCKS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        del stack[i:]
                        break
                    if stack[i].tag in _BLOCKS or stack[i].tag == "button":
                        break
            if tag in _CLOSES:
                closed, within = _CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in closed:
                        del stack[i:]
                        # a row's start also closes the row of the cell
                        if tag == "tr" and stack[-1].tag == "tr":
                            del stack[-1]
                        break
                    if stack[i].tag in within:
                        break
            parent = stack[-1]
            outside, named = _standing(tag, attributes, parent.in_article)
            outside = parent.outside or outside
            node = _Node(tag, parent, outside, parent.in_article or tag in ("article", "main"))
            node.named = named
            any_named = any_named or (named and not outside)
            parent.parts.append(node)
            if tag in _RAW or tag in _RAW_TEXT:
                close = _CLOSE[tag].search(page, at)
                at = close.end() if close else size
            elif tag not in _VOID:
                stack.append(node)
        elif found.group().startswith("<![CDATA["):
            stack[-1].parts.append(found.group()[9:].removesuffix("]]>"))
    if any_named:
        _set_named_aside(root)
    return root


def _measure(root):
    """Counts of characters, tags and their share in links, then densities, bottom up."""
    order, pending = [], [root]
    while pending:
        node = pending.pop()
        order.append(node)
        pending += [p for p in node.parts if isinstance(p, _Node) and not p.outside]
    for node in reversed(order):
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len("".join(part.split()))
            elif not part.outside:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.chars if part.tag == "a" else part.link_chars
                node.link_tags += 1 if part.tag == "a" else part.link_tags
    body_share = root.link_chars / max(root.chars, 1)
    for node in reversed(order):
        c, t = node.chars, max(node.tags, 1)
        lc, lt = max(node.link_chars, 1), max(node.link_tags, 1)
        if c:
            base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + body_share * c + math.e)
            ratio = max(c / lc * t / lt, 1.0)
            node.density = c / t * math.log(ratio) / math.log(max(base, 1.0001)) if base > 1 else c / t
        inner = [p for p in node.parts if isinstance(p, _Node) and not p.outside]
        direct = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        node.total = sum(p.density for p in inner) + direct
    return order


def _main_node(root):
    """The container whose children's densities have the greatest sum, widened on the way to the
    body as far as what is added is as dense as the least dense node of that way. An <article> or
    <main> on that way is where to stop, but for more articles beside it."""
    candidates = [n for n in _measure(root) if n.tag in _CONTAINERS and n.chars]
    if not candidates:
        return root
    best = max(candidates, key=lambda n: n.total)
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path if n.tag != "html" or n is best)
    for k, node in enumerate(path):
        if node.tag == "main":
            return node
        if node.tag == "article":
            return _with_sibling_articles(path[k:], threshold)
    for node in path[1:]:
        if node.tag in ("html", "body"):
            break
        added = dense = 0
        for p in node.parts:
            if isinstance(p, _Node) and not p.outside and p is not best:
                added += p.chars
                if p.density >= threshold and p.link_chars * 3 < p.chars:
                    dense += p.chars
        if added and 2 * dense < added:
            break
        best = node
    return best


def _with_sibling_articles(path, threshold):
    """The first node of the path, an article, or the widest on the way to the body of which most
    that is added are articles as dense as the threshold and not mostly links."""
    best, holds = path[0], {}
    order = [path[-1]]
    for node in order:
        order += [p for p in node.parts if isinstance(p, _Node) and not p.outside]
    for node in reversed(order):
        inner = (p for p in node.parts if isinstance(p, _Node) and not p.outside)
        holds[node] = node.tag == "article" or any(holds[p] for p in inner)
    added = dense = 0
    for below, node in zip(path, path[1:]):
        for p in node.parts:
            if isinstance(p, str):
                added += len("".join(p.split()))
            elif not p.outside and p is not below:
                added += p.chars
                if holds[p] and p.density >= threshold and p.link_chars * 3 < p.chars:
                    dense += p.chars
        if dense and 2 * dense >= added:
            best = node
        if node.tag in ("main", "body"):
            break
    return best


def _blocks(top):
    """The texts of a subtree's blocks in page order, white space as single spaces."""
    blocks, run = [], []

    def end_block():
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    pending = [(top, False)]
    while pending:
        part, leaving = pending.pop()
        if isinstance(part, str):
            run.append(part)
        elif leaving:
            end_block()
        elif not part.outside:
            if part.tag == "br":
                run.append(" ")
                continue
            if part.tag in _BLOCKS:
                end_block()
                pending.append((part, True))
            pending += [(p, False) for p in reversed(part.parts)]
    end_block()
    return blocks


def main_text(page: str | None) -> str:
    """The main text of a page: its blocks in page order, one per line; empty if there is none."""
    if not page:
        return ""
    return "\n".join(_blocks(_main_node(parse(page))))


def _extracted(batches):
    for batch in batches:
        for part in slices(batch, "html"):
            texts = [main_text(page) for page in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text`` of every page.

    A page becomes a tree of elements. Elements that are never main text (menus, forms, scripts,
    and what its role names as standing around an article) are set aside. So is what a class or id
    names so, unless it may be the main text itself: it holds most of the page, or the article. Every other
    node gets its link-adjusted characters per tag; the container with the greatest sum over its
    children is the main text, widened towards the body by the least density on that path.

    A null or empty page, or one without text, gives an empty text. Repeated rows are extracted
    each; null ids and urls stay. An empty table gives an empty table; other columns are ignored.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return rows.mapInArrow(_extracted, "page_id bigint, url string, text string")
