"""Main-text extraction by composite text density.

A page becomes a DOM of its block elements (inline tags only count as tags). Every node gets the characters and tags
of its subtree and the share of them inside links; its density is the characters per tag, lowered by a logarithm that
grows with the share of link text. A node's density sum is the sum over its children. The node with the largest sum
is the core; the smallest density on the path from the core up to ``body`` is the threshold, and what stands beside
that path joins the core if it reaches the threshold. Inside the nearest article, main or post element around the core
everything joins it, however short, but blocks that are mostly links and below the threshold; without such an element
the titles (``h1``) beside the path join it.

Scripts, styles, forms, menus, asides, page headers and footers, and elements whose class, id or role names them as
adverts, notices, side bars or comments hold no text of the article: they count as empty and are never output. Layout
wrappers have such words in their class too, so elements named so are spared if they hold most of the page's text and
its title, main element or single article, or if next to nothing stands outside them.

Output: the blocks of the chosen subtrees in page order, character references decoded, white space inside a block
turned into one space and trimmed, blocks joined by an empty line. The whole page is read; nothing is capped.

Defined results: null and empty pages, and pages without text, give the empty string; text outside any element counts
as a block of ``body``; ties of the density sum go to the outer, then the earlier node; equal rows get equal texts;
unclosed and stray tags are mended as browsers do for blocks; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.sources.tables import table

# fixed values: element names by their role in HTML
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
DROPPED = frozenset("aside button datalist dialog fieldset footer form frameset head legend menu nav optgroup option select".split())
ENDED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "tbody": frozenset(["tbody", "thead", "tr", "td", "th"]),
}
SCOPE = frozenset("ul ol dl table body html article section div main".split())
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|side-?bar|cookies?|consent|notices?|gdpr|pop-?up|modal|newsletter|subscribe|subscription|"
    r"menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|site-?header|page-?header|toolbar|comments?|comment-?list|respond|replies|disqus|related|recommended|"
    r"share|sharing|social|widget|pagination|pager|login|search|skip-?link)(?:$|[\s_-])",
    re.I,
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?""")
POST = re.compile(r"(?:^|\s)(?:post|h-?entry|entry|article|story|blog-?post|news-?article|post-\d+)(?:$|\s)", re.I)  # whole classes only
TINY = 100  # characters outside the named elements that are no article, if they are also under 1 / TINY_SHARE of these
TINY_SHARE = 20


class Node:
    __slots__ = ("name", "parent", "parts", "chars", "tags", "link_chars", "link_tags", "density", "sum", "dropped", "away", "post")

    def __init__(self, name: str, parent: Node | None, dropped: bool = False):
        self.name, self.parent, self.dropped = name, parent, dropped
        self.away: str | None = None  # class, id or part of it that names the element as no part of an article
        self.post = False  # holds one article with all that belongs to it
        self.parts: list[str | Node] = []  # text runs and child nodes in page order
        self.chars = self.link_chars = self.link_tags = 0
        self.tags = 0
        self.density = self.sum = 0.0


def _named_away(name: str, attributes: str, inside: bool) -> bool | str:
    """Whether an element is no part of an article, or the class or id that says so; ``inside``: it stands in an
    article or main element."""
    if name in DROPPED or name == "header" and not inside:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    away: bool | str = False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "role" and value.lower() in ROLES:
            return True
        if not away and key in ("class", "id") and NAMED.search(value):
            away = next((t for t in value.lower().split() if NAMED.search(t)), value)
    return away


def parse(page: str) -> Node:
    """The block tree of a page."""
    body = Node("body", None)
    at, link, articles = body, 0, 0
    pos, n = 0, len(page)
    while pos < n:
        m = _TAG.search(page, pos)
        text = page[pos : m.start()] if m else page[pos:]
        if text and not at.dropped:
            at.parts.append(text)
            if link:
                at.link_chars += len("".join(text.split()))
        if not m:
            break
        pos = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA[") and not at.dropped:
                at.parts.append(html.escape(m[0][9 : -3 if m[0].endswith("]]>") else None]))
            continue
        name, closing, attributes = name.lower(), m[1] or m[4], m[3] or m[6] or ""
        if name in RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(page, pos)
                pos = end.end() if end else n
            continue
        if name not in BLOCKS:
            if name == "a":
                link = 0 if closing else 1
                at.link_tags += not closing
            if name == "br" and not at.dropped:
                at.parts.append(" ")
            at.tags += not closing
            continue
        if name in ("html", "body"):
            continue
        if closing:
            up = at
            while up.parent is not None and up.name != name and not (name in ("p", "li") and up.name in SCOPE and up.name != name):
                up = up.parent
            if up.name == name and up.parent is not None:
                articles -= name in ("article", "main")
                at, link = up.parent, 0
            continue
        if name == "hr":
            at.parts.append(Node("hr", at))
            continue
        # an open paragraph ends where a block begins; list items, cells and the like end their kind
        up = at
        while up.parent is not None and up.name not in SCOPE:
            if up.name == "p" or up.name in ENDED_BY.get(name, ()) or re.fullmatch("h[1-6]", name) and re.fullmatch("h[1-6]", up.name):
                at = up.parent
            up = up.parent
        articles += name in ("article", "main")
        away = _named_away(name, attributes, articles > 0)
        child = Node(name, at, at.dropped or away is True)
        child.away = away if isinstance(away, str) else None
        child.post = name in ("article", "main") or any(k.lower() in ("class", "id") and POST.search(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes))
        at.parts.append(child)
        at, link = child, 0
    return body


def _layout_only(token: str) -> bool:
    """Whether a class holds other words besides those that name it, as ``has-sidebar`` does and ``comments`` does not."""
    return any(w and not NAMED.fullmatch(w) for w in re.split("[_-]", token)) and not NAMED.fullmatch(token)


def settle(order: list[Node]) -> None:
    """Drop the elements that are named away, but for those that wrap the article. Elements of one class are judged
    together. Expects each node's own characters."""
    body, groups = order[0], {id(order[0]): frozenset()}
    members: set[str] = set()
    for n in order[1:]:
        groups[id(n)] = groups[id(n.parent)]
        if n.away and not n.dropped and n.away not in groups[id(n)]:
            members.add(n.away)
            groups[id(n)] |= {n.away}
    if not members:
        return
    titled, articles = {t: False for t in members}, {t: 0 for t in members}
    for n in order:
        if not n.dropped and n.name in ("h1", "main", "article"):
            for t in groups[id(n)]:
                titled[t] |= n.name != "article"
                articles[t] += n.name == "article"
    headed = {t for t in members if titled[t] or articles[t] == 1}
    text = {id(n): 0 if n.dropped else max(0, n.chars - n.link_chars) for n in order}

    def most(without: set[str]) -> tuple[int, set[str]]:
        """The text outside ``without`` and the classes that hold more than half of it."""
        whole, held = 0, dict.fromkeys(members, 0)
        for n in order:
            if text[id(n)] and not groups[id(n)] & without:
                whole += text[id(n)]
                for t in groups[id(n)]:
                    held[t] += text[id(n)]
        return whole, {t for t in members if 2 * held[t] > whole}

    spared = most(members - headed)[1] & headed
    if not spared:
        strong = {t for t in members if not _layout_only(t)}
        outside, (whole, held) = most(members)[0], most(strong)
        if outside < TINY and outside * TINY_SHARE < whole:
            spared = held
    for n in order:
        if n is not body and (n.parent.dropped or n.away and n.away not in spared):
            n.dropped = True


def measure(body: Node) -> list[Node]:
    """Fill in sizes and densities; nodes in page order. No recursion, since pages may nest without end."""
    order, todo = [], [body]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [p for p in reversed(node.parts) if isinstance(p, Node)]
    for node in order:
        node.chars = sum(len("".join(html.unescape(p).split())) for p in node.parts if isinstance(p, str))
        node.tags += 1
    settle(order)
    for node in reversed(order):
        if node.dropped:
            node.chars = node.link_chars = 0
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.link_chars += node.link_chars
            if not node.dropped:
                up.tags += node.tags
                up.link_tags += node.link_tags
    whole, linked = max(1, body.chars), body.link_chars
    for node in order:
        c, t, lc, lt = node.chars, max(1, node.tags), node.link_chars, node.link_tags
        if not c:
            continue
        base = math.log(c / max(1, c - lc) * lc + linked / whole * c + math.e)
        node.density = c / t * math.log(max(math.e, c / max(1, lc) * t / max(1, lt))) / max(1.0, base)
    for node in reversed(order):
        if node.parent is not None:
            node.parent.sum += node.density
    return order


def choose(order: list[Node]) -> list[Node]:
    """The chosen subtrees, in page order."""
    body = order[0]
    core = max((n for n in order if n.chars), key=lambda n: n.sum or 0.0, default=None)
    if core is None:
        return []
    if not core.sum:  # no block inside any block: the text stands in leaves, the densest is the core
        core = max(order, key=lambda n: n.density)
    path = [core]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    on_path = {id(n) for n in path}
    top = next((i for i, n in enumerate(path) if n.post), 0)
    for n in path[1 : top + 1]:
        for p in n.parts:
            if isinstance(p, Node) and id(p) not in on_path and 2 * p.link_chars > p.chars and p.density < threshold:
                p.dropped = True
    chosen, titles = {id(path[top])}, not any(n.post for n in path)
    for n in path[top + 1 :]:
        chosen |= {
            id(p)
            for p in n.parts
            if isinstance(p, Node) and id(p) not in on_path and p.density > 0 and (p.density >= threshold or titles and p.name == "h1")
        }
    return [n for n in order if id(n) in chosen] if core is not body else [body]


def block_texts(node: Node) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            out.append(text)

    todo: list[str | Node | None] = [node]
    while todo:
        part = todo.pop()
        if part is None:
            flush()
        elif isinstance(part, str):
            run.append(part)
        elif not part.dropped:
            flush()
            todo.append(None)
            todo += reversed(part.parts)
    flush()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n\n".join(b for node in choose(measure(parse(page))) for b in block_texts(node))


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html)`` -> ``(page_id, url, text)``."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 64):
                part = b.slice(k, 64)
                texts = pa.array([main_text(h) for h in part.column(2).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], names=["page_id", "url", "text"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
