"""Main-text extraction from HTML by tree scoring.

A small tolerant reader turns a page into a tree.  Paragraph-like nodes pass
points for length and commas to their ancestors (all to the parent, half to the
grandparent, less above), every container's points are discounted by its link
density, and the best container and those of its siblings that score alike or read
as text are kept.  Text is taken block by block in page order.  Rows are
independent, so nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import map_text, text_of

SLICE_BYTES = 4 << 20
_MARK = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|itemprop|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPACE = re.compile(r"\s+")

# Element kinds (fixed values of HTML).
RAW = frozenset("script style textarea title noscript iframe template svg noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
#: Never part of the main text.
DROPPED = RAW | frozenset("head nav footer aside form menu button select input embed".split())
#: An open element that the start of another one ends, and what hides it.
CLOSES_P = BLOCKS - frozenset("option body html head".split())
HIDES_P = ("td", "th", "table", "button", "object")
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
#: An inline end tag doesn't reach out of these.
HOLDS_INLINE = ("td", "th", "table", "article", "body")
PARAGRAPHS = frozenset("p pre blockquote td li dd section h1 h2 h3 h4 h5 h6 div article main figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Kept beside the best container if they are no lists of links.
TEXT_SIBLINGS = HEADINGS | frozenset("p blockquote pre table ul ol dl figure".split())

#: Class and id words of what is never main text.
_UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|adsense|banner|sponsor(?:ed)?|promo(?:tion)?s?|comments?|commentlist|disqus|respond|replies|side-?bar|menu|nav(?:bar|igation)?|breadcrumbs?|pager|pagination|"
    r"footer|masthead|site-?header|page-?header|header|top-?bar|cookies?|consent|gdpr|notices?|newsletter|subscribe|subscription|signup|login|popup|modal|overlay|share|sharing|social|outbrain|taboola|toolbar)(?:$|[\s_-])",
    re.I,
)
#: An id with one of the words above that is none of these may be an anchor of a section of the article: such a section goes only if it is mostly links.
_NO_ANCHOR = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|adsense|banner|sponsor(?:ed)?|comments?|commentlist|disqus|respond|side-?bar|menu|nav(?:bar)?|breadcrumbs?|pager|pagination|"
    r"footer|masthead|site-?header|page-?header|top-?bar|gdpr|newsletter|signup|login|popup|modal|overlay|outbrain|taboola|toolbar)(?:$|[\s_-])",
    re.I,
)
#: Words that may name a part of the article too: such a part goes only if it is mostly links.
_DOUBTFUL = re.compile(r"(?:^|[\s_-])(?:discussion|widgets?|alert|related|recommended|more-?posts|trending|popular|tags|skip|legal|copyright|disclaimer|metadata|byline)(?:$|[\s_-])", re.I)
_LIKELY = re.compile(r"(?:^|[\s_-])(?:article|main|content|post|entry|story|body|text|page)(?:$|[\s_-]|body|text|content)", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "hint", "dropped", "doubtful", "likely", "score", "anchored")

    def __init__(self, tag: str, parent: Node | None, shown: str = "", anchor: str = ""):
        """``shown``: class, role and visibility as words; ``anchor``: the id."""
        self.tag, self.parent, self.children, self.hint, self.score = tag, parent, [], f"{shown} {anchor}".strip(), 0.0
        hint = self.hint
        self.likely = tag in ("article", "main") or bool(hint and _LIKELY.search(hint))
        named = bool(hint) and tag not in ("html", "body", "article", "main") and tag not in HEADINGS
        self.dropped = tag in DROPPED or bool(named and _UNLIKELY.search(hint) and not (self.likely and not re.search("comment|side|share|related|ad", hint, re.I)))
        self.doubtful = bool(named and _DOUBTFUL.search(hint))
        self.anchored = self.dropped and tag not in DROPPED and not _UNLIKELY.search(shown) and not _NO_ANCHOR.search(anchor)


def _hint(attributes: str) -> tuple[str, str]:
    """Class, role and visibility of an element, as words, and its id."""
    words, anchor = [], ""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                words.append("overlay")
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            words.append("overlay")
        elif name == "role":
            words.append({"navigation": "nav", "complementary": "sidebar", "contentinfo": "footer", "banner": "banner", "search": "toolbar", "alert": "alert", "dialog": "modal", "main": "main"}.get(value.lower(), ""))
        elif name == "class":
            words.append(value)
        elif name == "id":
            anchor = value
    return " ".join(words), anchor


class _Path:
    """The open elements, outermost first, and where each tag is open; every step costs what it opens or closes."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], {root.tag: [0]}

    def innermost(self, tags: Iterable[str]) -> int:
        """Depth of the innermost open element with one of the tags, -1 if none is open."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=-1)

    def open(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def close(self, depth: int) -> None:
        """Close the element at this depth and all inside it."""
        while len(self.nodes) > depth:
            self.places[self.nodes.pop().tag].pop()

    def close_within(self, tags: Iterable[str], scope: Iterable[str]) -> bool:
        """Close the innermost element of the tags, unless one of the scope lies inside it."""
        depth = self.innermost(tags)
        if depth < 1 or depth <= self.innermost(scope):
            return False
        self.close(depth)
        return True


def parse(page: str) -> Node:
    """The page's tree; texts are decoded strings among a node's children.

    Unclosed and misnested elements are mended as browsers do in the plain
    cases; a mark cut off by the page's end is dropped.
    """
    root = Node("html", None)
    path = _Path(root)
    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        mark = _MARK.match(page, start) if start >= 0 else None
        while start >= 0 and mark is None:  # a lone "<" is text
            start = page.find("<", start + 1)
            mark = _MARK.match(page, start) if start >= 0 else None
        children = path.nodes[-1].children
        if start < 0:
            children.append(html.unescape(page[at:]))
            break
        if start > at:
            children.append(html.unescape(page[at:start]))
        at = mark.end()
        tag = (mark[3] or mark[6] or "").lower()
        if mark[1] is not None:
            children.append(mark[1])
        if not tag or not page.endswith(">", start + 1, at) or tag == "html":
            continue
        if mark[2] or mark[5]:
            if not path.close_within((tag,), () if tag in BLOCKS else HOLDS_INLINE) and tag == "p":
                children.append(Node("p", path.nodes[-1]))
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in CLOSES_P:
            path.close_within(("p",), HIDES_P)
        if tag in SAME_ENDS:
            path.close_within(SAME_ENDS[tag], SCOPES[tag])
        if path.nodes[-1].tag == "head" and tag in BLOCKS:
            path.close(len(path.nodes) - 1)
        now = path.nodes[-1]
        attributes = mark[4] or mark[7] or ""
        made = Node(tag, now, *(_hint(attributes) if "=" in attributes or "hidden" in attributes else ()))
        now.children.append(made)
        if tag not in VOID:
            path.open(made)
    return root


def _blocks(node: Node, inside: bool = False) -> list[str]:
    """Texts of the blocks under a node, white space made one, in page order; dropped nodes left out.

    A header that isn't ``inside`` an article stays only if it is the text's title.
    """
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = _SPACE.sub(" ", "".join(run)).strip()
        if text:
            out.append(text)
        run.clear()

    stack: list = [(node, iter(node.children))]
    while stack:
        top, rest = stack[-1]
        child = next(rest, None)
        if child is None:
            stack.pop()
            if top.tag in BLOCKS:
                close()
        elif isinstance(child, str):
            run.append(child)
        elif child.tag in ("br", "wbr"):
            run.append(" " if child.tag == "br" else "")
        elif not (child.dropped or (child.tag == "header" and not inside and top.tag != "header" and (node.tag in ("html", "body") or not _titled(child)))):
            if child.tag in BLOCKS:
                close()
            if child.tag not in VOID:
                stack.append((child, iter(child.children)))
    close()
    return out


def _walk(root: Node) -> Iterator[Node]:
    """Nodes that can hold main text, in page order."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped]


def _text_sizes(root: Node) -> dict[int, tuple[int, int]]:
    """By node: characters of text, and those within links, without dropped nodes."""
    sizes: dict[int, tuple[int, int]] = {}
    for node in reversed(list(_walk(root))):
        text = link = 0
        for child in node.children:
            if isinstance(child, str):
                text += len(child.strip())
            elif not child.dropped:
                t, k = sizes[id(child)]
                text, link = text + t, link + k
        sizes[id(node)] = (text, text if node.tag == "a" else link)
    return sizes


def _titled(header: Node) -> bool:
    """Whether a header holds a heading and few links."""
    text, link = _text_sizes(header)[id(header)]
    return 4 * link < text and any(node.tag in HEADINGS for node in _walk(header))


def _sectioned(node: Node) -> bool:
    """Whether an element is a section, by its tag or by the heading that it starts with."""
    first = next((c for c in node.children if not isinstance(c, str) or c.strip()), None)
    return node.tag == "section" or isinstance(first, Node) and first.tag in HEADINGS


def _settle_anchors(root: Node) -> None:
    """Sections of the article whose id alone sounds like something else are kept as doubtful."""
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.likely
        for child in node.children:
            if isinstance(child, Node):
                if child.anchored and inside and _sectioned(child):
                    child.dropped, child.doubtful = False, True
                stack.append((child, inside))


def choose(root: Node) -> list[Node]:
    """The best container and the siblings kept with it, in page order; empty if the page has no text."""
    _settle_anchors(root)
    sizes = _text_sizes(root)
    doubtful = [node for node in _walk(root) if node.doubtful and 2 * sizes[id(node)][1] > sizes[id(node)][0]]
    if doubtful:
        for node in doubtful:
            node.dropped = True
        sizes = _text_sizes(root)
    scored: list[Node] = []
    for node in _walk(root):
        own = [c for c in node.children if isinstance(c, str) and c.strip()]
        inline = [c for c in node.children if isinstance(c, Node) and c.tag not in BLOCKS and not c.dropped]
        length = sum(map(len, own)) + sum(sizes[id(c)][0] for c in inline)
        if node.tag not in PARAGRAPHS and node.tag not in ("html", "body") or not length:
            continue
        commas = sum(c.count(",") for c in own)
        points = 1 + commas + min(length / 100, 3)
        text, link = sizes[id(node)]
        points *= 1 - (link / text if text else 0)
        up, share = node if node.tag in ("div", "section", "article", "main", "body", "html") else node.parent, 1.0
        depth = 0
        while up is not None and depth < 5:
            if not up.score:
                scored.append(up)
                up.score = 25.0 * up.likely
            up.score += points * share
            depth += 1
            share = 0.5 if depth == 1 else 1 / (3 * depth)
            up = up.parent
    if not scored:
        return []
    weight = lambda node: node.score * (1 - (sizes[id(node)][1] / sizes[id(node)][0] if sizes[id(node)][0] else 0))
    best = max(scored, key=weight)
    # An article or main element around the best container is the container meant.
    up = best
    while up is not None:
        if up.tag in ("article", "main"):
            best = up
            if up.tag == "article":
                break
        up = up.parent
    if best.parent is None or best.tag in ("body", "main"):
        return [best]
    top, kept = weight(best), []
    if best.tag == "article":  # a text in several articles
        return [x for x in best.parent.children if x is best or isinstance(x, Node) and x.tag == "article" and not x.dropped and weight(x) >= max(10, 0.2 * top)]
    for child in best.parent.children:
        if isinstance(child, Node) and not child.dropped:
            text, link = sizes[id(child)]
            density = link / text if text else 1
            alike = child.hint and child.hint == best.hint
            if child is best or weight(child) + (0.2 * top if alike else 0) >= max(10, 0.2 * top) or (child.tag in TEXT_SIBLINGS and text and density < 0.25):
                kept.append(child)
    return kept


def main_text(page: str) -> str:
    """The main text of one page: its blocks joined by an empty line."""
    blocks: list[str] = []
    for node in choose(parse(page)):
        blocks += _blocks(node, inside=node.tag == "article")
    return "\n\n".join(blocks)


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text ('' if there is none).

    Null and empty pages have no text; repeated rows are extracted alike; an
    empty table gives no rows; other columns are ignored.  The work on a page
    is linear in its length, however deeply it nests.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(x) for x in part.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(texts, pa.string())], ["page_id", "url", "text"])

        yield from map_text(batches, SLICE_BYTES, work)

    rows = df.select(F.col(id_col).cast("long").alias("page_id"), text_of(html_col).alias("html"), F.col(url_col).cast("string").alias("url"))
    return rows.mapInArrow(run, "page_id long, url string, text string")
