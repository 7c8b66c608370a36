"""Main text of web pages by a minimum cut through the page's tree between content and boilerplate."""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import ship_package

#: Elements whose content is code, to the end of the page if they are not closed.
_CODE = frozenset("script style".split())
#: Elements whose content is never text; without an end tag only the start tag is passed over.
_SILENT = frozenset("noscript template svg math iframe object canvas textarea select title".split())
#: Elements inside a block that do not end it.
_INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements and roles that hold boilerplate by what they are, and those that hold the article.
_BOILER = frozenset("nav footer aside form menu dialog button fieldset option optgroup".split())
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
_MAIN = frozenset("article main".split())
#: Parts of class and id names that speak for boilerplate, those that say nothing, and names that speak for content.
#: A name counts as a whole: "site-footer" is one, "has-sidebar" and "social-history" are not.
_BAD = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice gdpr popup modal newsletter subscribe subscription sidebar "
    "menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments reply replies disqus related recommended recommendations share sharing social "
    "widget pagination pager login signup search toolbar copyright legal disclaimer".split()
)
_NEUTRAL = frozenset(
    "left right top bottom site page global box wrapper wrap container inner outer area bar block list item items links icons buttons posts slot unit section group panel main primary secondary form "
    "col column columns row cell zone region module mobile desktop sticky fixed floating mini mega rail reader readers user users visitor visitors guest latest recent popular thread count".split()
)
#: Last parts of names that speak for boilerplate whatever stands before them, as in "article-comments", unless the name only
#: tells whether there are any, as "has-sidebar" does.
_BAD_LAST = frozenset("comments comment disqus sidebar footer navbar breadcrumb breadcrumbs newsletter advert adverts cookie cookies pagination".split())
_WHETHER = frozenset("has with no without is show hide hidden".split())
_GOOD = frozenset("article content post story entry article-body article-content post-content post-body entry-content story-body main-content content-body".split())
_ATTR = r"[\s/]++|=?+[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)?+)?+"
_TAG = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</[^A-Za-z][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attrs>(?:{_ATTR})*+)(?:>|\Z)", re.DOTALL)
_NAMES = re.compile(r"(?:\A|(?<=[\s/\"']))(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
#: These close an open p; li and the like close their own kind.
_CLOSES_SELF = frozenset("p li dt dd tr td th option".split())
#: Elements whose only text is one block; such a block stands for its element.
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figcaption caption summary address".split())
#: Parts of text that belong to what is around them, unlike the sections of a page.
_TEXTUAL = _LEAF | frozenset("ul ol dl table thead tbody tfoot tr figure details hr".split())

#: Smoothness: neighbours in page order, the same below different parents, parts of a text and their parent, the same inside the
#: article, page sections.
NEXT, ACROSS, PART, INSIDE, LOOSE = 0.6, 0.2, 3.0, 4.0, 0.5
#: The same on a page that marks no article, between a text and a plain section around it, and one that is named as content.
SECTION, NAMED = 0.3, 1.5
#: A text's own log-odds stay inside this, so that a tie to its parent can outweigh them.
OWN = 2.5
#: Log-odds of an element that is boilerplate or article by itself, and for each block below it.
FIRM, EACH = 6.0, 3.0
#: The same of a form outside the article, which may be the frame of a whole page: enough text in it outweighs that.
FRAME = 3.0


_PAGE = frozenset(["", "html", "body"])


class Element:
    """A block-level element: its tag, its parent's number, and what its tag, role and names say (-1, 0, 0.3 or 1)."""

    __slots__ = ("tag", "parent", "says")

    def __init__(self, tag: str, parent: int, says: float) -> None:
        self.tag, self.parent, self.says = tag, parent, says


class Block:
    __slots__ = ("text", "element", "link_chars")

    def __init__(self, text: str, element: int, link_chars: int) -> None:
        self.text, self.element, self.link_chars = text, element, link_chars


def _is_bad(name: str) -> bool:
    parts = [p for p in re.split(r"[-_]+|\d+", name) if p]
    if len(parts) > 1 and parts[-1] in _BAD_LAST and parts[0] not in _WHETHER:
        return True
    return any(p in _BAD for p in parts) and all(p in _BAD or p in _NEUTRAL for p in parts)


def says(tag: str, attrs: str) -> float:
    """-1: boilerplate, 1: the article, 0.3: rather content, 0: nothing."""
    if tag in ("html", "body"):
        return 0.0
    role, names = "", []
    for kind, *value in _NAMES.findall(attrs):
        words = next((v for v in value if v), "").lower().split()
        if kind.lower() == "role":
            role = words[0] if words else ""
        else:
            names += words
    if tag in _BOILER or role in _BOILER_ROLES or any(map(_is_bad, names)):
        return -1.0
    if tag in _MAIN or role in _MAIN:
        return 1.0
    return 0.3 if any(n in _GOOD for n in names) else 0.0


def _silent_end(page: str, name: str, at: int) -> int | None:
    """Where a silent element that began before `at` ends, those of its kind inside it included."""
    depth = 1
    for m in re.compile(rf"<(/?){name}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).finditer(page, at):
        depth += -1 if m[1] else not m[0].endswith("/>")
        if not depth:
            return m.end()
    return None


def blocks_of(page: str) -> tuple[list[Element], list[Block]]:
    """The page's block-level elements (number 0 is the page itself) and its text blocks, both in order."""
    elements = [Element("", 0, 0.0)]
    stack: list[tuple[str, int]] = []  # (tag, element; -1 for inline ones)
    out: list[Block] = []
    parts: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            out.append(Block(text, next((e for _, e in reversed(stack) if e >= 0), 0), min(links, len(text))))
        links = 0

    at, n, in_link = 0, len(page), 0
    never: set[str] = set()  # silent elements that are not closed again
    while at < n:
        m = _TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            parts.append(page[at:end])
            if in_link:
                links += end - at
        if not m:
            break
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if m["close"]:
            if name in _INLINE:
                in_link = max(0, in_link - (name == "a"))
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        del stack[k]
                        break
                    if stack[k][0] not in _INLINE:
                        break
                continue
            flush()
            in_link = 0
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in _CODE:
            close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = close.end() if close else n
            continue
        if name in _SILENT:
            if name not in never and not m["attrs"].rstrip().endswith("/"):
                to = _silent_end(page, name, at)
                if to is None:
                    never.add(name)
                else:
                    at = to
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name == "a":
            in_link += 1
        if name not in _INLINE:
            flush()
            in_link = 0
            for k in range(len(stack) - 1, -1, -1):  # elements whose end tag may be left out
                t = stack[k][0]
                if t in _INLINE:
                    continue
                if t == "p" or (t == name and name in _CLOSES_SELF):
                    del stack[k:]
                break
            while stack and stack[-1][0] in _INLINE:  # a new block ends open inline formatting
                stack.pop()
        if name in _VOID:
            continue
        if name in _INLINE:
            stack.append((name, -1))
            continue
        elements.append(Element(name, next((e for _, e in reversed(stack) if e >= 0), 0), says(name, m["attrs"] or "")))
        stack.append((name, len(elements) - 1))
    flush()
    return elements, out


def log_odds(b: Block, tag: str) -> float:
    """How much a text looks like content by itself: long, few links, with sentence marks; at most OWN either way."""
    length, links = len(b.text), b.link_chars / len(b.text)
    z = -1.2 + 0.7 * math.log10(1 + length) - 3.0 * links + 0.6 * (b.text[-1] in ".!?:…\"'”»)") + 0.3 * (tag in ("p", "h1", "h2", "h3", "blockquote", "pre"))
    return max(-OWN, min(OWN, z))


def costs(z: float) -> tuple[float, float]:
    """(cost of calling it boilerplate, cost of calling it content): the two log-losses at log-odds z."""
    small = math.log1p(math.exp(-abs(z)))
    return max(z, 0.0) + small, max(-z, 0.0) + small


def page_graph(elements: list[Element], blocks: list[Block]) -> tuple[list[tuple[float, float]], list[tuple[int, int, float]]]:
    """(capacities, edges) of a page: nodes are its blocks, then its elements.

    A block's capacities come from its text alone, an element's from its tag, role and names, with a weight for each
    block below it. What an element says reaches the texts only over edges: from each node to its parent, and from
    each block to the next one, less so across parents where no article is marked.
    """
    below, children, texts = ([0] * len(elements) for _ in range(3))
    for b in blocks:
        below[b.element] += 1
        texts[b.element] += 1
    inside = [False] * len(elements)
    for i, e in enumerate(elements):
        inside[i] = e.says == 1.0 or (i > 0 and inside[e.parent])
        children[e.parent] += i > 0
    for i in range(len(elements) - 1, 0, -1):
        below[elements[i].parent] += below[i]
    first = len(blocks)
    marked = any(e.says == 1.0 for e in elements)
    z = [log_odds(b, elements[b.element].tag) for b in blocks] + [0.0] * len(elements)
    for i, e in enumerate(elements):
        if e.tag == "form" and not inside[i] and not marked:
            z[first + i] = -FRAME
        elif e.says in (-1.0, 1.0):
            z[first + i] = e.says * (FIRM + EACH * below[i])
        elif e.tag == "header":  # the page's own, or the article's
            z[first + i] = -3.0 if inside[i] else -3.0 - EACH * below[i]
        else:
            z[first + i] = e.says * (3.0 + below[i])
    # a page that marks its article has the rest as boilerplate, another one has it as content
    z[first] = -3.0 - EACH * texts[0] if marked else 2.0 + LOOSE * sum(children[i] for i, e in enumerate(elements) if e.tag in _PAGE)
    alone = [e.tag in _LEAF and e.says == 0.0 and not children[i] and texts[i] == 1 for i, e in enumerate(elements)]

    def tie(child: str, parent: int) -> float:
        """On a page without a marked article the texts say what is content: what they share is a section at most, and a strong
        tie to it would let a list of links outvote the paragraphs beside it."""
        if inside[parent]:
            return INSIDE
        if elements[parent].says == -1.0 or (child in _TEXTUAL and (marked or elements[parent].tag in _TEXTUAL)):
            return PART
        if not marked and child in _PAGE:
            return PART
        return LOOSE if marked else NAMED if elements[parent].says > 0 else SECTION

    above = [elements[b.element].parent if alone[b.element] else b.element for b in blocks]
    edges = [(i - 1, i, NEXT if marked or above[i - 1] == above[i] else ACROSS) for i in range(1, len(blocks))]
    for i, b in enumerate(blocks):
        e = b.element
        if alone[e]:  # the block stands for its element
            edges.append((i, first + elements[e].parent, tie(elements[e].tag, elements[e].parent)))
        else:
            edges.append((i, first + e, INSIDE if inside[e] else PART if marked or elements[e].tag in _TEXTUAL | _PAGE or elements[e].says == -1.0 else NAMED if elements[e].says > 0 else SECTION))
    for i, e in enumerate(elements):
        if i and below[i] and not alone[i]:
            edges.append((first + i, first + e.parent, tie(e.tag, e.parent)))
    return [costs(x) for x in z], edges


def min_cut(capacity: list[tuple[float, float]], edges: list[tuple[int, int, float]]) -> list[bool]:
    """capacity: per node (from source, to sink); edges: undirected. Nodes on the source side of a minimum cut.

    Augmenting paths by Dinic's levels. The part of both terminal capacities that a node's own path carries is taken
    out at first, so nodes that agree with their neighbours need no search.
    """
    n = len(capacity)
    src, dst = n, n + 1
    to: list[int] = []
    left: list[float] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def arc(a: int, b: int, c: float, back: float) -> None:
        at[a].append(len(to))
        to.append(b)
        left.append(c)
        at[b].append(len(to))
        to.append(a)
        left.append(back)

    for i, (s, t) in enumerate(capacity):
        if s > t:
            arc(src, i, s - t, 0.0)
        elif t > s:
            arc(i, dst, t - s, 0.0)
    for a, b, c in edges:
        arc(a, b, c, c)
    eps = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[src] = 0
        queue = deque([src])
        while queue:
            u = queue.popleft()
            for e in at[u]:
                if left[e] > eps and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[dst] < 0:
            return [level[i] >= 0 for i in range(n)]
        nxt = [0] * (n + 2)
        path: list[int] = []
        u = src
        while True:
            if u == dst:
                flow = min(left[e] for e in path)
                for e in path:
                    left[e] -= flow
                    left[e ^ 1] += flow
                k = next(i for i, e in enumerate(path) if left[e] <= eps)
                u = to[path[k] ^ 1]
                del path[k:]
                continue
            while nxt[u] < len(at[u]):
                e = at[u][nxt[u]]
                if left[e] > eps and level[to[e]] == level[u] + 1:
                    break
                nxt[u] += 1
            if nxt[u] < len(at[u]):
                path.append(at[u][nxt[u]])
                u = to[at[u][nxt[u]]]
            elif path:
                level[u] = -1
                u = to[path.pop() ^ 1]
            else:
                break


def main_text(page: str) -> str:
    """The page's content blocks in order, one per line."""
    elements, blocks = blocks_of(page)
    if not blocks:
        return ""
    # nodes that the cut leaves undecided (equal costs, no flow) are boilerplate
    keep = min_cut(*page_graph(elements, blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=False) if k)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(t.as_py() or "") for t in b.column("html")]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text), one row per page, from the whole html; null or empty html gives an empty text. No shuffle."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(_text_batches, "page_id long, url string, text string")


def op8_html(pages: DataFrame) -> DataFrame:
    """The contract's columns: page_id, url, text, n_chars."""
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
