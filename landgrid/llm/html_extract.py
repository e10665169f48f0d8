"""Main-text extraction from HTML by tree scoring.

A tolerant parser builds a tree; elements that are never article text (menus,
page headers and footers, sidebars, notices, adverts, forms, scripts, reader
comments) are cut; every paragraph passes points for its length and commas to
its ancestors; a container's score is discounted by its link density; the best
container and those of its siblings that belong to it are kept.

Defined results: null, empty or markup-only html gives "" (never null); pages
without markup give their collapsed text as one block; repeated rows give
repeated results; a document of any length is read whole, in time proportional to
its length, however deep its elements are nested; of containers with equal scores
the one with more text is chosen, then the first; a column with the name of the
output is replaced, other columns pass through.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_TAG = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</([a-zA-Z][^\s>/]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s>/]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<([a-zA-Z][^\s>/]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title noscript xmp iframe noembed noframes template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead tr ul caption".split()
)
#: A start tag of the key closes an open element of the value, up to a scope.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Elements and roles that hold no article text.
CUT_TAGS = frozenset(
    "head script style noscript template svg canvas iframe object embed audio video map nav aside footer button select "
    "textarea input datalist dialog menu search title xmp noembed noframes".split()
)
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form status tooltip".split())
#: Words of class names and ids that mark page furniture.
CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsors sponsored promo promos promotion banner "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs sidebar sidebars aside rail masthead topbar toolbar header footer foot "
    "colophon copyright cookie cookies consent gdpr notice notices notification notifications alert alerts popup popups modal overlay lightbox "
    "newsletter subscribe subscription signup signin login register paywall share sharing sharebar social socials related recommended recommendation recommendations "
    "trending widget widgets pagination pager paging comment comments commentlist commenters disqus respond replies reply discussion feedback "
    "form forms search searchbox skip skiplink hidden disclaimer tags tagcloud".split()
)
#: A class name that begins so describes the layout of what it stands on.
LAYOUT_PREFIX = ("has-", "with-", "no-", "is-", "js-", "without-")
KEPT_TAGS = frozenset("html body main article".split())
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Words of class names and ids that speak for or against a container.
FOR = frozenset("article body content entry main page post text blog story hentry".split())
AGAINST = frozenset("meta outbrain shoutbox tool byline contact media scroll".split())
NAME_WEIGHT = 25.0
PARAGRAPH_FULL = 25
KEEP_SIBLING = 0.2
CLIMB = 0.75
#: How much more an article or main element counts than another container of the same points.
SEMANTIC = 1.5
LINK_LIST = 0.5


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "score", "text_len", "link_len", "order", "holds", "anchors")

    def __init__(self, tag: str, attrs: str, parent: Node | None, order: int):
        self.tag, self.attrs, self.parent, self.children, self.order = tag, attrs, parent, [], order
        self.score = 0.0
        self.text_len = self.link_len = self.anchors = 0
        self.holds = 0  # bits of what stands below: see HOLDS

    def up(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m[1].lower(), _html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def parse(page: str) -> Node:
    """A tree of elements and strings; never fails, whatever the markup."""
    root = node = Node("#root", "", None, 0)
    at = n = 0
    size = len(page)
    lowered = None
    opened: dict[str, int] = {}

    def closed(upto: Node) -> Node:
        """upto, after all elements below it are closed."""
        own = node
        while own is not upto:
            opened[own.tag] -= 1
            own = own.parent
        return upto

    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            node.children.append(page[at:])
            break
        if m.start() > at:
            node.children.append(page[at : m.start()])
        at = m.end()
        if m[1]:
            tag, up = m[1].lower(), node
            if tag == "br":
                node.children.append(Node("br", "", node, n))
                continue
            if not opened.get(tag):
                continue
            # The end of an inline element closes no block that is still open inside it.
            while up.tag != tag and (tag in BLOCK or up.tag not in BLOCK):
                up = up.parent
            if up.tag == tag:
                node = closed(up.parent)
            continue
        tag = m[2] or m[4]
        if not tag:
            if m[0].startswith("<![CDATA["):
                node.children.append(_html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag, raw = tag.lower(), m[3] if m[2] else m[5]
        if tag in BLOCK and opened.get("p"):
            up = node
            while up.parent is not None and up.tag not in ("p", "td", "th", "div", "li", "article", "section", "button"):
                if up.tag in BLOCK and up.tag not in HEADINGS:
                    break
                up = up.parent
            if up.tag == "p":
                node = closed(up.parent)
        if tag in IMPLIED_END and any(map(opened.get, IMPLIED_END[tag][0])):
            ends, scope = IMPLIED_END[tag]
            up, last = node, None
            while up.parent is not None and up.tag not in scope:
                if up.tag in ends:
                    last = up
                up = up.parent
            if last is not None:
                node = closed(last.parent)
        n += 1
        new = Node(tag, raw, node, n)
        node.children.append(new)
        if tag in RAW_TEXT:
            if lowered is None:
                lowered = page.lower() if len(page.lower()) == size else page
            end = lowered.find(f"</{tag}", at)
            at = size if end < 0 else end
            if end >= 0:
                close = page.find(">", end)
                at = size if close < 0 else close + 1
        elif tag not in VOID and not raw.rstrip().endswith("/") or tag in BLOCK - {"hr"}:
            node = new
            opened[tag] = opened.get(tag, 0) + 1
    return root


_ARTICLE = frozenset(("article", "main"))
#: Bits of Node.holds: an article or main, a first heading, an article with text stands below.
HOLDS_ARTICLE, HOLDS_TITLE, HOLDS_TEXT = 1, 2, 4


def _note(root: Node) -> None:
    """Set the bits of what stands below each element before anything is cut."""
    for node in reversed(_descendants(root)):
        own = HOLDS_ARTICLE if node.tag in _ARTICLE else HOLDS_TITLE if node.tag == "h1" else 0
        node.parent.holds |= node.holds | own


def furniture(node: Node) -> bool:
    """Whether the element is page furniture and goes with all it holds."""
    if node.tag in CUT_TAGS:
        return not (node.tag in ("aside", "footer") and node.holds & HOLDS_ARTICLE)
    if node.tag == "form":
        return not node.holds & (HOLDS_ARTICLE | HOLDS_TITLE)
    if not node.attrs:
        return False
    attrs = attributes(node.attrs)
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or _HIDDEN_STYLE.search(attrs.get("style", "")):
        return node.tag not in ("html", "body")
    if node.tag in ("html", "body", "main"):
        return False
    if attrs.get("role", "").lower() in CUT_ROLES:
        return not node.holds & HOLDS_ARTICLE
    for name in (attrs.get("class", "") + " " + attrs.get("id", "")).split():
        if name.lower().startswith(LAYOUT_PREFIX):
            continue
        words = set(_WORDS.findall(_CAMEL.sub(r"\1 \2", name).lower()))
        if words & CUT_WORDS and not (node.tag == "article" and words & FOR) and not node.holds & HOLDS_ARTICLE:
            return True
    return False


def cut(root: Node) -> None:
    """Remove page furniture from the tree; of an article's own header only headings stay."""
    _note(root)
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag in _ARTICLE
        kept = []
        for c in node.children:
            if isinstance(c, Node):
                if c.tag == "header":
                    if not inside:
                        if not c.holds & HOLDS_ARTICLE:
                            continue
                    else:
                        c.children = [h for h in _descendants(c) if h.tag in HEADINGS]
                        for h in c.children:
                            h.parent = c
                elif furniture(c):
                    continue
                stack.append((c, inside))
            kept.append(c)
        node.children = kept


def _descendants(node: Node) -> list[Node]:
    out, stack = [], [c for c in reversed(node.children) if isinstance(c, Node)]
    while stack:
        c = stack.pop()
        out.append(c)
        stack.extend(x for x in reversed(c.children) if isinstance(x, Node))
    return out


def _clean(raw: str) -> str:
    return _html.unescape(raw) if "&" in raw else raw


def measure(root: Node) -> list[Node]:
    """Fill text_len, link_len, anchors, holds and score of every element; returns the containers with points."""
    order = [root, *_descendants(root)]
    paragraphs: dict[int, list] = {}
    around: dict[int, tuple[Node, bool]] = {}
    for node in order:
        block, linked = around[id(node.parent)] if node.parent is not None else (node, False)
        if node.tag in BLOCK or node.tag in ("td", "th"):
            block = node
        linked = linked or node.tag == "a"
        around[id(node)] = block, linked
        for c in node.children:
            if isinstance(c, str) and (text := " ".join(_clean(c).split())):
                n = len(text)
                held = paragraphs.setdefault(id(block), [block, 0, 0, 0])
                held[1] += n
                held[2] += text.count(",") + text.count("，") + text.count("、")
                held[3] += n if linked else 0
    for block, n, _, links in paragraphs.values():
        block.text_len, block.link_len = n, links
    for node in reversed(order):
        node.holds &= ~HOLDS_TEXT
    for node in reversed(order[1:]):
        up = node.parent
        up.text_len += node.text_len
        up.link_len += node.link_len
        up.anchors += node.anchors + (node.tag == "a")
        if node.holds & HOLDS_TEXT or node.tag == "article" and node.text_len:
            up.holds |= HOLDS_TEXT
    scored: dict[int, Node] = {}
    for block, n, commas, _ in paragraphs.values():
        if block.tag in HEADINGS:
            continue
        points = min(1.0, n / PARAGRAPH_FULL) + commas + min(n / 100, 3.0)
        own = block.tag not in ("p", "pre", "td", "th", "li", "dd", "blockquote", "tr", "figcaption")
        for level, x in enumerate(chain((block,), block.up()) if own else block.up()):
            if level > 5 or x.tag == "#root":
                break
            if id(x) not in scored:
                scored[id(x)] = x
                x.score = 0.0
                names = set(_WORDS.findall(x.attrs.lower())) if x.attrs else set()
                x.score += NAME_WEIGHT * (bool(names & FOR) - bool(names & AGAINST)) if points > 1 else 0.0
            x.score += points / (1, 2, 6, 9, 12, 15)[level]
    for x in scored.values():
        x.score *= 1 - density(x)
    return list(scored.values())


def density(node: Node) -> float:
    return node.link_len / node.text_len if node.text_len else 0.0


def _is_main(node: Node) -> bool:
    return node.tag == "main" or bool(node.attrs) and "main" in attributes(node.attrs).get("role", "").lower().split()


def _body_of(best: Node) -> Node:
    """The outermost article around the best container, else the innermost main element that holds no article, else the container itself."""
    around = [best, *best.up()]
    articles = [x for x in around if x.tag == "article"]
    if articles:
        return articles[-1]
    return next((x for x in around if _is_main(x) and not x.holds & HOLDS_TEXT), best)


def chosen(root: Node) -> list[Node]:
    """The best container by score and the siblings that belong to it, in page order; article and main only add weight."""
    scored = measure(root)
    if not scored:
        return [x for x in (root,) if x.text_len]
    best = max(scored, key=lambda x: (x.score * (SEMANTIC if x.tag == "article" or _is_main(x) else 1), x.text_len, -x.order))
    for up in best.up():
        if up.tag in ("body", "html", "#root") and up.score < best.score or up.score < CLIMB * best.score:
            break
        best = up
    peak = best.score
    best = _body_of(best)
    peak = max(peak, best.score)
    while best.parent is not None and best.parent.tag not in ("body", "html", "#root") and best.parent.text_len == best.text_len:
        best = best.parent  # a wrapper that holds nothing else: what belongs to it stands beside the wrapper
    if best.parent is None:
        return [best]
    kept = []
    for x in best.parent.children:
        if x is best:
            kept.append(x)
        elif isinstance(x, Node) and x.text_len:
            if x.tag in HEADINGS:
                ok = density(x) < LINK_LIST and x.order < best.order
            elif x.tag == "p":
                ok = density(x) < 0.25
            else:
                ok = x.score >= max(1.0, KEEP_SIBLING * peak) and density(x) < LINK_LIST
            if ok:
                kept.append(x)
        elif isinstance(x, str) and x.strip():
            kept.append(x)
    return kept


def _link_list(node: Node) -> bool:
    """A menu inside the article: a list of mostly links."""
    return node.tag in ("ul", "ol", "dl", "dir") and node.text_len > 0 and density(node) > LINK_LIST and node.anchors > 2


def blocks(nodes: list) -> list[str]:
    """The texts of the blocks in page order, white space collapsed."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        if run and (text := " ".join("".join(run).split())):
            out.append(text)
        run.clear()

    for top in nodes:
        end()
        stack: list = [(top, False)]
        while stack:
            x, done = stack.pop()
            if isinstance(x, str):
                run.append(_clean(x))
                continue
            breaks = x.tag in BLOCK
            if breaks:
                end()
            elif x.tag in ("br", "td", "th", "img"):
                run.append(" ")
            if done or _link_list(x):
                continue
            if breaks or x.tag in ("td", "th"):
                stack.append((x, True))
            stack.extend((c, False) for c in reversed(x.children))
    end()
    return out


def extract_main_text(page: str | None) -> str:
    """The article of one page: its blocks joined by two line feeds."""
    if not page:
        return ""
    root = parse(page)
    cut(root)
    return "\n\n".join(blocks(chosen(root)))


def _main_text(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in pages:
        yield pa.array([extract_main_text(page) for page in batch.to_pylist()], pa.string())


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """Add column ``out`` with the main text of ``html_col`` and drop the html; a map, without any shuffle.

    Arrow batches are bounded in bytes by the session, so long pages don't add up.
    """
    rest = [c for c in pages.columns if c not in (html_col, out)]
    return pages.select(*rest, F.arrow_udf(_main_text, StringType())(F.coalesce(F.col(html_col), F.lit(""))).alias(out))


def op1_html_extract(spark, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``."""
    from landgrid.llm.common import table

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
