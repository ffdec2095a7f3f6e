"""A page's element tree, as tolerant as browsers are, and what its markup alone says about its parts."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import xxhash

# Comments, declarations, tags (a quote opens only after an equals sign) and a tag cut off by the page's end.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>|<(?=/?[a-zA-Z])[^>]*\Z",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# HTML's void elements, those whose content is no markup, and those that run on within a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var img wbr label".split()
)
# Start tags that end an open element of the same sort, and the elements they do not look beyond.
_ENDS = {
    **dict.fromkeys(("li",), (frozenset(("li",)), frozenset(("ul", "ol", "menu")))),
    **dict.fromkeys(("dt", "dd"), (frozenset(("dt", "dd")), frozenset(("dl",)))),
    **dict.fromkeys(("td", "th"), (frozenset(("td", "th")), frozenset(("tr", "table")))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (frozenset(("thead", "tbody", "tfoot")), frozenset(("table",)))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
}
_PROSE_SCOPE = frozenset("td th table button caption object article section div main body ul ol dl blockquote form".split())
# Elements that are never part of an article.
NEVER = frozenset(
    "script style noscript template iframe object embed svg math canvas head title nav footer aside form fieldset "
    "button select textarea input dialog menu audio video map applet frameset noframes".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
# Words in class and id that name a part of a page other than its article.
_NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices newsletter subscribe subscription signup popup modal overlay sidebar sidebars widget "
    "widgets related recommended recommendations share sharing social comment comments disqus respond replies "
    "breadcrumb breadcrumbs menu nav navbar navigation footer masthead toolbar pagination pager login search "
    "copyright disclaimer alert alerts announcement".split()
)
_HEADING_NOISE = frozenset("header topbar".split())
_NEGATED = frozenset("with has no without hide".split())
_ARTICLE_NOISE = frozenset("ad ads comment comments sponsored promo related teaser".split())
# Blocks of running text; in an article they are its own words unless most of a site's pages have them.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption address hr".split())
# Parts of lists and tables, which stand or fall with the whole.
PARTS = frozenset("li dt dd td th tr thead tbody tfoot caption option optgroup".split())
LINKS_ONLY = 0.6


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    names: str = ""
    role: str = ""
    # Texts and indexes of child elements, in order.
    parts: list = field(default_factory=list)
    in_article: bool = False
    dropped: bool = False
    chars: int = 0
    linked: int = 0
    hash: int = 0
    has_block: bool = False
    has_article: bool = False
    has_heading: bool = False


def parse(html: str) -> list[Node]:
    """Elements in page order, the root first; open ends are closed as browsers close them."""
    nodes = [Node("#root", -1)]
    stack = [0]
    at = 0

    def text(raw: str) -> None:
        if raw:
            nodes[stack[-1]].parts.append(unescape(raw) if "&" in raw else raw)

    match = _TOKEN.search(html)
    while match:
        text(html[at : match.start()])
        at = match.end()
        if tag := match[2]:
            tag = tag.lower()
            if match[1]:
                _close(nodes, stack, tag)
            else:
                _close_before(nodes, stack, tag)
                node = Node(tag, stack[-1])
                if "=" in match[3]:
                    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(match[3])}
                    node.names, node.role = f"{values.get('class', '')} {values.get('id', '')}".strip(), values.get("role", "").lower()
                nodes[stack[-1]].parts.append(len(nodes))
                nodes.append(node)
                if tag in RAW:
                    end = re.compile(rf"</{re.escape(tag)}(?![^\s/>])[^>]*>?", re.I).search(html, at)
                    at = end.end() if end else len(html)
                elif tag not in VOID and not match[3].endswith("/") or tag in ("p", "div", "a", "span", "li"):
                    if tag not in VOID:
                        stack.append(len(nodes) - 1)
        match = _TOKEN.search(html, at)
    text(html[at:])
    _measure(nodes)
    return nodes


def _close(nodes: list[Node], stack: list[int], tag: str) -> None:
    """An end tag closes its element and all in it; one that was never opened is ignored."""
    for depth in range(len(stack) - 1, 0, -1):
        open_ = nodes[stack[depth]].tag
        if open_ == tag:
            del stack[depth:]
            return
        if tag in INLINE and open_ not in INLINE:
            return


def _close_before(nodes: list[Node], stack: list[int], tag: str) -> None:
    """What a start tag closes: an open paragraph if it starts a block, an item of its own sort."""
    if tag in INLINE or tag in VOID and tag != "hr":
        return
    for depth in range(len(stack) - 1, 0, -1):
        open_ = nodes[stack[depth]].tag
        if open_ == "p":
            del stack[depth:]
            break
        if open_ in _PROSE_SCOPE:
            break
    if tag in _ENDS:
        ended, scope = _ENDS[tag]
        for depth in range(len(stack) - 1, 0, -1):
            open_ = nodes[stack[depth]].tag
            if open_ in scope:
                return
            if open_ in ended:
                del stack[depth:]
                return


def _name_parts(names: str) -> list[str]:
    return [part.lower() for part in _NAME_PART.findall(names)]


def _named(parts: list[str], noise: frozenset[str]) -> bool:
    return any(p in noise and (k == 0 or parts[k - 1] not in _NEGATED) for k, p in enumerate(parts))


def _measure(nodes: list[Node]) -> None:
    """Sizes, hashes and what each element holds, from the leaves up; then what the markup rules out, from the root down."""
    for k in range(len(nodes) - 1, -1, -1):
        node = nodes[k]
        digest = [node.tag]
        for part in node.parts:
            if isinstance(part, str):
                words = " ".join(part.split())
                node.chars += len(words)
                digest.append(words)
                continue
            child = nodes[part]
            if child.tag in RAW:
                continue
            node.chars += child.chars
            node.linked += child.chars if child.tag == "a" else child.linked
            if child.chars:
                node.has_block |= child.has_block or child.tag not in INLINE
                digest.append(f"{child.hash:x}")
            noisy = bool(child.names) and child.tag == "article" and _named(_name_parts(child.names), _ARTICLE_NOISE)
            node.has_article |= child.has_article or child.tag == "main" or child.tag == "article" and not noisy
            node.has_heading |= child.has_heading or child.tag == "h1"
        node.hash = xxhash.xxh64_intdigest("\0".join(digest).encode("utf-8", "surrogatepass"))
    for node in nodes[1:]:
        parent = nodes[node.parent]
        node.in_article = parent.in_article or parent.tag in ("article", "main")
        node.dropped = parent.dropped or _ruled_out(node)


def _ruled_out(node: Node) -> bool:
    """Whether tag, role, class or id say that an element is no part of an article."""
    if node.tag in NEVER:
        return not (node.tag in ("form", "fieldset") and (node.has_article or node.has_heading))
    if node.tag == "header" and not node.in_article or node.role in _ROLES:
        return not node.has_article
    if not node.names or node.tag in ("html", "body", "main"):
        return False
    parts = _name_parts(node.names)
    if node.tag == "article":
        return _named(parts, _ARTICLE_NOISE)
    if node.has_article or node.has_heading:
        return False
    return _named(parts, _NOISE) or not node.in_article and _named(parts, _HEADING_NOISE)


def roots_of_article(nodes: list[Node]) -> list[int]:
    """Where the article lies, in page order: article elements, else main, else the whole page without lists of links."""
    articles, mains = [], []
    inside = set()
    for k, node in enumerate(nodes):
        if node.dropped or not node.chars:
            continue
        if node.parent in inside:
            inside.add(k)
        elif node.tag == "article" or node.role == "article":
            articles.append(k)
            inside.add(k)
        elif node.tag == "main" or node.role == "main":
            mains.append(k)
    headed = [k for k in articles if nodes[k].has_heading]
    if len(headed) == 1:
        return headed
    if len(articles) > 1:
        articles = [k for k in articles if nodes[k].linked < LINKS_ONLY * nodes[k].chars] or articles
    if articles:
        if not headed:
            # The title may stand before the article.
            titles = [
                k for k in range(articles[0]) if nodes[k].tag == "h1" and not nodes[k].dropped and nodes[k].in_article
            ]
            return titles[-1:] + articles
        return articles
    if mains:
        return mains[:1]
    for node in nodes[1:]:
        listed = node.tag not in INLINE and node.tag not in PROSE and node.chars and node.linked > LINKS_ONLY * node.chars
        node.dropped |= nodes[node.parent].dropped or bool(listed)
    return [0]


def text_of(nodes: list[Node], roots: list[int]) -> str:
    """The words under the roots without dropped elements: one space between blocks and within them."""
    out = []
    for root in roots:
        stack = [(root, 0)]
        while stack:
            k, place = stack.pop()
            parts = nodes[k].parts
            while place < len(parts):
                part = parts[place]
                place += 1
                if isinstance(part, str):
                    out.append(part)
                elif not nodes[part].dropped:
                    tag = nodes[part].tag
                    if tag not in INLINE:
                        out.append(" ")
                    if nodes[part].parts:
                        stack += [(k, place), (part, 0)]
                        break
            else:
                if nodes[k].tag not in INLINE:
                    out.append(" ")
        out.append(" ")
    return " ".join("".join(out).split())
