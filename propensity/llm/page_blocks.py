"""A page as a tree of block elements and text runs; helper of ``site_style_tree``.

One pass of a token pattern over the markup. Inline elements (links, emphasis,
unknown tags) leave no node: their text joins the run around them, and a line
break is white space. A run ends where a block element starts or ends. Missing
end tags are supplied where HTML says so (paragraphs, list items, table cells),
end tags without a start are ignored, what is open at the end is closed. Raw
content (scripts, styles, titles, text areas), comments and declarations leave
nothing. A '<' that starts no tag is text.

An element is marked as furniture by its tag, ARIA role, class or id: menus,
headers and footers, sidebars, notices, adverts, forms, reader comments. The
header of an article is its own and stays. ``article`` elements (else ``main``)
mark a page's content; an article inside an article is a reader's comment, and
an element that holds marked content is not furniture whatever its class says.
"""

from __future__ import annotations

import hashlib
import html as markup
import re
from dataclasses import dataclass, field

# ---- fixed values: element names of HTML and names that sites give to their furniture

RAW = "script|style|title|textarea|noscript|iframe|xmp|noembed|noframes|template"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead tr ul").split())
FURNITURE_TAGS = frozenset((
    "nav footer aside form menu dialog search button select datalist fieldset svg math canvas audio video object applet head").split())
FURNITURE_ROLES = frozenset((
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog status tablist").split())
FURNITURE_NAMES = frozenset((
    "ad ads advert adverts advertisement advertising advertorial adsense sponsor sponsored sponsors promo promotion promotions "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager header masthead topbar footer "
    "sidebar sidebars aside rail widget widgets cookie cookies consent gdpr notice notices notification banner popup modal overlay "
    "form login signup subscribe subscription newsletter search share sharing social related recommended recirculation").split())
READER_NAMES = frozenset("comment comments respond replies discussion disqus".split())
#: A name with one of these beside a furniture name says that there is none, or only where it goes.
NEGATIONS = frozenset("no not non without has have with hide".split())
HEADING = re.compile(r"h[1-6]\Z")

# ----

_ATTRS = r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+"""
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*+(?:>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)|\Z)|<[!?][^>]*+(?:>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>{_ATTRS}|[^>]*+)>|</?[a-z][^>]*+\Z", re.S | re.I)
ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: element: (what it closes, what it does not look beyond)
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
          "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "option": ({"option"}, {"select", "optgroup"})}
LOOK_BACK = 64
TEXT = "#text"
#: Elements deeper than this share the tree's node of their ancestor there.
MAX_LEVELS = 12


@dataclass(slots=True)
class Element:
    tag: str
    label: str
    furniture: bool
    content: bool
    parent: "Element | None"
    inline: bool = False
    readers: bool = False                                   # what readers say, whatever its tags
    items: list = field(default_factory=list)               # Element, or list of pieces of a text run
    run: list | None = None


@dataclass(slots=True)
class Leaf:
    """A text run: its text, the tree nodes on its path are named in ``key``."""

    text: str
    key: bytes
    furniture: bool


def furniture_names(value: str, names: frozenset = FURNITURE_NAMES) -> bool:
    """Whether one of the class names or ids in ``value`` names a site's furniture."""
    for name in value.split():
        words = {w.lower() for w in WORD.findall(name)}
        if words & names and not words & NEGATIONS:
            return True
    return False


def marks(tag: str, attrs: str, inside: bool) -> tuple[str, bool, bool, bool]:
    """(label in the tree, furniture, content, readers) of a start tag; ``inside``: of an article or main, whose header stays."""
    got = {}
    if attrs and "=" in attrs:
        for name, a, b, c in ATTR.findall(attrs):
            got.setdefault(name.lower(), a or b or c)
    label = tag + "." + re.sub(r"\d+", "", " ".join(got["class"].split())) if got.get("class") else tag
    role = got.get("role", "").lower().split()
    content = tag == "article" or tag == "main" or "main" in role or got.get("itemprop") == "articleBody"
    named = got.get("class", "") + " " + got.get("id", "")
    if tag in ("body", "html"):
        return label, False, False, False
    readers = bool(got) and furniture_names(named, READER_NAMES)
    if content:
        unfit = readers or tag == "article" and furniture_names(named)
        return label, unfit, not unfit, readers
    furniture = (readers or tag in FURNITURE_TAGS or tag == "header" and not inside or any(r in FURNITURE_ROLES for r in role)
                 or bool(got) and furniture_names(named, FURNITURE_NAMES - {"header"} if inside else FURNITURE_NAMES))
    return label, furniture, False, readers


def parse(page: str) -> Element:
    """The body of a page."""
    root = Element("body", "body", False, False, None)
    stack = [root]
    open_tags: dict[str, int] = {}
    pos = inside = 0

    def text(piece: str) -> None:
        top = stack[-1]
        if top.run is None:
            top.run = []
            top.items.append(top.run)
        top.run.append(piece)

    def pop() -> None:
        nonlocal inside
        gone = stack.pop()
        inside -= gone.content
        open_tags[gone.tag] -= 1
        if not gone.inline:
            stack[-1].run = None

    def close(tags: set, until: set) -> None:
        for back in range(1, min(len(stack), LOOK_BACK)):
            tag = stack[-back].tag
            if tag in tags:
                for _ in range(back):
                    pop()
                return close(tags - {tag}, until) if len(tags) > 1 else None
            if tag in until:
                return

    for m in TOKEN.finditer(page):
        if m.start() > pos:
            text(page[pos:m.start()])
        pos = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        block = tag in BLOCK
        if m["end"]:
            if open_tags.get(tag) and tag not in ("html", "body"):
                while stack[-1].tag != tag:
                    pop()
                pop()
            elif block:
                stack[-1].run = None
            continue
        if tag in ("html", "body"):
            while open_tags.get("head"):
                pop()
            continue
        if tag in VOID:
            if tag == "br":
                text(" ")
            elif tag == "hr":
                if stack[-1].tag == "p":
                    pop()
                stack[-1].run = None
            continue
        label, furniture, content, readers = marks(tag, m["attrs"], inside > 0)
        if not block and not furniture and not content:
            continue
        if block or content:
            if open_tags.get("head") and tag != "head":
                while open_tags["head"]:
                    pop()
            while len(stack) > 1 and (stack[-1].tag == "p" or stack[-1].inline and open_tags.get("p")):
                pop()
            if tag in CLOSES:
                close(*CLOSES[tag])
        if content and tag == "article" and any(e.tag == "article" for e in stack):
            furniture, content = True, False
        if m["attrs"].endswith("/") and not block:
            continue
        child = Element(tag, label, furniture, content, stack[-1], inline=not block and not content,
                        readers=readers)
        stack[-1].items.append(child)
        if not child.inline:
            stack[-1].run = None
        stack.append(child)
        inside += content
        open_tags[tag] = open_tags.get(tag, 0) + 1
    if pos < len(page):
        text(page[pos:])
    return root


def clean(pieces: list) -> str:
    joined = "".join(pieces)
    if "&" in joined:
        joined = markup.unescape(joined)
    return " ".join(joined.split())


def digest(*parts: bytes) -> bytes:
    return hashlib.blake2b(b"\0".join(parts), digest_size=16).digest()


def _settle(root: Element) -> None:
    """Picks the page's content: articles before main, and before either in furniture; what holds the pick is no furniture."""
    todo, found = [(root, False)], []
    while todo:
        e, within = todo.pop()
        if e.content:
            found.append((e, within))
        if e.furniture and (e.readers or e.tag in FURNITURE_TAGS or e.tag == "article"):
            continue                                          # nothing in a menu or a comment is the page's content
        within = within or e.furniture
        todo += [(x, within) for x in e.items if isinstance(x, Element)]
    picks = [(within, e.tag != "article") for e, within in found]
    for e, within in found:
        e.content = (within, e.tag != "article") == min(picks)
        up = e.parent if e.content else None
        while up is not None:
            up.furniture = False
            up = up.parent


def tree(page: str | None, site: bytes):
    """(nodes, leaves) of a page.

    ``nodes`` are what the page adds to its site's style tree: (key, parent style
    key, depth, kind, item, style key), kind 0 the node itself, 1 one of its styles
    (the labels of its children), 2 one of its texts. ``leaves`` are its text runs
    in order. Repeated children of one label are one node.
    """
    root = parse(page or "")
    _settle(root)
    has_content = False
    nodes: dict[tuple, None] = {}
    found: list[tuple] = []
    top = digest(site, b"body")
    nodes[(top, b"", 0, 0, b"", b"")] = None
    todo = [(root, top, 0, False, False)]
    while todo:
        e, key, depth, furniture, inside = todo.pop()
        if not isinstance(e, Element):
            found.append((e, key, furniture, inside))
            continue
        furniture = furniture or e.furniture
        inside = inside or e.content and not furniture
        has_content = has_content or e.content and not furniture
        parts = [(x, x.label if isinstance(x, Element) else TEXT) for x in e.items]
        parts = [(x, label, clean(x) if label == TEXT else None) for x, label in parts]
        parts = [p for p in parts if p[2] != ""]
        style = "|".join(dict.fromkeys(label for _, label, _ in parts)).encode("utf-8", "surrogatepass")
        if depth < MAX_LEVELS and parts and not furniture:
            style_key = digest(key, style)
            nodes[(key, b"", depth, 1, style_key, style_key)] = None
        below = []
        for x, label, words in parts:
            if depth >= MAX_LEVELS or furniture:
                child, level = key, depth
            else:
                child, level = digest(style_key, label.encode("utf-8", "surrogatepass")), depth + 1
                nodes[(child, style_key, level, 0, b"", b"")] = None
            if words is None:
                below.append((x, child, level, furniture, inside))
            else:
                if not furniture:
                    nodes[(child, b"", level, 2, digest(words.encode("utf-8", "surrogatepass")), b"")] = None
                below.append((words, child, level, furniture, inside))
        todo += reversed(below)
    leaves = [Leaf(words, key, furniture or has_content and not inside) for words, key, furniture, inside in found]
    return nodes, leaves
