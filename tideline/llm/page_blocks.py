"""The text blocks of an HTML page, in order, each with its place among the page's elements."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

# Elements by what they do to text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
UNSEEN = set("audio button canvas datalist map math noscript object option optgroup select svg template video".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Starting one of these ends an open paragraph.
SECTIONS = HEADINGS | set(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form header "
    "hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
BLOCKS = SECTIONS | set("body caption html legend tbody td tfoot th thead tr".split())
#: Starting the first ends an open one of the second, unless one of the third is open inside that.
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
}
#: An end tag reaches no further out than the nearest of these.
WALLS = {"table", "td", "th", "caption", "object", "template", "button"}

# Elements, roles and words of class and id that tell the main text from the rest.
MAIN_ELEMENTS = {"article", "main"}
MAIN_ROLES = {"main", "article"}
MAIN_WORDS = set("article articlebody body content entry main maincontent post postbody story storybody text".split())
OTHER_ELEMENTS = set("nav footer aside form dialog menu search fieldset".split())
OTHER_ROLES = set(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
OTHER_WORDS = set(
    "ad ads adsense advert advertisement advertising adverts aside banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disclaimer disqus feedback footer form gdpr hidden legal login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion recommended "
    "related replies reply respond search share sharing sidebar signup skip skiplink social sponsor sponsored subscribe "
    "subscription teaser toolbar topbar widget widgets".split()
)
HEADER = "header"

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    # A quote that never ends, or a tag that does not.
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|<(?:[!?]|/[^a-zA-Z])[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"']+))?")
_MARKING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


@dataclass
class Node:
    """An element that holds blocks. ``mark`` is 1 in the main text, -1 outside it, 0 if nothing tells."""

    tag: str
    parent: int
    depth: int
    mark: int = 0
    unseen: bool = False
    #: Whether the element itself said so that nothing inside can overrule it.
    firm: bool = False


@dataclass
class Block:
    text: str
    node: int
    linked: int


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=lambda: [Node("", -1, 0)])
    blocks: list[Block] = field(default_factory=list)


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        value = m.group(2) or ""
        found.setdefault(m.group(1).lower(), unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    return found


def _says(tag: str, rest: str, inside_main: bool) -> tuple[int, bool, bool]:
    """What an element says about its text: its mark, whether it is unseen, whether its mark is firm."""
    mark, firm = (1, False) if tag in MAIN_ELEMENTS else (-1, tag != "form") if tag in OTHER_ELEMENTS else (0, False)
    if tag == HEADER and not inside_main:
        mark, firm = -1, True
    if tag in ("body", "html") or not rest or not _MARKING.search(rest):
        return mark, False, firm
    attributes = _attributes(rest)
    style = attributes.get("style", "").replace(" ", "").lower()
    unseen = "hidden" in attributes or "display:none" in style or "visibility:hidden" in style
    roles = set(attributes.get("role", "").lower().split())
    words = {w.lower() for name in ("class", "id") for w in _WORDS.findall(attributes.get(name, ""))}
    if roles & OTHER_ROLES or words & OTHER_WORDS or (HEADER in words and not inside_main and not words & MAIN_WORDS):
        return -1, unseen, True
    if not mark and (roles & MAIN_ROLES or words & MAIN_WORDS or attributes.get("itemprop") == "articleBody"):
        mark = 1
    return mark, unseen, firm


def parse(html: str) -> Page:
    """The blocks of a page, as far as its markup can be followed.

    A block is the text between two places where an element that stands on lines of its own
    starts or ends. White space inside a block, also that of line breaks, is one space;
    character references are decoded; empty blocks are left out. Scripts, styles, comments,
    buttons, lists to choose from and elements that are not shown have no blocks. Elements left open
    end where HTML ends them; an end tag without a start ends the block only.
    """
    page = Page()
    nodes, blocks = page.nodes, page.blocks
    stack = [0]
    counts: Counter[str] = Counter()  # open elements by name
    pieces: list[str] = []
    linked = 0
    link = -1  # the depth of the stack at which a link was opened

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                blocks.append(Block(text, stack[-1], linked))
        linked = 0

    def leave(depth: int) -> None:
        nonlocal link
        counts.subtract(nodes[k].tag for k in stack[depth:])
        del stack[depth:]
        if link > len(stack):
            link = -1

    def close(names: set[str], walls: set[str]) -> None:
        """End the nearest open element of ``names``, and all inside it, unless a wall stands between."""
        if not any(counts[name] for name in names):
            return
        for at in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[at]].tag
            if tag in names:
                return leave(at)
            if tag in walls:
                return

    at, size = 0, len(html)
    while at < size:
        found = _TOKEN.search(html, at)
        start = found.start() if found else size
        if start > at and not nodes[stack[-1]].unseen:
            piece = html[at:start]
            piece = unescape(piece) if "&" in piece else piece
            pieces.append(piece)
            if link >= 0:
                linked += len(piece.strip())
        if not found:
            break
        at = found.end()
        name = found["name"] or found["name2"]
        if not name:
            continue
        tag = name.lower()
        if found["end"] or found["end2"]:
            if tag == "a":
                link = -1
            elif tag in BLOCKS:
                flush()
                if tag not in ("body", "html"):
                    close({tag}, WALLS - {tag} | (ENDED_BY["li"][1] if tag == "li" else set()))
            elif tag in UNSEEN:
                close({tag}, set())
            continue
        rest = found["rest"] or found["rest2"] or ""
        if tag == "br":
            pieces.append(" ")
        elif tag == "a":
            link = len(stack)
        elif tag in RAW:
            ended = _RAW_ENDS[tag].search(html, at)
            at = ended.start() if ended else size
        elif tag in BLOCKS or (tag in UNSEEN and not rest.endswith("/")):
            if tag in BLOCKS:
                flush()
                if tag in SECTIONS:
                    close({"p"}, WALLS)
                if tag in ENDED_BY:
                    close(*ENDED_BY[tag])
                if tag in HEADINGS and nodes[stack[-1]].tag in HEADINGS:
                    leave(len(stack) - 1)
            if tag in VOID:
                continue
            outer = nodes[stack[-1]]
            mark, unseen, firm = _says(tag, rest, outer.mark > 0)
            # The outer element's word stands, but for what stands apart inside the main text, and a main part inside a form.
            if outer.mark < 0 and (outer.firm or mark <= 0):
                mark, firm = -1, outer.firm
            elif outer.mark > 0 and mark == 0:
                mark = 1
            stack.append(len(nodes))
            counts[tag] += 1
            nodes.append(Node(tag, stack[-2], outer.depth + 1, mark, outer.unseen or unseen or tag in UNSEEN, firm))
    flush()
    return page
