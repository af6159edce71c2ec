"""One web page as blocks of text with their place in the page's element tree.

A helper of ``page_text``: reads one page's HTML in one pass with a stack of
open elements, as browsers nest them (void elements, implied end tags, end tags
without a start, raw text of scripts), and gives the text blocks in page order.

A block is the text between two boundaries of block-level elements. Character
references are decoded, any white space becomes one space, ends are trimmed,
and inline elements break nothing (``<br>`` counts as white space).
"""

from __future__ import annotations

import html
import re
from hashlib import blake2b
from typing import NamedTuple

# Names of HTML elements by their part in the standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template svg".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset(
    "p ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption hr address summary legend".split())
BLOCK = PROSE | frozenset(
    "html body head article aside center details dialog dir div fieldset footer form header hgroup main menu nav search section "
    "optgroup option select button object".split())
CLOSES_P = HEADINGS | frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form header hgroup hr main "
    "menu nav ol p pre search section table ul".split())
SCOPE = frozenset("html table td th caption object template".split())
#: What a start tag closes, and where looking for it ends.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"]) | SCOPE), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"]) | SCOPE),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"]) | SCOPE), "option": (frozenset(["option"]), frozenset(["select", "optgroup"]) | SCOPE),
    "tr": (frozenset(["tr", "caption"]), frozenset(["table", "html"])), "td": (frozenset(["td", "th"]), frozenset(["tr", "table", "html"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table", "html"])),
    **{t: (frozenset(["thead", "tbody", "tfoot", "tr", "caption"]), frozenset(["table", "html"])) for t in ("thead", "tbody", "tfoot")},
}

# Elements, ARIA roles and words of class and id names that mark what is not the article.
#: Never holds the article, whatever it stands in or contains.
ASIDE_TAGS = frozenset("aside footer button select object dialog menu head search".split())
#: Holds the article only where that is marked inside it (an unclosed menu, a form around the whole page).
AROUND_TAGS = frozenset("nav form header".split())
ASIDE_ROLES = frozenset("complementary contentinfo dialog alertdialog search".split())
AROUND_ROLES = frozenset("navigation banner alert menu menubar toolbar form".split())
ASIDE_WORDS = frozenset("comment comments commentlist disqus respond replies sidebar aside rail related recommended footer".split())
AROUND_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead ad ads advert adverts advertisement advertising adsense banner sponsor "
    "sponsored promo alert cookie cookies consent disclaimer gdpr notice notices notification notifications popup modal overlay newsletter "
    "subscribe subscription signup login search social share sharing pagination pager toolbar skip widget widgets".split())
#: The same words run together with others: what such a word begins or ends with.
AROUND_STARTS = ("advert", "adbanner", "adblock", "adbox", "adslot", "adspace", "adunit", "breadcrumb", "cookie", "newsletter", "popup", "promo", "sponsor")
AROUND_ENDS = ("nav", "navbar", "navigation", "menu", "notice", "adverts")
ASIDE_STARTS, ASIDE_ENDS = ("sidebar", "footer"), ("sidebar", "footer", "comments")
#: "header" is a word of the article's own parts beside one of these.
ARTICLE_WORDS = frozenset("article content entry post story text".split())
#: A class name with one of these says what else the page has or lacks.
WRAPPER_WORDS = frozenset("has no with without".split())

_TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)?", re.S)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")

#: Marks of a place: not the article for certain; by a soft mark; inside main; inside an article; inside a link; a heading of rank 1.
GONE, AROUND, MAIN, ARTICLE, LINK, TITLE = 1, 2, 4, 8, 16, 32


class Place(NamedTuple):
    """An open element: its path and box as 64-bit names, the boxes it stands in, its marks."""

    name: str
    path: int
    box: int
    boxes: tuple[int, ...]
    marks: int


class Block(NamedTuple):
    text: str
    path: int
    #: Path and text in one 64-bit name.
    token: int
    box: int
    boxes: tuple[int, ...]
    marks: int
    #: Characters that stand in links.
    linked: int


ROOT = Place("#", 0, 0, (0,), 0)
#: Elements seen before by (parent, name, names in attributes); a worker's memory, emptied when full.
_known: dict[tuple, Place] = {}
KNOWN = 50_000
#: Open elements, as in browsers; those nested deeper count as their parent.
DEPTH = 512


def name64(*parts: object) -> int:
    return int.from_bytes(blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _words(value: str) -> frozenset[str]:
    found = {w.lower() for w in _CAMEL.split(value) if w}
    # A word that begins or ends with a telling one says the same.
    for w in tuple(found):
        if w.startswith(ASIDE_STARTS) or w.endswith(ASIDE_ENDS):
            found.add("sidebar")
        elif w.startswith(AROUND_STARTS) or w.endswith(AROUND_ENDS):
            found.add("menu")
        elif w.endswith("header"):
            found.add("header")
    return frozenset(found)


def _place(parent: Place, name: str, named: list[tuple[str, str, str, str]]) -> Place:
    key = (parent, name, tuple(named))
    found = _known.get(key)
    if found is None:
        if len(_known) >= KNOWN:
            _known.clear()
        found = _known[key] = _new_place(parent, name, named)
    return found


def _new_place(parent: Place, name: str, named: list[tuple[str, str, str, str]]) -> Place:
    values = {k.lower(): html.unescape(a or b or c) for k, a, b, c in named}
    role = values.get("role", "").strip().lower()
    marks = parent.marks & ~TITLE
    groups = [_words(v) for c in ("class", "id") for v in values.get(c, "").split()]
    groups = [g for g in groups if not g & WRAPPER_WORDS and not ("content" in g and g & {"wrap", "wrapper"})]
    said = frozenset().union(*groups)
    is_comment = bool(said & {"comment", "comments", "commentlist", "disqus", "respond", "replies"})
    if name in ("main", "article") or role in ("main", "article") or values.get("itemprop", "").strip() == "articleBody":
        if name == "main" or role == "main":
            marks = marks & ~(GONE | AROUND) | MAIN
        elif is_comment:
            marks |= GONE
        else:
            marks = marks & ~AROUND | ARTICLE
    elif name not in ("html", "body"):
        inside = marks & (MAIN | ARTICLE)
        if name in ASIDE_TAGS or role in ASIDE_ROLES or said & ASIDE_WORDS:
            marks |= GONE
        elif (name in AROUND_TAGS and not (name == "header" and inside)) or role in AROUND_ROLES or said & AROUND_WORDS:
            marks |= AROUND
        elif "header" in said and not inside and not said & ARTICLE_WORDS:
            marks |= AROUND
    if name == "a":
        marks |= LINK
    if name == "h1":
        marks |= TITLE
    if name not in BLOCK:
        if marks & AROUND and not parent.marks & AROUND:
            # A part of a line, within a block that stays.
            marks |= GONE
        return Place(name, parent.path, parent.box, parent.boxes, marks)
    # Digits in class and id names number single pages: they are no part of a path.
    signs = [re.sub(r"\d+", "#", values.get(c, "").strip()) for c in ("class", "id")]
    path = name64(parent.path, name, *signs)
    if name in PROSE:
        return Place(name, path, parent.box, parent.boxes, marks)
    return Place(name, path, path, (*parent.boxes, path), marks)


def _close(stack: list[Place], name: str) -> None:
    """An end tag."""
    if name in BLOCK:
        limit = SCOPE if name not in ("table", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body") else frozenset(["html"])
        if name == "li":
            limit = limit | {"ul", "ol"}
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name == name:
                del stack[k:]
                return
            if stack[k].name in limit:
                return
    else:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name == name:
                del stack[k]
                return
            if stack[k].name in SCOPE:
                return


def _imply(stack: list[Place], name: str) -> None:
    """End tags that a start tag implies."""
    if name in CLOSES_P:
        for k in range(len(stack) - 1, 0, -1):
            at = stack[k].name
            if at == "p":
                del stack[k:]
                break
            if at in SCOPE or at == "button":
                break
        if name in HEADINGS and stack[-1].name in HEADINGS:
            stack.pop()
    if name in IMPLIED:
        closes, ends = IMPLIED[name]
        for k in range(len(stack) - 1, 0, -1):
            at = stack[k].name
            if at in closes:
                del stack[k:]
                if name not in ("thead", "tbody", "tfoot"):
                    return
                return _imply(stack, name)
            if at in ends:
                return


def blocks(page: str) -> list[Block]:
    """All blocks of a page but those that certainly are not the article, in page order."""
    out: list[Block] = []
    stack = [ROOT]
    pieces: list[str] = []
    linked = 0
    first = ROOT
    at, size = 0, len(page)
    find = _TOKEN.search

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = "".join(pieces)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                out.append(Block(text, first.path, name64(first.path, text), first.box, first.boxes, first.marks, min(linked, len(text))))
            pieces.clear()
        linked = 0

    while at < size:
        m = find(page, at)
        end = m.start() if m else size
        if end > at:
            top = stack[-1]
            if not top.marks & GONE:
                piece = page[at:end]
                if pieces:
                    pieces.append(piece)
                elif not piece.isspace():
                    pieces.append(piece)
                    # The innermost block element: inline ones have its path.
                    first = top
                if top.marks & LINK and pieces:
                    linked += len(piece)
        if m is None:
            break
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if m.group(1):
            if name in BLOCK:
                flush()
            _close(stack, name)
            continue
        if name in RAW:
            close = _RAW_END[name].search(page, at)
            if close:
                stop = page.find(">", close.start())
                at = stop + 1 if stop >= 0 else size
            elif name in ("script", "style"):
                at = size
            continue
        if name == "br":
            if pieces:
                pieces.append(" ")
            continue
        if name in BLOCK:
            flush()
            if name == "body" or name == "html":
                # A second one adds nothing; the body ends the head.
                stack = [p for p in stack if p.name != "head"]
                if any(p.name == name for p in stack):
                    continue
            _imply(stack, name)
        if name in VOID:
            continue
        attributes = m.group(3)
        named = _NAMED.findall(attributes) if "=" in attributes else []
        if name == "a":
            _close(stack, "a")
        if len(stack) < DEPTH:
            stack.append(_place(stack[-1], name, named))
    flush()
    return out
