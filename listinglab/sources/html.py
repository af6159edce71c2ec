"""Saved HTML pages as tables (S7-S9), re-aimed from browser scraping.

A table of saved pages (id, html) is turned into rows by one pass over each
page with a stack of open elements (:class:`Page`; regular tags are cut out by
their brackets and read once by Python's own tokenizer, pages of the same tags
share one tree, a page with anything else goes through that tokenizer whole): attributes in any order, void and unclosed tags, nested elements of one tag,
all character references. Elements are then found by tag and class as a range
of the page, so a look-up reads no text twice. Pages are read in Arrow
batches within the scan's stage: no shuffle, no page leaves its task.

A missing element gives NULL (S7), '' (S8) or a default (S9), as in the source.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import ship_code

# Tags and classes that mark the parts of the source's pages, and the missing default.
REVIEW, SERVICES, SERVICE = ("div", "lwGaE A"), ("div", "JxiyB f"), ("div", "msVPq")
RATING, REVIEW_TITLE, REVIEW_TEXT = ("svg", "UctUV d H0"), ("div", "biGQs _P fiohW uuBRH"), ("span", "JguWG")
REVIEW_INFO, SERVICE_INFO = ("div", "biGQs _P pZUbB ncFvv osNWb"), ("div", "biGQs _P pZUbB osNWb")
INFO_TAGS = {"name": ("div", "jIkPg G u"), "phone": ("div", "bOZAZ VNlYD"), "address": ("div", "biGQs _P pZUbB W hmDzD"),
             "average_rating": ("span", "ammfn"), "total_review": ("span", "SSkub")}
WEBSITE, MENTIONS, MENTION = ("div", "jWfod u"), ("div", "TuqGj"), ("span", "_T")
ATTRIBUTE, ATTRIBUTE_NAME, ATTRIBUTE_RATE = ("div", "HWAlD TQNLQ"), ("span", "exvvN"), ("span", "RkhSR")
TOTAL, TOTAL_NAME, TOTAL_COUNT = ("div", "jxnKb"), ("div", "Ygqck o W q"), ("div", "biGQs _P fiohW biKBZ osNWb")
NOT_FOUND = "Not found"
# Elements without an end tag, and what a start tag ends when it is still open.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
        "tbody": {"td", "th", "tr", "thead", "tbody"}, "option": {"option"}}
STOPS = {"p": {"div", "td", "th", "li", "table"}, "li": {"ul", "ol"}, "option": {"select"}}

#: A tag, without its brackets, that every reading of HTML ends at the same place: no bracket inside, all quotes paired around values.
_REGULAR = re.compile(r"""[a-zA-Z][a-zA-Z0-9:_-]*(?:[ \t\n\r\f]+[a-zA-Z_:][a-zA-Z0-9:_.-]*"""
                      r"""(?:[ \t\n\r\f]*=[ \t\n\r\f]*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'=`<>]+))?)*[ \t\n\r\f]*/?"""
                      r"""|/[a-zA-Z][a-zA-Z0-9:_-]*[ \t\n\r\f]*|![dD][oO][cC][tT][yY][pP][eE] [a-zA-Z]+|!--(?:[^<>-]+-?)+--""")
#: Elements whose content Python's tokenizer reads in another way; which they are depends on its version.
_RAW = {*getattr(HTMLParser, "CDATA_CONTENT_ELEMENTS", ()), *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "plaintext"}
#: Tags that a worker keeps, and the longest that it keeps.
HELD_TAGS, HELD_LENGTH = 20_000, 300
#: By text between the brackets: (handler, tag, class, link), or None for a tag that is not regular.
_HELD: dict[str, tuple | None] = {}


class _OneTag(HTMLParser):
    """What Python's tokenizer makes of one tag."""

    def __init__(self, head: str):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple] = [("", "", "", None)]
        self.feed(f"<{head}>")
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.found.append(("start", tag, *_class_and_link(attrs)))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.found.append(("startend", tag, *_class_and_link(attrs)))

    def handle_endtag(self, tag: str) -> None:
        self.found.append(("end", tag, "", None))


def _class_and_link(attrs: list[tuple[str, str | None]]) -> tuple[str, str | None]:
    given = dict(attrs)
    return " ".join((given.get("class") or "").split()), given.get("href")


def _tag(head: str) -> tuple | None:
    """(handler, tag, class, link) of the text between a tag's brackets, read once for a worker; None: not regular."""
    found = None
    if _REGULAR.fullmatch(head):
        found = _OneTag(head).found[-1]
        found = None if found[1] in _RAW else found
    if len(head) <= HELD_LENGTH:
        if len(_HELD) >= HELD_TAGS:
            _HELD.clear()
        _HELD[head] = found
    return found


#: Text between brackets that holds no bracket itself.
_HEAD = re.compile("<([^<>]*)>")
#: Structures that a worker keeps, and the most tags of one that it keeps.
HELD_SHAPES, SHAPE_TAGS = 200, 500
#: By the texts between a page's brackets: its elements, with an empty text behind each tag.
_SHAPES: dict[tuple[str, ...], Page] = {}


def _regular_tags(html: str) -> tuple[tuple[str, ...], list[tuple], list[str]] | None:
    """Heads and tags of a page of regular tags alone and the text behind each (the first text stands before all tags); None: another page."""
    parts = _HEAD.split(html)
    heads = tuple(parts[1::2])
    if html.count("<") != len(heads):
        return None
    if heads in _SHAPES:
        return heads, [], parts[::2]
    tags = []
    for head in heads:
        tag = _HELD[head] if head in _HELD else _tag(head)
        if tag is None:
            return None
        tags.append(tag)
    return heads, tags, parts[::2]


class Page(HTMLParser):
    """The elements of a page in document order: ``tags``, ``classes`` and ``links``; ``last`` is the element after an
    element's last descendant, and ``texts`` the range of text pieces inside it."""

    def __init__(self, html: str | None):
        self.tags: list[str] = []
        self.classes: list[str] = []
        self.links: list[str | None] = []
        self.last: list[int] = []
        self.texts: list[list[int]] = []
        self.pieces: list[str] = []
        self.kinds: dict[tuple[str, str | None], list[int]] = {}
        self._open: list[int] = []
        self._found: dict[tuple, list[int]] = {}
        regular = _regular_tags(html or "")
        if regular is None:
            super().__init__(convert_charrefs=True)
            self.feed(html or "")
            self.close()
        else:
            heads, tags, texts = regular
            if heads in _SHAPES:
                self._like(_SHAPES[heads])
            else:
                self._read(tags)
                if len(heads) <= SHAPE_TAGS:
                    if len(_SHAPES) >= HELD_SHAPES:
                        _SHAPES.clear()
                    self._close_to(0)
                    _SHAPES[heads] = self._shape()
            self.pieces = [unescape(t) if "&" in t else t for t in texts]
        self._close_to(0)

    def _like(self, shape: Page) -> None:
        """The elements of a page with the same tags: where they begin and end hangs on the tags alone."""
        self.tags, self.classes, self.links, self.last, self.texts, self.kinds, self._found = (
            shape.tags, shape.classes, shape.links, shape.last, shape.texts, shape.kinds, shape._found)

    def _shape(self) -> Page:
        """These elements without their texts."""
        shape = Page.__new__(Page)
        shape._like(self)
        return shape

    def _read(self, tags: list[tuple]) -> None:
        """What the tokenizer would hand over, tag by tag, with a piece of text before the first tag and behind each."""
        pieces, opened, names = self.pieces, self._open, self.tags
        pieces.append("")
        for handler, tag, cls, link in tags:
            if handler == "start":
                self._start(tag, cls, link)
            elif handler == "end":
                if opened and names[opened[-1]] == tag:   # most ends: of the element opened last
                    k = opened.pop()
                    self.last[k] = len(names)
                    self.texts[k][1] = len(pieces)
                else:
                    self.handle_endtag(tag)
            elif handler:
                self._start(tag, cls, link)
                if tag not in VOID:
                    self._close_to(len(opened) - 1)
            pieces.append("")

    def _close_to(self, depth: int) -> None:
        for k in self._open[depth:]:
            self.last[k] = len(self.tags)
            self.texts[k][1] = len(self.pieces)
        del self._open[depth:]

    def _imply_end(self, tag: str) -> None:
        """An end that a start tag implies: the outermost of those that are open up to the enclosing list or table."""
        ends, stops = ENDS[tag], STOPS.get(tag, {"table"})
        for depth in range(len(self._open) - 1, -1, -1):
            name = self.tags[self._open[depth]]
            if name in ends and not any(self.tags[k] in ends for k in self._open[max(0, depth - 2):depth]):
                self._close_to(depth)
                break
            if name in stops:
                break

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._start(tag, *_class_and_link(attrs))

    def _start(self, tag: str, cls: str, link: str | None) -> None:
        if tag in ENDS:
            self._imply_end(tag)
        k = len(self.tags)
        self.tags.append(tag)
        self.classes.append(cls)
        self.links.append(link)
        self.last.append(k + 1)
        at = len(self.pieces)
        self.texts.append([at, at])
        for kind in ((tag, None), (tag, cls)):
            if kind in self.kinds:
                self.kinds[kind].append(k)
            else:
                self.kinds[kind] = [k]
        if tag not in VOID:
            self._open.append(k)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close_to(len(self._open) - 1)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self._open) - 1, -1, -1):
            name = self.tags[self._open[depth]]
            if name == tag:
                self._close_to(depth)
                return
            if name == "table" and tag not in ("div", "body", "html"):
                return

    def handle_data(self, data: str) -> None:
        self.pieces.append(data)

    def all(self, tag: str, cls: str | None = None, inside: int | None = None) -> list[int]:
        """Elements of a tag (and class) inside an element, in order."""
        if inside is None:
            return self.kinds.get((tag, cls), [])
        key = (tag, cls, inside)
        if key not in self._found:
            found = self.kinds.get((tag, cls), [])
            self._found[key] = found[bisect_left(found, inside + 1):bisect_left(found, self.last[inside])]
        return self._found[key]

    def outermost(self, tag: str) -> list[int]:
        """Elements of a tag that stand in no other of that tag."""
        if (tag,) not in self._found:
            out: list[int] = []
            for k in self.all(tag):
                if not out or k >= self.last[out[-1]]:
                    out.append(k)
            self._found[tag,] = out
        return self._found[tag,]

    def text(self, k: int) -> str:
        return "".join(self.pieces[slice(*self.texts[k])])

    def first_text(self, kind: tuple[str, str], missing: str, inside: int | None = None) -> str:
        found = self.all(*kind, inside)
        return self.text(found[0]) if found else missing


def _rows(pages: DataFrame, id_col: str, html_col: str, fields: list[T.StructField], read: Callable[[Page], list[tuple]]) -> DataFrame:
    """(id, fields): the rows that ``read`` finds in each page."""
    schema = T.StructType([pages.schema[id_col], *fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            ids, rows = [], []
            for k, body in enumerate(batch.column(1)):
                found = read(Page(body.as_py()))
                ids += [k] * len(found)
                rows += found
            columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int32())), *(pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:], strict=True))], names=arrow.names)

    ship_code(pages.sparkSession)
    return pages.select(f"`{id_col}`", f"`{html_col}`").mapInArrow(run, schema)


_STRING, _STRINGS = T.StringType(), T.ArrayType(T.StringType())
LISTING_FIELDS = ["Departure Location", "Departure Time", "Arrival Location", "Arrival Time", "Flight Duration", "Aircraft Type", "Ticket Price",
                  "Passenger Type", "Number of Tickets", "Price per Ticket", "Taxes & Fees", "Total Price", "Carry-on Baggage", "Checked Baggage"]


def _at(items: list, n: int):
    return items[n] if -len(items) <= n < len(items) else None


def read_listing(page: Page) -> list[tuple]:
    """The fields of a detail page from its four tables by position; none without the first table."""
    tables = page.outermost("table")
    if not tables:
        return []

    def texts(found: list[int]) -> list[str]:
        return [page.text(k).strip() for k in found]

    def rows(n: int) -> list[int]:
        return page.all("tr", None, tables[n]) if n < len(tables) else []

    cells = page.all("td", None, tables[0])
    one, two, three = ([texts(page.all("p", None, k)) for k in cells[:3]] + [[], [], []])[:3]
    inner = page.all("tr", None, cells[3]) if len(cells) > 3 else []
    price = _at(texts(page.all("td", None, inner[0])) if inner else [], -1)
    parts = texts(page.all("td", None, rows(1)[1])) if len(rows(1)) > 1 else []
    bags = [_at(texts(page.all("td", None, r)), 1) for r in rows(2)[1:3]] if len(rows(2)) > 2 else [None, None]
    return [(_at(one, 0), _at(one, 1), _at(three, 0), _at(three, 1), _at(two, 0), _at(two, -1), price and price.split("(")[0].strip(),
             *(parts if len(parts) == 5 else [None] * 5), *bags, texts(rows(3)[1:]) if len(tables) > 3 else None)]


def listing_rows(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row for each detail page, 15 raw columns (the scrape time is the
    reader's) from its four tables by position. A page without the first table
    is no listing and gives no row; a later table that is missing gives NULLs."""
    return _rows(pages, id_col, html_col, [*(T.StructField(n, _STRING) for n in LISTING_FIELDS), T.StructField("Refund Policy", _STRINGS)], read_listing)


def read_reviews(page: Page) -> list[tuple]:
    out = []
    for pos, k in enumerate(page.all(*REVIEW), 1):
        services = page.all(*SERVICES, k)
        rated = None if not services else [
            {"Service Rating": page.first_text(RATING, "", s), "Service Info": page.first_text(SERVICE_INFO, "", s)} for s in page.all(*SERVICE, services[0])]
        out.append((pos, *(page.first_text(kind, "", k) for kind in (RATING, REVIEW_TITLE, REVIEW_TEXT, REVIEW_INFO)), rated))
    return out


def review_rows(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per review element; '' for a missing tag; service ratings as
    an array of structs, NULL where a review has no service table."""
    service = T.ArrayType(T.StructType([T.StructField("Service Rating", _STRING), T.StructField("Service Info", _STRING)]))
    return _rows(pages, id_col, html_col, [
        T.StructField("pos", T.IntegerType()), *(T.StructField(n, _STRING) for n in ("Rating", "Title", "Full Review", "Information")),
        T.StructField("Service Ratings", service)], read_reviews)


def read_info(page: Page) -> list[tuple]:
    def pairs(kind: tuple, name: tuple, value: tuple) -> list[tuple[str, str]]:
        return list({page.first_text(name, "", k): page.first_text(value, "", k) for k in page.all(*kind)}.items())

    sites, mentions = page.all(*WEBSITE), page.all(*MENTIONS)
    links = [page.links[k] for k in page.all("a", None, sites[0])] if sites else None
    return [(*(page.first_text(kind, NOT_FOUND) for kind in INFO_TAGS.values()), links and [x for x in links if x and "http" in x],
             [page.text(k) for k in page.all(*MENTION, mentions[0])] if mentions else [],
             pairs(ATTRIBUTE, ATTRIBUTE_NAME, ATTRIBUTE_RATE), pairs(TOTAL, TOTAL_NAME, TOTAL_COUNT))]


def info_records(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One record per page with two maps; missing fields are 'Not found',
    a missing site NULL. Of repeated names in a map the last value stays."""
    pairs = T.MapType(_STRING, _STRING)
    return _rows(pages, id_col, html_col, [
        *(T.StructField(n, _STRING) for n in INFO_TAGS), T.StructField("website", _STRINGS), T.StructField("popular_mentions", _STRINGS),
        T.StructField("attributes", pairs), T.StructField("total_ratings", pairs)], read_info)
