"""Operator 11: main text of web pages by equivalence-class template deduction.

The template of a host is deduced from its pages, and what the template leaves
open is extracted.

* Tokens. A page is read once (``page_tree``) into its element tree. Its tokens
  are its elements, each with its path from the root, and its texts, each with
  its path: the same tag or text in another place is another token.
* Equivalence classes. The occurrence vector of a token says how often it
  occurs on each page of the host. Vectors are compared by two 64-bit sums over
  (page, count) and the number of pages, so a token is one small row however
  many pages the host has, combined before the shuffle. Tokens of equal vectors
  form a class. Pages of equal content count once, so copies are no evidence.
* Valid classes. A class counts when it has ``SUPPORT`` different pages or more,
  a share ``SHARE`` of the host's, and holds elements: a text is template only
  if it comes and goes with elements of the page's structure.
* Nesting. Elements nest by their paths. A box (a block element that is not
  itself a paragraph, list, heading or table part) whose own texts, over all
  pages, are all of valid classes is a constant part of the template.
* Slots. The other boxes are the open slots. Of these the article's are kept:
  those inside ``main`` or ``article`` elements, and where a page marks none,
  those inside the deepest box that holds ``MOST`` of the host's text outside
  links. Elements, roles and class names that HTML itself uses for menus,
  headers, footers, sidebars, notices, adverts, forms and comments are left out
  before (fixed lists in ``page_tree``).

So a paragraph that many pages share stays as long as its box varies, and a
constant box within an article goes. Where a page would lose all its text to
the template, its text stays. Blocks of a link list outside marked articles
(``LINKS`` of their box's characters or more) are menus.

Plan. One scan parses pages into a written table of blocks (text, path and box
as 64-bit names). One shuffle of names keeps one row of each different page;
tokens are then summed by (host, token), classes and boxes follow from small
rows. A host's result has at most 1 / ``SHARE`` constant boxes for each box of
a page, and none where nothing was deduced. It is written first, so that Spark
knows its size when it joins it to the pages by host: small, it is broadcast
and no page moves; large, both are shuffled and a hot host is split.

Edge cases. Null or empty HTML, and HTML without text, give the empty text.
Pages without a host (a null or malformed URL) and hosts of few pages have no
template: the marks and the page's own boxes decide. Rows with a null id and
repeated rows each get their row. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglab.llm import page_tree
from listinglab.llm.common import drop, save, ship, slices
from listinglab.llm.page_tree import AROUND, ARTICLE, MAIN, TITLE, Block

#: Least different pages of a class, and least share of the host's different pages.
SUPPORT, SHARE = 4, 0.05
#: Part of the text that the article's box holds; part of a box's characters in links that makes it a menu, and its least links.
MOST, LINKS, LEAST_LINKS = 0.6, 0.8, 3
#: Pages that a worker holds at a time.
PAGES = 64

ELEMENT, TEXT = 0, 1

_TOKENS = T.ArrayType(T.StructType([
    T.StructField("token", T.LongType()), T.StructField("box", T.LongType()), T.StructField("kind", T.IntegerType()),
    T.StructField("count", T.IntegerType())]))
_AREAS = T.ArrayType(T.StructType([T.StructField("box", T.LongType()), T.StructField("depth", T.IntegerType()), T.StructField("chars", T.LongType())]))
_BLOCKS = T.ArrayType(T.StructType([
    T.StructField("text", T.StringType()), T.StructField("box", T.LongType()), T.StructField("boxes", T.ArrayType(T.LongType()))]))
_HOST = re.compile(r"\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\s]+)", re.I)


def host_of(url: str | None) -> str | None:
    m = _HOST.match(url or "")
    return m.group(1).lower() if m else None


def _candidates(found: list[Block]) -> tuple[list[Block], bool]:
    """The blocks that may be the article, and whether the page marks it."""
    kept = [b for b in found if not b.marks & AROUND] or found
    marked = [b for b in kept if b.marks & (MAIN | ARTICLE)]
    if marked:
        inner = [b for b in marked if b.marks & ARTICLE]
        if sum(len(b.text) for b in inner) >= MOST * sum(len(b.text) for b in marked):
            return [b for b in marked if b.marks & (ARTICLE | TITLE)], True
        return marked, True
    links = Counter(b.box for b in kept if b.linked)
    size, linked = Counter(), Counter()
    for b in kept:
        size[b.box] += len(b.text)
        linked[b.box] += b.linked
    menus = {box for box, n in links.items() if n >= LEAST_LINKS and linked[box] >= LINKS * size[box]}
    return [b for b in kept if b.box not in menus] or kept, False


def _areas(kept: list[Block]) -> list[tuple[int, int, int]]:
    """(box, depth, characters outside links) of each box with all that stands in it."""
    chars: Counter = Counter()
    depth = {}
    for b in kept:
        for k, box in enumerate(b.boxes):
            chars[box] += len(b.text) - b.linked
            depth[box] = k
    return [(box, depth[box], n) for box, n in chars.items()]


def _own_box(areas: list[tuple[int, int, int]]) -> int:
    """The deepest box with most of the page's text."""
    whole = max(n for _, _, n in areas)
    return max((a for a in areas if a[2] >= MOST * whole), key=lambda a: a[1])[0]


def _pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """A written row for each page: its candidate blocks, its tokens, and the boxes of unmarked pages."""
    id_type = pages.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("page_id", id_type), T.StructField("url", T.StringType()), T.StructField("host", T.StringType()),
        T.StructField("content", T.LongType()), T.StructField("tokens", _TOKENS), T.StructField("areas", _AREAS),
        T.StructField("own_box", T.LongType()), T.StructField("blocks", _BLOCKS)])

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None
        for batch in slices(batches, PAGES):
            columns: list[list] = [[] for _ in range(6)]
            for url, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                kept, marked = _candidates(page_tree.blocks(body or ""))
                tokens = Counter((b.token, b.box, TEXT) for b in kept)
                tokens.update((box, box, ELEMENT) for box in {x for b in kept for x in b.boxes})
                tokens.update((b.path, b.box, ELEMENT) for b in kept if b.path != b.box)
                areas = _areas(kept) if kept and not marked else None
                row = (
                    host_of(url), page_tree.name64(*sorted((*k, n) for k, n in tokens.items())),
                    [{"token": t, "box": box, "kind": kind, "count": n} for (t, box, kind), n in tokens.items()],
                    [{"box": box, "depth": d, "chars": n} for box, d, n in areas] if areas else None,
                    _own_box(areas) if areas else None,
                    [{"text": b.text, "box": b.box, "boxes": None if marked else list(b.boxes)} for b in kept])
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            if arrow is None:
                arrow = _arrow_types()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, arrow, strict=True))], schema.names)

    ship(pages.sparkSession)
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return save(source.mapInArrow(parse, schema), "pages", compression="zstd")


def _arrow_types() -> list[pa.DataType]:
    long, i32 = pa.int64(), pa.int32()
    return [
        pa.string(), long, pa.list_(pa.struct([("token", long), ("box", long), ("kind", i32), ("count", i32)])),
        pa.list_(pa.struct([("box", long), ("depth", i32), ("chars", long)])), long,
        pa.list_(pa.struct([("text", pa.string()), ("box", long), ("boxes", pa.list_(long))]))]


def occurrence_vectors(parsed: DataFrame) -> DataFrame:
    """A written table (host, token, box, kind, vector, vector2, pages): each token of a host with the sums of its occurrence vector."""
    known = parsed.where("host IS NOT NULL AND size(tokens) > 0")
    different = known.groupBy("host", "content").agg(F.first("tokens").alias("tokens"))
    one = different.select("host", "content", F.explode("tokens").alias("t")).select("host", "content", "t.*")
    return save(one.groupBy("host", "token", "box", "kind").agg(
        F.bit_xor(F.xxhash64("content", "count")).alias("vector"), F.bit_xor(F.xxhash64("count", "content", F.lit(1))).alias("vector2"),
        F.count(F.lit(1)).alias("pages")), "vectors")


def valid_texts(vectors: DataFrame) -> DataFrame:
    """(host, token, box): the texts in valid equivalence classes."""
    # The root is an element of every page: its pages are the host's.
    hosts = vectors.where((F.col("token") == 0) & (F.col("kind") == ELEMENT)).select("host", F.col("pages").alias("host_pages"))
    frequent = vectors.where(F.col("pages") >= SUPPORT).join(hosts, "host").where(F.col("pages") >= SHARE * F.col("host_pages"))
    same = ["host", "vector", "vector2", "pages"]
    elements = frequent.where(F.col("kind") == ELEMENT).select(*same).distinct()
    return frequent.where(F.col("kind") == TEXT).join(elements, same, "left_semi").select("host", "token", "box")


def constant_boxes(vectors: DataFrame) -> DataFrame:
    """(host, constant): the boxes of each host whose texts are all of valid classes."""
    texts = vectors.where(F.col("kind") == TEXT).groupBy("host", "box").agg(F.count(F.lit(1)).alias("texts"))
    template = valid_texts(vectors).groupBy("host", "box").agg(F.count(F.lit(1)).alias("template_texts"))
    found = template.join(texts, ["host", "box"]).where("texts = template_texts")
    return found.groupBy("host").agg(F.collect_set("box").alias("constant"))


def article_boxes(parsed: DataFrame) -> DataFrame:
    """(host, article): the deepest box with most of the text of the host's unmarked pages."""
    different = parsed.where("host IS NOT NULL AND areas IS NOT NULL").groupBy("host", "content").agg(F.first("areas").alias("areas"))
    areas = different.select("host", F.explode("areas").alias("a")).groupBy("host", F.col("a.box").alias("box")).agg(
        F.sum("a.chars").alias("chars"), F.max("a.depth").alias("depth"))
    whole = areas.where("box = 0").select("host", F.col("chars").alias("whole"))
    most = areas.join(whole, "host").where(F.col("chars") >= MOST * F.col("whole"))
    return most.groupBy("host").agg(F.max_by("box", F.struct("depth", "box")).alias("article"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page."""
    parsed = _pages(pages, id_col, url_col, html_col)
    vectors = occurrence_vectors(parsed)
    # Written first: Spark knows its size before it moves any page.
    template = save(constant_boxes(vectors).join(article_boxes(parsed), "host", "full"), "template")
    drop(vectors)
    known = parsed.join(template, "host", "left")
    # The host's box where the page has it.
    article = F.when(F.exists("blocks", lambda b: F.array_contains(b["boxes"], F.col("article"))), F.col("article")).otherwise(F.col("own_box"))
    inside = known.withColumn("article", article).withColumn(
        "slots", F.filter("blocks", lambda b: b["boxes"].isNull() | F.array_contains(b["boxes"], F.col("article"))))
    open_slots = F.filter("slots", lambda b: ~F.coalesce(F.array_contains(F.col("constant"), b["box"]), F.lit(False)))
    chosen = inside.withColumn("open_slots", open_slots).withColumn(
        "chosen", F.when(F.size("open_slots") > 0, F.col("open_slots")).otherwise(F.col("slots")))
    text = F.concat_ws("\n\n", F.col("chosen.text"))
    return chosen.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
