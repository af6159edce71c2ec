"""The element tree of saved pages (S7-S9), and what never runs uncompiled (L1)."""

from listinglab.session import configure
from listinglab.sources import html as H
from listinglab.sources.html import Page, info_records, listing_rows, review_rows


def test_nested_and_unclosed_elements():
    p = Page("<div class='a  b'>x<div id=1 class=\"a b\">y</div>z<br>w</div><ul><li>1<li>2<ul><li>3</ul><li>4</ul><table><tr><td>a<td>b<tr><td>c</table><p>one<p>two")
    assert [p.text(k) for k in p.all("div", "a b")] == ["xyzw", "y"]
    assert [p.text(k) for k in p.all("li")] == ["1", "23", "3", "4"]
    assert [p.text(k) for k in p.all("td")] == ["a", "b", "c"] and [p.text(k) for k in p.all("tr")] == ["ab", "c"]
    assert [p.text(k) for k in p.all("p")] == ["one", "two"]
    assert p.all("div", None, p.all("div")[0]) == [1] and p.all("li", None, p.all("ul")[1]) == p.all("li")[2:3]


def test_entities_links_and_outer_tables():
    p = Page("<a href='/x?a=1&amp;b=2'>&lt;&eacute;&#233;&#xe9;&nbsp;&amp;amp;</a><table>1<table>2</table></table></b></td><table>3")
    assert p.links[0] == "/x?a=1&b=2" and p.text(0) == "<ééé &amp;"
    assert [p.text(k) for k in p.outermost("table")] == ["12", "3"]
    assert Page(None).tags == [] and Page("plain").tags == []


def test_long_pages_are_read_once(spark):
    block = '<div class="lwGaE A"><div class="biGQs _P fiohW uuBRH">t{}</div><span class="JguWG">{}</span></div>'
    page = "".join(block.format(k, "text &amp; more " * 20) for k in range(3000))
    got = review_rows(spark.createDataFrame([(1, page)], "page_id long, html string")).collect()
    assert [(r.pos, r.Title) for r in got] == [(k + 1, f"t{k}") for k in range(3000)]


def test_empty_tables_keep_their_schema(spark):
    none = spark.createDataFrame([], "page_id string, html string")
    for read in (listing_rows, review_rows, info_records):
        assert read(none).collect() == [] and read(none).columns[0] == "page_id"


def test_no_stage_of_the_clean_chain_runs_uncompiled(spark):
    """HotSpot leaves methods of over 8,000 bytes to its interpreter; stages above that run in Spark's split methods."""
    assert configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "9000")
    assert configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "9000"
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def _events(page: Page) -> tuple:
    return page.tags, page.classes, page.links, page.last, [page.text(k) for k in range(len(page.tags))], page.kinds, "".join(page.pieces)


def test_regular_tags_are_read_without_the_tokenizer(monkeypatch):
    """Pages of regular tags alone do not go through the tokenizer; they and all others give what it gives."""
    regular = ["<!DOCTYPE html><div class='a  b' id=1>x &lt; &amp;amp; y > z<br/><img src=x.png><a HREF='/q?a=1&amp;b=2' href=z>t</a></div >tail &amp",
               "<ul><li>1<li>2<table><tr><td>a<td>b</table></ul></b><!-- note --><P/><p class = q>&nbsp;\n", "", "plain &eacute;"]
    other = ["<p title='a>b'>x</p>", "a < b <p>c", "<script>if (a<b) '</p>'</script><p>x", "<a b=x'y c='z'>t</a>", "<p", "<p class=a", "<!-- <p> --><p>x", "<a b='>t</a>", "</>x<>",
             "<style>p > a</style>", "<?x y><p>z", "<!-->x--><p>"]
    cases = [*regular, *other, *[a + b for a in regular for b in other]]
    got = [_events(Page(x)) for x in cases]
    with monkeypatch.context() as m:
        m.setattr(H, "_regular_tags", lambda html: None)
        assert got == [_events(Page(x)) for x in cases]
    monkeypatch.setattr(Page, "feed", lambda self, html: (_ for _ in ()).throw(AssertionError(html)))
    assert [_events(Page(x)) for x in regular] == got[:len(regular)]
    monkeypatch.setattr(H, "HELD_TAGS", 3)   # a worker keeps a bounded number of tags
    assert _events(Page("".join(f"<p class=c{k}>" for k in range(50))))[1] == [f"c{k}" for k in range(50)] and len(H._HELD) <= 3


def test_pages_of_the_same_tags_share_their_tree(monkeypatch):
    """Their texts alone differ; empty ones, references and a bounded number of trees included."""
    page = "<div class=x>{}<p>{}<b>{}</b>{}<ul><li>{}<li>{}</ul></div>{}"
    filled = [page.format(*("" if (k >> j) & 1 else f"t{k}&amp;{j} > " for j in range(7))) for k in range(128)]
    monkeypatch.setattr(H, "_SHAPES", {})
    got = [_events(Page(x)) + (Page(x).all("li", None, 0), Page(x).outermost("div")) for x in filled]
    assert len(H._SHAPES) == 1 and Page(filled[0]).tags is Page(filled[1]).tags
    with monkeypatch.context() as m:
        m.setattr(H, "_regular_tags", lambda html: None)
        assert got == [_events(Page(x)) + (Page(x).all("li", None, 0), Page(x).outermost("div")) for x in filled]
    monkeypatch.setattr(H, "HELD_SHAPES", 3)
    for k in range(20):
        assert Page("<p>" * k + "a").tags == ["p"] * k and len(H._SHAPES) <= 3
    monkeypatch.setattr(H, "SHAPE_TAGS", 1)
    assert Page("<i><i>a<b>c").text(1) == "ac" and len(H._SHAPES) <= 3
