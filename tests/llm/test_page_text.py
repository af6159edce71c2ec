"""Main text of pages: blocks, marks, deduced templates, hard rows."""

import html
import re

import duckdb

from listinglab.llm import page_text, page_tree
from listinglab.llm.registry import op11_page_text

from tests.llm.conftest import SMALL

SCHEMA = "page_id long, url string, html string, host string, text string, tokens string"


def texts(spark, pages):
    rows = [(k, url, page, "h", None, "t") for k, (url, page) in enumerate(pages)]
    out = page_text.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.n_chars == len(r.text) for r in out)
    return {r.page_id: r.text for r in out}


def own(page):
    return "\n\n".join(b.text for b in page_text._candidates(page_tree.blocks(page))[0])


def test_blocks():
    assert own("<article><p>a <b>b</b>c<br>d\n e&amp;amp;&nbsp;f &lt;p&gt; &#x41;&copy 1 < 2</article>") == "a bc d e&amp; f <p> A© 1 < 2"
    assert own("<ARTICLE><h2>T</h2>one<p>two<p>three<ul><li>x<li>y</ul><table><tr><td>1<td>2</table></ARTICLE>") == "T\n\none\n\ntwo\n\nthree\n\nx\n\ny\n\n1\n\n2"
    assert own("<article><!-- <p>no</p> --><script>var a='<p>no</p>';</script><style>p{}</style>yes<![CDATA[x]]></article>") == "yes"
    assert own('<article><p title="a > b">yes</p><p data-x=\'<p>\'>too') == "yes\n\ntoo"
    assert own("<article><pre>a\n  b</pre></div></span></article><p>after") == "a b"
    assert own("") == own("   ") == own("<html><head><title>t</title></head><body></body></html>") == own("<!--") == own("<script>") == ""


def test_marks():
    page = (
        "<html><body class='has-sidebar'><header><h1>Site</h1></header><div id=mainNav><a href=/>Home</a></div><main><div class=breadcrumb>a / b</div>"
        "<article class='post has-comments'><header><h1>Title</h1></header><p>One.</p><div class='ad-slot'><p>Buy</p></div><aside>See also</aside>"
        "<form><label>Mail</label><input></form><blockquote>Two.</blockquote><div class='cookieNotice'>We use cookies</div><p>Three <span class=share>Share"
        "</span>ends.</p><footer>Written by</footer></article><section id=comments><article class=comment><p>First!</p></article><article>Second!</article>"
        "</section></main><div class=sidebar><p>Side</p></div><footer>&copy; Site</footer></body></html>")
    assert own(page) == "Title\n\nOne.\n\nTwo.\n\nThree ends."
    assert own("<body><nav><ul><li>Home<article><p>Text</p></article>") == "Text"
    assert own("<body><form id=all><div><p>Only text in a form.</p></div></form>") == "Only text in a form."
    assert own("<div role=navigation>x</div><div role=main><p>y</p></div><div role=contentinfo>z</div>") == "y"
    assert own("<p>In a sentence about cookies and menus, nothing is lost.</p>") == "In a sentence about cookies and menus, nothing is lost."


def test_names_run_together():
    for name in ("topnav", "siteMenu", "cookiebar", "sitenotice", "adslot-3", "leftsidebar", "pagefooter", "siteheader", "usercomments", "promobox", "right-rail", "post-comments"):
        assert own(f"<body><div class='{name}'><p>Not this.</p></div><div><p>But this.</p></div></body>") == "But this.", name
    for name in ("commentary", "post-header", "entry-content", "adventure", "story-text", "no-sidebar", "footnotes", "shared-history"):
        assert own(f"<body><div class='{name}'><p>This, too.</p></div><div><p>And this.</p></div></body>") == "This, too.\n\nAnd this.", name


def story(k):
    return [f"Paragraph {n} of story {k} tells of number {k * 31 + n} at some length, as stories do." for n in range(4)]


def unmarked(k, body=None):
    """A template without any telling name."""
    paragraphs = "".join(f"<p>{p}</p>" for p in body or story(k))
    return (
        f"<html><body><div class=x1><a href=/1>Start</a><a href=/2>News</a><a href=/3>Contact</a></div><div class=x2><p>Tip of the day: number {k}</p></div>"
        f"<div class=x3 id=p{k}><h2>Story {k}</h2><div class=x4><p>Read this paper every day.</p></div>{paragraphs}<div class=x5>All our stories are free.</div></div>"
        f"<div class=x6>Made by us</div></body></html>")


def test_template_of_a_host(spark):
    shared = "A passage that many stories share, word for word, in their own text."
    pages = [("http://a.example/%d" % k, unmarked(k)) for k in range(10)]
    pages += [("http://a.example/s%d" % k, unmarked(k, [*story(k), shared])) for k in range(20, 30)]
    pages += [("http://a.example/copy", unmarked(0))] * 15
    got = texts(spark, pages)
    for k in range(10):
        assert got[k] == "\n\n".join([f"Story {k}", *story(k)])
    for k in range(20, 30):
        assert got[k - 10] == "\n\n".join([f"Story {k}", *story(k), shared])
    assert {got[k] for k in range(20, 35)} == {got[0]}


def test_copies_are_no_template(spark):
    """A host of one article many times, and one of near copies: no paragraph goes."""
    page = "<body><nav>n</nav><article><p>{}</p><p>Same words.</p><p>Same again.</p></article></body>"
    pages = [("http://one.example/%d" % k, page.format("Same start.")) for k in range(12)]
    pages += [("http://near.example/%d" % k, page.format(f"Start {k}.")) for k in range(12)]
    got = texts(spark, pages)
    assert {got[k] for k in range(12)} == {"Same start.\n\nSame words.\n\nSame again."}
    assert all(got[12 + k] == f"Start {k}.\n\nSame words.\n\nSame again." for k in range(12))


def test_constant_box_of_some_pages(spark):
    """An optional part of the template: a box on half of the pages, always alike."""
    box = "<div class=q><b>Read on</b> in our archive</div>"
    pages = [("http://b.example/%d" % k, f"<article><p>{story(k)[0]}</p>{box if k % 2 else ''}<p>{story(k)[1]}</p></article>") for k in range(12)]
    got = texts(spark, pages)
    assert all(got[k] == "\n\n".join(story(k)[:2]) for k in range(12))
    # Too few pages to tell.
    assert texts(spark, pages[1:2])[0] == "\n\n".join([story(1)[0], "Read on in our archive", story(1)[1]])


def test_vectors_against_brute_force(spark):
    pages = [("http://a.example/%d" % k, unmarked(k)) for k in range(8)] + [("http://b.example/%d" % k, unmarked(k % 3)) for k in range(8)]
    parsed = page_text._pages(spark.createDataFrame([(k, *p, "h", None, "t") for k, p in enumerate(pages)], SCHEMA), "page_id", "url", "html")
    seen, vectors = set(), {}
    for r in parsed.collect():
        if (r.host, r.content) not in seen:
            seen.add((r.host, r.content))
            for t in r.tokens:
                vectors.setdefault((r.host, t.token, t.box, t.kind), set()).add((r.content, t["count"]))
    got = page_text.occurrence_vectors(parsed).collect()
    assert {(r.host, r.token, r.box, r.kind): r.pages for r in got} == {k: len(v) for k, v in vectors.items()}
    mine, brute = {}, {}
    for r in got:
        mine.setdefault((r.host, r.vector, r.vector2), set()).add((r.token, r.kind))
    for (host, token, _, kind), v in vectors.items():
        brute.setdefault((host, frozenset(v)), set()).add((token, kind))
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, brute.values()))


def expected(page):
    inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
    found = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(x for x in found if x)


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{SMALL}/pages.parquet'").fetchall()
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in op11_page_text(spark, SMALL).collect()}
    assert got == {i: (u, expected(h), len(expected(h))) for i, u, h in rows}


def test_hard_rows(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 30_000
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    pages = [(None, None), ("", ""), ("not a url", "<article>x</article>"), (None, "plain text only"), ("http://H.example:80/", long), ("http://h.example", deep),
             ("http://h.example/", "<article>\u0000 \U0001f600 &#0; &#xD800; &bogus;</article>"), ("http://h.example/", "<<p>>a</p"), ("HTTP://u@H.example/x", "<p 'unclosed>b")]
    got = texts(spark, pages + pages[2:4])
    assert [got[k] for k in (0, 1, 2, 3)] == ["", "", "x", "plain text only"]
    assert got[4] == "\n\n".join(["word & word"] * 30_000) and got[5] == "deep" and got[9] == "x" and got[10] == "plain text only"
    assert [page_text.host_of(u) for u in ("http://H.example:80/", "HTTP://u@H.example/x", None, "x")] == ["h.example", "h.example", None, None]
    twice = spark.createDataFrame([(None, "http://a.example", "<p>x</p>")] * 2, "page_id long, url string, html string")
    assert [tuple(r) for r in page_text.extract(twice).collect()] == [(None, "http://a.example", "x", 1)] * 2
    assert page_text.extract(twice.limit(0)).collect() == []
