from pyspark.sql import functions as F

from broadsheet.session import configure
from broadsheet.sources import dom, pages

CARDS = """<html><body><nav><a href="/blog/archive-of-all">all</a></nav><main>
<article><p>Gardening</p><a href="/blog/category/gardens">Gardens</a></article>
<article><a href="/blog/pruning-pears"><span>4 min</span><h2>Pruning\n old pears</h2></a></article>
<article><a href="/blog/seed-swap">Seed swap day</a><a href="/blog/map">map</a></article>
<article><a href="/blog/pruning-pears"><h2>Pears, once more</h2></a></article></main></body></html>"""
FLAT = """<main><ul><li><a href="/about">who</a><li><a href="/blog/frost">frost</a><li><a href="/blog/topic-soil">soil</a>
<li><a href="/blog/bees">bees</a><li><a href="/blog/frost">frost again</a></ul></main>"""
ARTICLE = """<html><head><script type="application/ld+json">not json]</script>
<script type="application/ld+json">{"@graph":[{"name":"k"},{"dateCreated":"Mar 06, 2026"}]}</script></head>
<body><main><aside>share</aside><h1>Why  <b>moss</b>
grows north</h1><p>It does not.</p><nav>next</nav></main></body></html>"""


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "url string, html string")


def test_card_links(spark):
    links = pages.card_links(frame(spark, ("https://e.com/blog", CARDS)), "/blog/", "/blog/category/", 20)
    got = [(r["link_pos"], r["link"], r["title"]) for r in links.orderBy("link_pos").collect()]
    assert got == [(0, "https://e.com/blog/pruning-pears", "Pruning old pears"),
                   (1, "https://e.com/blog/seed-swap", "Seed swap day map")]


def test_flat_links(spark):
    df = frame(spark, ("https://e.com/blog", FLAT))
    links = pages.page_links(df, "/blog/", "/blog/topic")
    assert [r["link"] for r in links.orderBy("link_pos").collect()] == [
        "https://e.com/blog/frost", "https://e.com/blog/bees"]
    assert pages.page_links(df, "/blog/", None, 2).count() == 2


def test_article(spark):
    df = frame(spark, ("https://e/1", ARTICLE), ("https://e/2", "<main><h1>Only</h1></main>"),
               ("https://e/3", "<article><p>No heading</p></article>"), ("https://e/4", "<p>none</p>"))
    got = {r["url"]: (r["title"], r["published_at"], r["content"]) for r in pages.page_articles(df).collect()}
    assert got == {"https://e/1": ("Why moss grows north", "2026-03-06", "It does not."),
                   "https://e/3": ("https://e/3", None, "No heading")}


def test_long_body(spark):
    long = "This first paragraph is bare text and is clearly longer than eighty characters, see & <so>."
    html = f"""<div class="x"><div class="blog-content prose"><div><a href="/b">Back</a></div><h1>T</h1>
    <div class="not-prose">{long}</div>{long.replace('&', '&amp;').replace('<', '&lt;')}
    <p>Second <a href="https://e/l">link</a>.</p><div class="SVELTE_HYDRATER">w</div><p> </p>
    <div><div>nested</div></div><ul><li>One</li></ul></div><p>after</p></div>"""
    df = frame(spark, ("u", html), ("v", "<div class='blog-content'>short</div>"), ("w", "<p>no</p>"))
    found = df.select("url", pages.long_body_markdown(F.col("html")).alias("content"))
    got = {r["url"]: r["content"] for r in found.collect()}
    assert got == {"u": f"{long}\n\nSecond [link](https://e/l).\n\nnested\n\n* One\n", "v": None, "w": None}


def test_font_container(values):
    html = "<table><td><font size='2' face='verdana'>Oct<script>x</script><br />Hello <font>in</font>.</font></td></table>"
    assert values(pages.font_container_markdown, [html, "<p>x</p>"]) == ["Oct  \nHello in.\n", None]


def test_newsletter(values):
    html = """<td class="a mcnTextContent"><h1>Week</h1><p>Intro <a href="https://e/a">A</a>.&nbsp;x</p>
    <table><tr><td></td><td>One</td></tr></table></td><td class="mcnTextContent">please UNSUBSCRIBE</td>
    <td class="mcnTextContent"><a href="p">update your preferences</a></td><td class="mcnTextContent">end F2025</td>"""
    text, plain = values(pages.newsletter_markdown, [html, "<p>plain</p>"])
    assert text == "# Week\n\nIntro [A](https://e/a). x\n\nOne\n\nend F2025" and plain == "plain"


def test_email(values):
    html = """<html><head><title> Issue 7 </title></head><body><div style="x; DISPLAY:none">hid<div>den</div> too</div><p>logo</p>
    <table><tr><td>Hey reader</td><td>cell</td></tr></table><img src="x"></body></html>"""
    assert values(pages.email_markdown, [html]) == ["Hey reader\n\ncell"]
    assert values(pages.email_title, [html, "<p>"]) == ["Issue 7", None]


def test_page_body_fills_only_first_blank_items(spark):
    items = spark.createDataFrame(
        [("s", "r", i, f"t{i}", f"u{i}", None, None, None, c) for i, c in enumerate([" ", "kept", "", ""])],
        "source_id string, run_id string, item_pos bigint, title string, url string, published_at string,"
        " author string, summary string, content string")
    fetched = frame(spark, *[(f"u{i}", f"<p>page{i}</p>") for i in (0, 1, 3)], ("u2", ""))
    got = pages.with_page_body(items, fetched, F.regexp_extract("html", "<p>(.*)</p>", 1), first_n=3)
    assert [r["content"] for r in got.orderBy("item_pos").collect()] == ["page0", "kept", "", ""]
    got = pages.with_page_body(items, fetched, F.regexp_extract("html", "<p>(.*)</p>", 1), only_blank=False)
    assert [r["content"] for r in got.orderBy("item_pos").collect()] == ["page0", "page1", "", "page3"]


def test_articles_keep_all_their_text(spark):
    """Custom elements, nested containers, containers in comments, nested asides."""
    bodies = {
        "custom": "<main><h1>T</h1><nav-bar>x</nav-bar><p>Body one</p><nav>m</nav><p>Body two</p></main>",
        "nested": "<article><h1>T</h1><p>one</p><article>card</article><p>two</p></article>",
        "comment": "<!-- <main> old </main> --><main><h1>T</h1><article><p>real</p></article></main>",
        "aside": "<main><h1>T</h1><p>a</p><aside>x<aside>y</aside>z</aside><p>b</p></main>",
        "open": "<main><h1>T</h1><p>a</p><footer>never closed <p>b</p>",
        "mixed": "<main><h1>T</h1><nav>m<aside>n</aside>o</nav><p>a</p><aside>p<nav>q</aside><p>b</p></main>",
    }
    got = {r["url"]: r["content"] for r in pages.page_articles(frame(spark, *bodies.items())).collect()}
    assert got == {
        "custom": "x\n\nBody one\n\nBody two", "nested": "one\n\ncard\n\ntwo", "comment": "real",
        "aside": "a\n\nb", "open": "a", "mixed": "a\n\nb",
    }


def test_open_elements_take_linear_time():
    import time

    from broadsheet.sources.dom import _Spans

    html = "<p>a<li>" * 20_000 + "<b>x</b></i>" * 20_000
    start = time.monotonic()
    assert len(_Spans(html).spans) == 60_000
    assert time.monotonic() - start < 5


def test_pages_are_rendered_once(spark):
    """A body that is tested for being empty and then used is one expression."""
    html = F.col("html")
    for rule in (pages.font_container_markdown, pages.long_body_markdown, pages.email_markdown):
        plan = frame(spark, ("u", "x")).select(rule(html).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("(?i:img)") == 1
        # One parse of a page, in small batches.
        assert plan.count("run(") <= 1


def test_batches_of_pages_are_small(spark):
    assert int(configure(spark).conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1_000


def test_children_are_those_of_the_first_container(spark):
    texts = ["<p>a\n</p>\n<div class='x c'>t &amp; u\n\n<b class=w>v\n</b><br>\n<i>z", "<div class=d>none</div>", "",
             "<!-- \n<div class=c> -->\n<div class=c><!--k\n--><p>1<div class=c>2</div>\n</div>3", "<div class=c", "&lt;\n<div class=c>a<"]
    df = frame(spark, *[("u", t) for t in texts], ("u", None))
    two = dom.child_nodes(F.get(dom.select_inner(F.col("html"), "div", class_="c"), F.lit(0)))
    for r in df.select(two.alias("two"), dom.first_children(F.col("html"), "div", class_="c").alias("one")).collect():
        assert r["one"] == r["two"]
    first = df.select(dom.first_children(F.col("html"), "div", class_="c").alias("n")).first()["n"]
    assert [(n["name"], n["html"]) for n in first] == [
        (None, "t &amp; u\n\n"), ("b", "<b class=w>v\n</b>"), ("br", "<br>"), (None, "\n"), ("i", "<i>z")]
