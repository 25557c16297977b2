from html import unescape
from html.entities import html5
from urllib.parse import urljoin

from pyspark.sql import functions as F

from broadsheet.functions import markup
from broadsheet.functions.lines import cap_blank_runs, clean_lines


def test_entities_resolve_once(values):
    texts = ["a &amp;lt; b", "&#38;amp;", "&#x1F600;&#233;", "&copy;&hellip;&apos;", "& x &;", "&nope;",
             "plain", ""]
    assert values(markup.decode_entities, texts) == [unescape(t) for t in texts]


def test_every_named_reference(values):
    names = sorted(html5)
    texts = [f"x &{n} y" for n in names] + [f"&{n}z" for n in names] + [f"&{n.rstrip(';')}" for n in names]
    texts += [f"&{n[:-2]};&{n}&{n}" for n in names]
    assert values(markup.decode_entities, texts) == [unescape(t) for t in texts]


def test_numeric_references(values):
    codes = [0, 1, 8, 9, 10, 11, 12, 13, 14, 31, 32, 38, 127, *range(128, 160), 160, 0xD7FF, 0xD800, 0xDFFF, 0xE000,
             0xFDCF, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0xFFFF, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 0xFFFFFFFF, 10**20]
    texts = [f"a&#{c}{end}b" for c in codes for end in (";", "", " ", ";;")]
    texts += [f"a&#{x}{c:x}{end}g" for c in codes for x in ("x", "X0000000000") for end in (";", "")]
    texts += ["&#;", "&#x;", "&#xg;", "&#", "&#00000000000065;", "&", "&&amp;", "&ampamp;", "&notit; &notin;", "a&b;c"]
    assert values(markup.decode_entities, texts) == [unescape(t) for t in texts]


def test_dot_segments(spark):
    """The examples of RFC 3986, 5.4, and some more, as the standard library resolves them."""
    refs = ["g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "g;x?y#s", "", ".", "./",
            "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "../../../../g", "/./g", "/../g", "g.", ".g",
            "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y", "g;x=1/../y", "g?y/./x", "g?y/../x", "g#s/./x",
            "g#s/../x", "/a/b/../..", "/..", "a//b/../c", "x/y/.././../z/"]
    bases = ["http://a/b/c/d;p?q", "http://a", "http://a/", "https://e.com/one", "http://a/b/?x=../y"]
    rows = [(b, r) for b in bases for r in refs]
    df = spark.createDataFrame(rows, "base string, ref string")
    got = df.select("base", "ref", markup.absolute_url(F.col("base"), F.col("ref"))).collect()
    assert {(b, r): u for b, r, u in got} == {(b, r): urljoin(b, r) for b, r in rows}



def test_text_skips_what_is_not_shown(values):
    html = '<p>Hi <b title="a>b">there</b><script>var t="</p>";</script><!-- <b>c</b> --> 3 < 4</p>'
    assert values(markup.strip_markup, [html]) == ["Hi there 3 < 4"]
    assert values(markup.visible_text, ["<p>a\n\n b</p><p> </p>c"]) == ["a b c"]


def test_hrefs(values):
    html = """<a href="/x?a=1&amp;b=2">1</a><a title="a>b" href='/y'>2</a><a href=/z>3</a>
    <A class="k" HREF=" /w ">4</A><a name="n">no</a><!-- <a href="/c"> --><area href="/no">"""
    assert values(markup.hrefs, [html]) == [["/x?a=1&b=2", "/y", "/z", "/w"]]


def test_absolute_url(spark):
    cases = {"/a": "https://e.com/a", "b": "https://e.com/blog/b", "//q/r": "https://q/r",
             "#f": "https://e.com/blog/x?y#f", "?k=1": "https://e.com/blog/x?k=1",
             "http://z/": "http://z/"}
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    got = df.select("h", markup.absolute_url(F.lit("https://e.com/blog/x?y"), F.col("h"))).collect()
    assert {r[0]: r[1] for r in got} == cases


def test_inner_and_without(values):
    assert values(lambda c: markup.inner(c, "main"), ["<x><MAIN id=1>a</main>b", "<main>open", "no"]) == [
        "a", "open", None]
    assert values(lambda c: markup.without_tags(c, ["nav", "aside"]), ["a<nav>x</NAV>b<aside>y</aside>"]) == [
        "ab"]


def test_blocks(values):
    html = "<h1>T</h1><p>one <i>two</i><br>three<p>four</p><div> </div>tail"
    assert values(markup.block_texts, [html]) == [["T", "one two three", "four", "tail"]]


def test_markdown(values):
    html = ("<h2> Head</h2>\n<p>Say <b>bold</b> and <em>soft</em>, <a class='x' href='https://e/l'>link</a>.</p>"
            "<ul>\n<li>One</li>\n<li>Two &amp; 3</li></ul><table><tr><td>c1</td><td>c2</td></tr></table>")
    assert values(markup.to_markdown, [html, "", None]) == [
        "## Head\n\nSay **bold** and *soft*, [link](https://e/l).\n\n* One\n* Two & 3\n\nc1\n\nc2", "", None]
    assert values(markup.to_markdown, ["<pre>a\n  b</pre>"]) == ["```\na\n  b\n```"]


def test_clean_lines(values):
    mail = "Banner\nHEY there  \n| --- | --- | --- | --- | --- |\n\nNine rivers\n|  |\n| cell |\n\n\nEnd\n"
    assert values(clean_lines, [mail, "Only\r\ntext", "x\nYour Daily Briefing is\ny"]) == [
        "HEY there\n\nNine rivers\n| cell |\n\nEnd", "Only\ntext", "Your Daily Briefing is\ny"]


def test_cap_blank_runs(values):
    assert values(cap_blank_runs, ["\n\nup \n\n\n\n\nmid\n\nlow\n"]) == ["up\n\n\nmid\n\nlow"]


def test_markdown_of_unclosed_tags_takes_linear_time(values):
    import time

    html = '<a href="/x">' * 40_000
    values(markup.to_markdown, ["warm <a href='/y'>up</a>"])
    start = time.monotonic()
    assert values(markup.to_markdown, [html]) == [""]
    assert values(markup.to_markdown, ["<!-- " * 40_000 + "x", "a <a href='u'>b <a href='v'>c</a></a>"]) == [
        "", "a b [c](v)"]
    assert time.monotonic() - start < 8  # quadratic patterns took minutes


def test_hostile_pages_take_linear_time(values):
    import time

    n = 1_000_000
    rules = {
        "without": lambda c: markup.without_tags(c, ["nav", "aside"]), "inner": lambda c: markup.inner(c, "main"),
        "markdown": markup.to_markdown, "hrefs": markup.hrefs, "text": markup.strip_markup, "blocks": markup.block_texts,
    }
    pieces = ["<nav>x</nav>", "<a x ", "<a x='1' y=\"2\" ", "<a href='/x' ", "<img src=x ", "<x <y ", "<main>", "<a x=<a y=", "<!-", "&amp", "<a \"", "x y=1 "]
    for rule in rules.values():
        values(rule, ["<p>warm <a href='u'>up</a></p>"])
    for piece in pieces:
        page = "<a " + piece * (n // len(piece))
        for name, rule in rules.items():
            start = time.monotonic()
            values(rule, [page])
            assert time.monotonic() - start < 10, (piece, name)


def test_dropped_elements(values):
    html = "".join(f"a{k}<nav>n<nav>m</nav>o</nav>b<aside>c</aside>" for k in range(200)) + "<nav>open"
    assert values(lambda c: markup.without_tags(c, ["nav", "aside"]), [html]) == ["".join(f"a{k}b" for k in range(200))]
    html = '<a title="x>y" href="/1">one</a><a class=k href=/2 id=z>two</a><a data-href="no">three</a>'
    assert values(markup.to_markdown, [html]) == ["[one](/1)[two](/2)three"]
