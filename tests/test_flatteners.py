import json

from broadsheet.operators.records import explode_snapshots
from broadsheet.sources import feeds, ranked, registry


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("run_id", "item_pos").collect()]


RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/">
<channel><title>c</title>
<item><guid>tide-1</guid><description><![CDATA[<ul><li>Ebb</li></ul><p>The <em>quay</em> is dry</p>]]></description>
<link>https://paper.example/tide</link><title>Harbour &amp; Quay</title><pubDate>Fri, 06 Mar 2026 08:15:00 +0100</pubDate></item>
<item><title>Nowhere to go</title></item>
<item><title>Full</title><link>https://e/3</link><author>N</author><description>short</description>
<content:encoded><![CDATA[<p>long</p>]]></content:encoded></item>
<item><title>Bare</title><guid>https://e/4</guid></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><title type="html">T1</title>
<link rel="self" href="https://a/self"/><link rel="alternate" href="https://a/1"/><updated>2026-01-02</updated>
<author><name>N</name></author><content type="html">&lt;p&gt;body&lt;/p&gt;</content></entry></feed>"""


def test_feeds(raw):
    items = feeds.feed_items(raw(RSS, ATOM, "<rss><channel>", ""))
    assert rows(items, "run_id", "item_pos", "title", "url", "author", "summary", "content") == [
        ("r0", 0, "Harbour & Quay", "https://paper.example/tide", None, "<ul><li>Ebb</li></ul><p>The <em>quay</em> is dry</p>",
         "* Ebb\n\nThe *quay* is dry"),
        ("r0", 2, "Full", "https://e/3", "N", "short", "long"),
        ("r0", 3, "Bare", "https://e/4", None, None, ""),
        ("r1", 0, "T1", "https://a/1", "N", "<p>body</p>", "body"),
    ]
    assert rows(items, "published_at")[0] == ("Fri, 06 Mar 2026 08:15:00 +0100",)


def test_feed_limit_counts_skipped_entries(raw):
    assert rows(feeds.feed_items(raw(RSS), limit=2), "title") == [("Harbour & Quay",)]
    assert rows(feeds.ranked_feed_items(raw(RSS), 3), "rank", "title") == [(1, "Harbour & Quay"), (3, "Full")]


def test_normalizer_override(raw):
    from pyspark.sql import functions as F

    items = feeds.feed_items(raw(RSS), normalizer=lambda c: F.lower(c))
    assert rows(items, "content")[1] == ("<p>long</p>",)


def test_link_list(raw):
    body = json.dumps([
        {"title": "A", "url": "https://a", "submitter_user": {"username": "u1"}, "score": 3,
         "comments_count": 1, "comments_url": "https://t/1", "created_at": "d"},
        {"title": "", "url": "https://x"},
        {"title": "B", "url": "", "comments_url": "https://t/2", "submitter_user": "u2", "score": True},
        7,
    ])
    items = ranked.link_list_items(raw(body, '{"a":1}', "broken"))
    assert rows(items, "rank", "title", "url", "author", "score", "discussion_url") == [
        (1, "A", "https://a", "u1", 3, "https://t/1"), (3, "B", "https://t/2", "u2", None, "https://t/2")]


def test_papers(raw):
    body = json.dumps([
        {"title": "T", "publishedAt": "d", "numComments": 2,
         "paper": {"id": "1", "upvotes": 5, "authors": [{"name": "N"}, {"name": "M"}]}},
        {"paper": {"title": "P", "projectPage": "https://p", "publishedAt": "e", "authors": []}},
        {"paper": {"title": "no url"}},
    ])
    assert rows(ranked.paper_items(raw(body)), "rank", "title", "url", "author", "score", "published_at") == [
        (1, "T", "https://huggingface.co/papers/1", "N", 5, "d"), (2, "P", "https://p", None, None, "e")]


def test_repos(raw):
    body = json.dumps({"items": [{"full_name": "o/r", "html_url": "https://g", "owner": {"login": "o"},
                                  "stargazers_count": 9, "language": None, "description": "d"}] * 21})
    items = ranked.repo_items(raw(body, "[]"))
    assert items.count() == 21
    assert ranked.repo_items(raw(body), limit=20).count() == 20
    first = items.orderBy("item_pos").first()
    assert (first["author"], first["score"], first["extra"]) == ("o", 9, {"language": None, "description": "d"})


def test_releases_inline_and_by_pointer(raw):
    inline = {"nodes": [{"data": [{"releases": [
        {"product": {"display_name": "P", "slug": "p", "vendor": {"display_name": "V", "slug": "v"}},
         "release_details": {"release_name": "1.0", "release_summary": "S"},
         "source": {"source_url": "https://s"}, "release_date": "d"},
        {"product": {"slug": "p"}, "slug": "rel", "created_at": "c"}]}]}]}
    pointers = {"nodes": [None, {"data": [{"other": 1}]}, {"data": [
        {"releases": 1}, [2], {"product": 3, "release_details": 6, "source": None}, {"display_name": 4, "vendor": 5},
        "Name", {"slug": "vs"}, {"release_number": 7}, "n7"]}]}
    items = ranked.release_items(raw(json.dumps(inline), json.dumps(pointers), "[]", '{"nodes":[]}'))
    assert rows(items, "run_id", "rank", "title", "url", "published_at", "author", "extra") == [
        ("r0", 1, "P — 1.0", "https://s", "d", "V", {"summary": "S"}),
        ("r0", 2, "rel", "https://releasebot.io/updates/vendor/p", "c", None, {}),
        ("r1", 1, "Name — n7", "https://releasebot.io/updates/vs/product", None, None, {}),
    ]


def test_embedded_list(raw):
    entries = [{"source": "o/r", "skillId": "k", "name": "N [x]", "installs": 5, "change": 1, "installsYesterday": 4},
               {"source": "o/r", "skillId": "z"}, {"name": "bare", "installs": True}]
    page = '<script>x("initialSkills\\":' + json.dumps(entries).replace('"', '\\"') + ',\\"more\\":[1])</script>'
    hot = ranked.embedded_list_items(raw(page, "<html>none</html>"), with_change=True)
    assert rows(hot, "rank", "title", "url", "author", "score", "extra") == [
        (1, "N [x]", "https://skills.sh/o/r/k", "o", 5,
         {"source_repo": "o/r", "skill_id": "k", "change": "1", "installs_yesterday": "4"}),
        (3, "bare", "https://skills.sh//", None, None,
         {"source_repo": "", "skill_id": "", "change": None, "installs_yesterday": None}),
    ]
    plain = ranked.embedded_list_items(raw(page))
    assert set(plain.first()["extra"]) == {"source_repo", "skill_id"}


def test_cms(raw):
    body = json.dumps([
        {"title": {"rendered": "<b>Deep</b> <i>Tech</i>"}, "link": "https://f/1", "date": "2026-01-10",
         "excerpt": {"rendered": "<p>Sum</p>"}, "content": {"rendered": "<p>Full &amp; fine</p>"}},
        {"title": {"rendered": "x"}}, {"title": {"rendered": "y"}, "link": "https://f/2"}])
    assert rows(ranked.cms_items(raw(body)), "title", "url", "summary", "content") == [
        ("Deep Tech", "https://f/1", "Sum", "Full & fine"), ("y", "https://f/2", None, None)]


def test_snapshot_documents(raw):
    docs = raw('{"archived_at":"2026-01-02","items":[{"title":"a","url":"u","rank":1,"extra":{"k":1}},{"title":"b"}]}',
               '{"archived_at":"2026-01-03"}', '{"archived_at":"2026-01-04","items":[]}')
    got = explode_snapshots(docs).orderBy("item_pos").collect()
    assert [(r["snapshot_date"], r["item_pos"], r["title"], r["extra"]) for r in got] == [
        ("2026-01-02", 0, "a", {"k": "1"}), ("2026-01-02", 1, "b", None)]


def test_registry(spark):
    table = registry.sources(spark, disabled=frozenset({"hn"}))
    assert table.count() == 34 and table.where("kind = 'blog'").count() == 26
    assert registry.sources(spark, include_disabled=False, disabled=frozenset({"hn"})).count() == 33
    assert registry.item_limit("vercel-blog") == 40
    lines = [r["line"] for r in registry.source_listing(table).collect()]
    assert lines[0] == "- hn (aggregation, api) [disabled]"
    try:
        registry.get_source("nope")
    except KeyError:
        pass
    else:
        raise AssertionError("unknown source must raise")


def test_quarantine_tells_why(spark, raw):
    from broadsheet.plans import ingest

    landed = raw(RSS, None, " \n", "just words", "<rss><channel><item>", "{")
    lost = ingest.quarantine(landed, feeds.feed_items(landed)).collect()
    assert {r["run_id"]: r["error"] for r in lost} == {
        "r1": ingest.EMPTY_PAYLOAD, "r2": ingest.EMPTY_PAYLOAD, "r3": ingest.UNKNOWN_PAYLOAD,
        "r4": ingest.BROKEN_PAYLOAD, "r5": ingest.BROKEN_PAYLOAD,
    }


def test_extra_round_trip(values):
    from broadsheet.operators import records

    texts = ['{"a":"1","b":null}', '{"n":5}', "[1]", "5", "no", None]
    assert values(records.decoded_extra, texts) == [{"a": "1", "b": None}, {"n": "5"}, None, None, None, None]
    assert values(lambda c: records.encoded_extra(records.decoded_extra(c)), texts) == [
        '{"a":"1","b":null}', '{"n":"5"}', None, None, None, None]
