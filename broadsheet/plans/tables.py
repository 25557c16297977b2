"""The given tables read as an archive.

Posts come from ``documents``, ranked snapshots from ``events``, discussion
threads from ``conversations``, fetched pages from ``pages``; ``labels`` mark
which documents are stored already and in what state. Landed payloads are
built from the same rows in pages of a fixed number of neighbouring ids, so no
payload grows with the data.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.text import content_path, item_id
from broadsheet.operators.ranking import last_per_key
from broadsheet.sources.registry import checked_small

RANKED_POS = 1000
DISABLED_SOURCE = "src7"
FEED_PAGE = 20
RANKED_PAGE = 25
LINK_PAGE = 30
MANIFEST_PAGE = 400
SNAPSHOT_PAGE = 200
#: Every so many rows meet each kind of damage once.
DAMAGE = 50


# The given tables as stored. Nothing is inferred, so building a
# plan reads no file.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "pages": "page_id bigint, url string, html string",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(value) -> Column:
    return value.cast("string")


def _archived_at() -> Column:
    day = F.lpad(_text(F.col("doc_id") % 28 + 1), 2, "0")
    clock = (
        F.when(F.col("lang") == "en", "T00:00:00Z")
        .when(F.col("lang") == "de", "T23:30:00-05:00")
        .otherwise("T12:30:00+02:00")
    )
    return F.concat(F.lit("2026-01-"), day, clock)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive post per document; exact copies within a source share a url."""
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("source_id"),
        F.col("doc_id").alias("item_pos"),
        title.alias("title"),
        F.concat(
            F.lit("https://"), "source", F.lit(".example.org/"), F.substring(F.sha1("text"), 1, 12)
        ).alias("url"),
        F.concat(F.lit("2025-12-"), F.lpad(_text(F.col("n_chars") % 28 + 1), 2, "0")).alias(
            "published_at"
        ),
        _archived_at().alias("archived_at"),
        F.concat(F.lit("desk-"), "lang").alias("author"),
        title.alias("summary"),
        F.col("text").alias("content"),
        "lang",
    )


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts in stored form: id, path, body and whether they are archived yet.

    The label of a document decides what state its stored body is in.
    """
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("item_pos"), "quality", "toxic"
    )
    df = posts(spark, sf_dir).join(labels, "item_pos", "left")
    q, t = F.col("quality"), F.col("toxic")
    key = item_id(F.col("title"), F.col("url"))
    lost = F.coalesce((q == 0) & (t == 1), F.lit(False))
    absent = F.coalesce((q == 1) & (t == 0) & (F.col("lang") == "de"), F.lit(False))
    body = (
        F.when((q == 0) & (t == 0), "")
        .when((q == 1) & (t == 1), F.concat(F.lit("|  |\n"), "content"))
        .when((q == 1) & (F.col("lang") == "es"), F.concat(F.lit("[Signup] "), "content"))
        .otherwise(F.col("content"))
    )
    return df.select(
        "source_id", "item_pos", "title", "url", "published_at", "archived_at", "author",
        "summary", "lang", "quality", "toxic",
        key.alias("id"),
        F.when(~lost, content_path(F.col("source_id"), key)).alias("content_path"),
        body.alias("body"),
        (~lost & ~absent).alias("has_body"),
        q.isNotNull().alias("archived"),
    )


def archived(store_rows: DataFrame) -> DataFrame:
    return store_rows.where("archived")


def contents(store_rows: DataFrame) -> DataFrame:
    """Stored bodies; writing the same path twice keeps the later body."""
    held = store_rows.where("has_body").select(
        "source_id", F.col("id").alias("item_id"), "content_path", "item_pos",
        F.col("body").alias("content"),
    )
    return last_per_key(held, ["content_path"], ["item_pos"]).drop("item_pos")


def damaged_bodies(store_rows: DataFrame) -> DataFrame:
    """Bodies as bytes, some damaged: a byte that is no UTF-8, a NUL, a replaced character."""
    k = F.col("item_pos") % DAMAGE
    head = F.when(k == 17, F.lit("x\0")).when(k == 27, F.lit("\ufffd")).otherwise("")
    tail = F.when(k == 7, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    return store_rows.withColumn("body", F.concat(F.encode(F.concat(head, "body"), "UTF-8"), tail))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ranked entry per event, in event order within its day."""
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("snapshot_date"),
        F.col("event_id").alias("item_pos"),
        F.concat("event_type", F.lit(" by the user "), _text(F.col("user_id"))).alias("title"),
        F.concat(
            F.lit("https://"), "event_type", F.lit(".example.net/u/"), _text(F.col("user_id"))
        ).alias("url"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"),
        F.concat(F.lit("user-"), _text(F.col("user_id"))).alias("author"),
        F.round(F.col("value") * 100).cast("bigint").alias("score"),
        k.cast("bigint").alias("comments_count"),
        (F.col("event_id") % RANKED_PAGE + 1).cast("int").alias("rank"),
        F.create_map(F.lit("k"), k).alias("extra"),
    )


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a look at its user's page, which shows the kind of the event."""
    return as_sightings(table(spark, sf_dir, "events"))


def as_sightings(events: DataFrame) -> DataFrame:
    desk = F.concat(F.lit("desk-"), _text(F.col("user_id") % 5))
    return events.select(
        desk.alias("source_id"),
        F.concat(F.lit("https://users.example.net/"), _text(F.col("user_id"))).alias("url"),
        F.col("ts").alias("seen_at"),
        F.col("event_id").alias("tie"),
        F.sha1("event_type").alias("content_hash"),
    )


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources found in the data; the regions are desks that deliver nothing."""
    archive = table(spark, sf_dir, "documents").select("source").distinct().select(
        F.substring("source", 4, 9).cast("int").alias("source_pos"),
        F.col("source").alias("source_id"),
        F.concat(F.lit("Archive "), "source").alias("source_name"),
        F.lit("blog").alias("kind"),
        F.lit("rss").alias("method"),
        (F.col("source") != DISABLED_SOURCE).alias("enabled"),
        F.lit(None).cast("int").alias("item_limit"),
    )
    ranked = table(spark, sf_dir, "events").select("event_type").distinct().select(
        F.lit(RANKED_POS).alias("source_pos"),
        F.col("event_type").alias("source_id"),
        F.concat(F.lit("Ranking "), "event_type").alias("source_name"),
        F.lit("aggregation").alias("kind"),
        F.lit("api").alias("method"),
        F.lit(True).alias("enabled"),
        F.lit(20).alias("item_limit"),
    )
    idle = table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 2 * RANKED_POS).cast("int").alias("source_pos"),
        F.concat(F.lit("region-"), _text(F.col("r_regionkey"))).alias("source_id"),
        F.concat(F.lit("Desk "), "r_name").alias("source_name"),
        F.lit("blog").alias("kind"),
        F.lit("html").alias("method"),
        F.lit(True).alias("enabled"),
        F.lit(20).alias("item_limit"),
    )
    return checked_small(archive.unionByName(ranked).unionByName(idle))


# --- landed payloads --------------------------------------------------------


def _page(column: str, size: int) -> Column:
    return F.floor(F.col(column) / size)


def _pages(rows: DataFrame, source_id: str, key: str, size: int, entry: Column) -> DataFrame:
    """Entries of ``size`` neighbouring ids per landed document, in id order."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), entry.alias("entry"))))
    return (
        rows.groupBy(_page(key, size).alias("page"))
        .agg(F.transform(listed, lambda x: x["entry"]).alias("entries"))
        .select(
            F.lit(source_id).alias("source_id"),
            F.concat(F.lit("run-"), _text(F.col("page"))).alias("run_id"),
            "entries",
        )
    )


def _escaped(col: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        col = F.replace(col, F.lit(char), F.lit(entity))
    return col


def _body(pages: DataFrame, head: str, separator: str, tail: str) -> DataFrame:
    joined = F.array_join("entries", separator)
    return pages.select(
        "source_id", "run_id", F.concat(F.lit(head), joined, F.lit(tail)).alias("body")
    )


def landed_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.concat(
        F.lit("<item><title>"), _escaped(F.col("title")),
        F.lit("</title><link>"), F.col("url"),
        F.lit("</link><pubDate>"), F.col("published_at"),
        F.lit("</pubDate><author>"), F.col("author"),
        F.lit("</author><content:encoded>"), _escaped(F.col("content")),
        F.lit("</content:encoded></item>"),
    )
    pages = _pages(posts(spark, sf_dir), "feed", "item_pos", FEED_PAGE, entry)
    head = (
        '<?xml version="1.0" encoding="UTF-8"?><rss version="2.0" '
        'xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>Posts</title>'
    )
    return _body(pages, head, "", "</channel></rss>")


def damaged_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds of which every fourth was cut off in transfer."""
    page = F.substring("run_id", 5, 20).cast("bigint")
    cut = F.regexp_replace("body", "</channel></rss>$", "")
    return landed_feeds(spark, sf_dir).withColumn(
        "body", F.when(page % 4 == 3, cut).otherwise(F.col("body"))
    )


def idle_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the idle desks landed: nothing, plain text, or a feed that was cut off."""
    key = F.col("r_regionkey")
    body = (
        F.when(key % 4 == 1, F.lit(" \n"))
        .when(key % 4 == 2, F.col("r_name"))
        .otherwise(F.concat(F.lit("<rss><channel><item><title>"), "r_name"))
    )
    return table(spark, sf_dir, "region").where(key % 4 != 0).select(
        F.concat(F.lit("region-"), _text(key)).alias("source_id"),
        F.lit("run-0").alias("run_id"),
        body.alias("body"),
    )


def landed_cms(spark: SparkSession, sf_dir: str) -> DataFrame:
    def rendered(html: Column) -> Column:
        return F.struct(html.alias("rendered"))

    entry = F.to_json(
        F.struct(
            rendered(F.concat(F.lit("<b>"), _escaped(F.col("title")), F.lit("</b>"))).alias("title"),
            F.col("url").alias("link"),
            F.col("published_at").alias("date"),
            rendered(
                F.concat(F.lit("<p>"), _escaped(F.col("content")), F.lit("</p>"))
            ).alias("content"),
        )
    )
    return _body(_pages(posts(spark, sf_dir), "cms", "item_pos", FEED_PAGE, entry), "[", ",", "]")


def landed_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers; those of an odd number of characters only have a project page."""
    own = F.col("n_chars") % 2 == 0
    rows = table(spark, sf_dir, "documents").withColumn(
        "title", F.split_part("text", F.lit("\n"), F.lit(1))
    )
    entry = F.to_json(
        F.struct(
            F.struct(
                "title",
                F.when(own, F.col("doc_id")).alias("id"),
                F.concat(F.lit("https://project.example.org/"), _text(F.col("doc_id"))).alias(
                    "projectPage"
                ),
                F.col("n_chars").alias("upvotes"),
                F.array(F.struct(F.concat(F.lit("desk-"), "lang").alias("name"))).alias("authors"),
            ).alias("paper"),
            F.col("source").alias("publishedAt"),
            (F.col("doc_id") % 7).alias("numComments"),
        )
    )
    return _body(_pages(rows, "papers", "doc_id", FEED_PAGE, entry), "[", ",", "]")


def landed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link lists; the submitter is an object or a plain string."""
    rows = snapshots(spark, sf_dir)
    plain = F.col("comments_count") % 2 == 0
    talk = F.concat(F.lit("https://talk.example.net/"), _text(F.col("item_pos")))

    def fields(submitter: Column) -> Column:
        return F.to_json(
            F.struct(
                "title",
                F.when(F.col("comments_count") >= 10, F.col("url")).alias("url"),
                talk.alias("comments_url"),
                F.col("published_at").alias("created_at"),
                submitter.alias("submitter_user"),
                "score",
                "comments_count",
            )
        )

    entry = F.when(plain, fields(F.col("author"))).otherwise(
        fields(F.struct(F.col("author").alias("username")))
    )
    return _body(_pages(rows, "links", "item_pos", LINK_PAGE, entry), "[", ",", "]")


def landed_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshots(spark, sf_dir)
    entry = F.to_json(
        F.struct(
            F.col("title").alias("full_name"),
            F.when(F.col("comments_count") >= 10, F.col("url")).alias("html_url"),
            F.col("published_at").alias("created_at"),
            F.struct(F.col("author").alias("login")).alias("owner"),
            F.col("score").alias("stargazers_count"),
            F.col("source_id").alias("language"),
            F.col("snapshot_date").alias("description"),
        )
    )
    pages = _pages(rows, "repos", "item_pos", RANKED_PAGE, entry)
    return _body(pages, '{"items":[', ",", "]}")


def landed_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases behind a reference table: slot 1 lists the slots of the rest."""
    rows = snapshots(spark, sf_dir)
    entry = F.to_json(
        F.struct(
            F.struct(
                F.when(F.col("comments_count") >= 10, F.col("author")).alias("display_name"),
                F.col("source_id").alias("slug"),
                F.struct(
                    F.concat(F.lit("vendor-"), "source_id").alias("display_name"),
                    F.lit("v").alias("slug"),
                ).alias("vendor"),
            ).alias("product"),
            F.struct(
                F.when(F.col("comments_count") >= 50, F.col("title")).alias("release_name"),
                F.concat(F.lit("v"), _text(F.col("item_pos"))).alias("release_number"),
                F.when(F.col("comments_count") >= 90, F.col("url")).alias("release_summary"),
            ).alias("release_details"),
            F.struct(
                F.when(F.col("comments_count") >= 20, F.col("url")).alias("source_url")
            ).alias("source"),
            F.col("published_at").alias("release_date"),
        )
    )
    pages = _pages(rows, "releases", "item_pos", RANKED_PAGE, entry)
    slots = F.array_join(F.sequence(F.lit(2), F.size("entries") + 1).cast("array<string>"), ",")
    return pages.select(
        "source_id",
        "run_id",
        F.concat(
            F.lit('{"nodes":[null,{"data":[{"releases":1},['), slots, F.lit("],"),
            F.array_join("entries", ","), F.lit("]}]}"),
        ).alias("body"),
    )


def landed_embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose script holds an escaped JSON list."""
    rows = snapshots(spark, sf_dir)
    entry = F.to_json(
        F.struct(
            F.concat("source_id", F.lit("/"), "author").alias("source"),
            _text(F.col("item_pos")).alias("skillId"),
            F.when(F.col("comments_count") >= 10, F.col("title")).alias("name"),
            F.col("score").alias("installs"),
            F.col("comments_count").alias("change"),
        )
    )
    escaped = F.replace(entry, F.lit('"'), F.lit('\\"'))
    pages = _pages(rows, "embedded", "item_pos", RANKED_PAGE, escaped)
    return _body(
        pages, '<html><script>rows.add([7,"{\\"initialSkills\\":[', ",", ']}"])</script></html>'
    )


def landed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot documents, one per source, day and page of neighbouring events."""
    fields = [
        "title", "url", "published_at", "author", "score", "comments_count", "rank", "extra",
    ]
    entry = F.to_json(F.struct(*fields)).alias("entry")
    listed = F.array_sort(F.collect_list(F.struct("item_pos", entry)))
    return (
        snapshots(spark, sf_dir)
        .groupBy("source_id", "snapshot_date", _page("item_pos", RANKED_PAGE).alias("page"))
        .agg(F.array_join(F.transform(listed, lambda x: x["entry"]), ",").alias("items"))
        .select(
            "source_id",
            F.concat(
                F.lit('{"archived_at":"'), "snapshot_date", F.lit('","items":['), "items",
                F.lit("]}"),
            ).alias("body"),
        )
    )


def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot files with faulty entries, for the audit."""
    k = F.col("comments_count")
    entry = F.when(k == 99, _text(k)).otherwise(
        F.to_json(
            F.struct(
                F.when(k < 5, "").otherwise(F.col("title")).alias("title"),
                F.when(k.between(5, 9), "").otherwise(F.col("url")).alias("url"),
            )
        )
    )
    listed = F.array_sort(F.collect_list(F.struct("item_pos", entry.alias("entry"))))
    page = _page("item_pos", SNAPSHOT_PAGE)
    return (
        snapshots(spark, sf_dir)
        .groupBy("source_id", "snapshot_date", page.alias("page"))
        .agg(F.transform(listed, lambda x: x["entry"]).alias("entries"))
        .select("source_id", F.explode(_with_broken(
            F.concat(
                F.lit("sources/"), "source_id", F.lit("/snapshots/"), "snapshot_date", F.lit("-"),
                _text(F.col("page")),
            ),
            ".json",
            F.concat(F.lit('{"items":['), F.array_join("entries", ","), F.lit("]}")),
            F.col("page") % 5 == 0,
            {"-bad": F.lit("{"), "-list": F.lit('{"items":{"a":1}}'), "-none": F.lit('{"items":[]}')},
        )).alias("f"))
        .select("source_id", "f.path", "f.content")
    )


def _with_broken(path: Column, ending: str, content: Column, where: Column, broken: dict[str, Column]):
    """A file as (path, content), with broken ones of like names beside it in some places."""

    def file(name: str, body: Column) -> Column:
        return F.struct(F.concat(path, F.lit(name + ending)).alias("path"), body.alias("content"))

    beside = [F.when(where, file(name, body)) for name, body in broken.items()]
    return F.filter(F.array(file("", content), *beside), lambda f: f.isNotNull())


def manifest_files(store_rows: DataFrame) -> DataFrame:
    """Manifest files with faulty lines, for the audit."""
    q, t = F.col("quality"), F.col("toxic")
    lost = F.coalesce((q == 0) & (t == 1), F.lit(False))
    bare = F.coalesce((q == 0) & (t == 0) & (F.col("lang") != "en"), F.lit(False))
    line = F.when(lost & (F.col("lang") == "en"), F.lit('{"id": ')).otherwise(
        F.to_json(
            F.struct(
                F.when(lost, "").otherwise(F.col("id")).alias("id"),
                "source_id",
                F.when(bare, "").otherwise(F.col("url")).alias("url"),
                "published_at", "archived_at", "content_path",
            )
        )
    )
    listed = F.array_sort(F.collect_list(F.struct("item_pos", line.alias("line"))))
    return (
        store_rows.groupBy("source_id", _page("item_pos", MANIFEST_PAGE).alias("page"))
        .agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n\n").alias("text"))
        .select("source_id", F.explode(_with_broken(
            F.concat(F.lit("sources/"), "source_id", F.lit("/manifest-"), _text(F.col("page"))),
            ".jsonl",
            F.encode("text", "UTF-8"),
            F.col("page") == 0,
            {"-bad": F.unhex(F.lit("FF0A")), "-none": F.encode(F.lit(" \n\n"), "UTF-8")},
        )).alias("f"))
        .select("source_id", "f.path", "f.content")
    )


def metas(store_rows: DataFrame) -> DataFrame:
    """Side files; Spanish items lost theirs, French ones kept an old url, some are damaged."""
    k = F.col("item_pos") % DAMAGE
    own = F.struct(
        F.when(k == 13, F.lit("other")).otherwise(F.col("id")).alias("id"),
        F.when(F.col("lang") == "fr", F.concat("url", F.lit("#old"))).otherwise(F.col("url")).alias("url"),
        F.when(k == 23, F.lit("elsewhere")).otherwise(F.col("content_path")).alias("content_path"),
    )
    held = store_rows.where("lang != 'es'").select(
        "source_id",
        F.col("id").alias("item_id"),
        "item_pos",
        F.when(k == 3, F.lit("{")).otherwise(F.to_json(own)).alias("content"),
    )
    return last_per_key(held, ["source_id", "item_id"], ["item_pos"]).drop("item_pos")


def layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of the sources: archives, rankings, and desks that hold neither."""
    kind = F.col("kind")
    idle = F.col("source_id").startswith("region-")
    return dimension(spark, sf_dir).select(
        "source_id",
        F.concat(F.lit("sources/"), "source_id").alias("path"),
        F.when(idle | (kind != "blog"), 0).otherwise(1).alias("manifests"),
        F.when(kind == "aggregation", 1).otherwise(0).alias("snapshots"),
    )


# --- threads ---------------------------------------------------------------

def _stride(turns: DataFrame) -> Column:
    """Ids that a conversation needs: one more than the longest has turns before."""
    longest = turns.agg(F.max("turn").alias("t")).first()["t"]  # one number
    return F.lit((longest or 0) + 1)


def thread_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as landed thread items: turn t answers turn (t-1) div 2."""
    turns = table(spark, sf_dir, "conversations")
    size = turns.groupBy("conv_id").agg((F.max("turn") + 1).alias("turns"))
    base = F.col("conv_id") * _stride(turns)
    kids = F.filter(
        F.array(F.col("turn") * 2 + 1, F.col("turn") * 2 + 2), lambda t: t < F.col("turns")
    )
    story = F.col("turn") == 0
    return turns.join(size, "conv_id").select(
        (base + F.col("turn")).alias("id"),
        F.to_json(
            F.struct(
                F.when(story, "story").otherwise("comment").alias("type"),
                F.when(story, F.split_part("text", F.lit("\n"), F.lit(1))).alias("title"),
                F.col("role").alias("by"),
                F.col("conv_id").alias("time"),
                F.when(story, F.col("turns") - 1).alias("descendants"),
                F.transform(kids, lambda t: base + t).alias("kids"),
                "text",
            )
        ).alias("payload"),
    )


def thread_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id lists of twenty neighbouring conversations each."""
    turns = table(spark, sf_dir, "conversations")
    roots = turns.where("turn = 0").select("conv_id")
    entry = _text(F.col("conv_id") * _stride(turns))
    return _body(_pages(roots, "stories", "conv_id", FEED_PAGE, entry), "[", ",", "]")


def issues_of_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents wrapped the way an e-mail issue is rendered."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(
            F.lit("Logo\n|  |\nView online  \nHey "), "source", F.lit(",\n\n\n\n"),
            F.replace("text", F.lit(". "), F.lit(".  \n\n\n\n\n| --- | --- | --- | --- | --- |\n")),
            F.lit("\n| one | two |\n|  |  |\n\n\n"),
        ).alias("text"),
    )


# --- references -----------------------------------------------------------------

# The references of RFC 3986, 5.4.
REFERENCES = [
    "g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x",
    "g;x?y#s", "", ".", "./", "..", "../", "../g", "../..", "../../", "../../g", "../../../g",
    "/./g", "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y",
    "g;x=1/../y", "g?y/./x", "g?y/../x", "g#s/./x", "g#s/../x",
]
#: Every named character reference in three surroundings.
NAMED = [f"&{n} &{n.rstrip(';')}z &{n.rstrip(';')}" for n in sorted(html5)]


def named_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with one of the texts, in turn."""
    texts = F.from_json(F.lit(json.dumps(NAMED)), "array<string>")
    return table(spark, sf_dir, "events").select(
        "event_id", F.get(texts, (F.col("event_id") % len(NAMED)).cast("int")).alias("text")
    )


# --- pages made of documents ---------------------------------------------------


def _paragraphs(tag_open: str, tag_close: str) -> Column:
    """Each non-blank line of a document as one element."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    return F.transform(
        lines, lambda x: F.concat(F.lit(tag_open), _escaped(x), F.lit(tag_close))
    )


def document_pages(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    """Documents dressed as fetched pages of one of the known layouts."""
    docs = table(spark, sf_dir, "documents")
    url = F.concat(F.lit("https://pages.example.org/"), _text(F.col("doc_id")))
    if layout == "long":
        parts = [
            F.lit('<main><div class="blog-content prose"><div><a href="/all">All notes</a></div>'),
            F.lit('<div class="not-prose"><p>12 likes</p></div>'),
            F.array_join(_paragraphs("<p>", "</p>\n"), ""),
            F.lit('<div class="SVELTE_HYDRATER">widget</div></div></main>'),
        ]
    elif layout == "newsletter":
        parts = [
            F.lit("<table><tr>"),
            F.array_join(_paragraphs('<td class="a mcnTextContent"><p>', "</p></td>"), ""),
            F.lit('<td class="mcnTextContent"><a href="#">unsubscribe</a></td></tr></table>'),
        ]
    elif layout == "font":
        parts = [
            F.lit('<table><td><font size="2" face="verdana">'),
            F.array_join(_paragraphs("", "<br /><br />"), ""),
            F.lit("</font></td></table>"),
        ]
    elif layout == "mail":
        parts = [
            F.lit("<html><head><title> Issue "), _text(F.col("doc_id")), F.lit("</title></head>"),
            F.lit('<body><p>Logo</p><div style="display:none">preview</div><p>Hey reader,</p>'),
            F.array_join(_paragraphs("<table><tr><td>", "</td></tr></table>"), ""),
            F.lit('<img src="x"></body></html>'),
        ]
    elif layout == "article":
        date = F.concat(F.lit("2025-12-"), F.lpad(_text(F.col("n_chars") % 28 + 1), 2, "0"))
        parts = [
            F.lit('<script type="application/ld+json">{"@graph":[{"a":1},{"datePublished":"'),
            date, F.lit('T10:00:00Z"}]}</script><main><nav>menu</nav><h1> Page  '),
            _text(F.col("doc_id")), F.lit("</h1>"),
            F.array_join(_paragraphs("<p>", "</p>"), ""), F.lit("<footer>end</footer></main>"),
        ]
    else:
        raise ValueError(layout)
    return docs.select("doc_id", url.alias("url"), F.concat(*parts).alias("html"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of twenty cards each; French cards link to a category."""
    docs = table(spark, sf_dir, "documents")
    prefix = F.when(F.col("lang") == "fr", "/blog/category/").otherwise("/blog/")
    card = F.concat(
        F.lit('<article><a href="'), prefix, "source", F.lit('"><h2>About  '), "source",
        F.lit(" "), _text(F.col("doc_id")), F.lit('</h2></a> <a href="/blog/more">more</a></article>'),
    )
    pages = _body(_pages(docs, "listing", "doc_id", FEED_PAGE, card), "<main>", "", "</main>")
    return pages.select(
        "run_id", F.lit("https://list.example.org/blog").alias("url"), F.col("body").alias("html")
    )
