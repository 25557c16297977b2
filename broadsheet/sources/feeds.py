"""RSS and Atom feeds, one landed document per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.markup import to_markdown
from broadsheet.functions.text import filled, strip

# The feed elements that are read (RSS 2.0, RSS 1.0, Atom).
_RSS_ITEM = """array<struct<
    title string, link array<string>, guid struct<_VALUE string, _isPermaLink string>,
    pubDate string, `dc:date` string, author string, `dc:creator` string,
    description string, `content:encoded` string>>"""
_ATOM_ENTRY = """array<struct<
    title string, link array<struct<_href string, _rel string>>,
    published string, updated string, author array<struct<name string>>,
    summary string, content string>>"""
FEED_SCHEMA = (
    f"channel struct<item {_RSS_ITEM}>, item {_RSS_ITEM}, entry {_ATOM_ENTRY}, broken string"
)
FEED_OPTIONS = {"columnNameOfCorruptRecord": "broken", "mode": "PERMISSIVE"}


def _value(col: Column) -> Column:
    return filled(strip(col))


def _rss_entry(item: Column) -> Column:
    permalink = F.when(
        F.coalesce(item["guid"]["_isPermaLink"], F.lit("true")) != "false", item["guid"]["_VALUE"]
    )
    link = F.get(F.filter(item["link"], lambda x: F.length(strip(x)) > 0), F.lit(0))
    return F.struct(
        _value(item["title"]).alias("title"),
        F.coalesce(_value(link), _value(permalink)).alias("url"),
        F.coalesce(_value(item["pubDate"]), _value(item["dc:date"])).alias("published_at"),
        F.coalesce(_value(item["author"]), _value(item["dc:creator"])).alias("author"),
        _value(item["description"]).alias("summary"),
        _value(item["content:encoded"]).alias("full"),
    )


def _atom_entry(entry: Column) -> Column:
    alternates = F.filter(
        entry["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"
    )
    return F.struct(
        _value(entry["title"]).alias("title"),
        _value(F.get(alternates, F.lit(0))["_href"]).alias("url"),
        F.coalesce(_value(entry["published"]), _value(entry["updated"])).alias("published_at"),
        _value(F.get(entry["author"], F.lit(0))["name"]).alias("author"),
        _value(entry["summary"]).alias("summary"),
        _value(entry["content"]).alias("full"),
    )


def feed_entries(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Entries of each feed with their position, before any validity check.

    A document the XML parser rejects contributes nothing at all.
    """
    feed = F.from_xml(F.col("body"), FEED_SCHEMA, FEED_OPTIONS)
    entries = F.concat(
        F.transform(F.coalesce(F.col("feed.channel.item"), F.array()), _rss_entry),
        F.transform(F.coalesce(F.col("feed.item"), F.array()), _rss_entry),
        F.transform(F.coalesce(F.col("feed.entry"), F.array()), _atom_entry),
    )
    if limit is not None:
        entries = F.slice(entries, 1, limit)
    # Inside the generator, so that no filter makes Spark parse a body twice.
    whole = F.when(F.col("feed.broken").isNull(), entries)
    return raw.select("source_id", "run_id", feed.alias("feed")).select(
        "source_id", "run_id", F.posexplode(whole).alias("item_pos", "entry")
    )


def feed_items(
    raw: DataFrame,
    limit: int | None = None,
    normalizer: Callable[[Column], Column] = to_markdown,
) -> DataFrame:
    """Archive items of landed feeds; the limit counts skipped entries too."""
    full, summary = F.col("entry.full"), F.col("entry.summary")
    html = F.coalesce(full, summary)
    return (
        feed_entries(raw, limit)
        .where("entry.title is not null and entry.url is not null")
        .select(
            "source_id",
            "run_id",
            F.col("item_pos").cast("bigint").alias("item_pos"),
            "entry.title",
            "entry.url",
            "entry.published_at",
            "entry.author",
            F.coalesce(summary, full).alias("summary"),
            F.coalesce(normalizer(html), F.lit("")).alias("content"),
        )
    )


def ranked_feed_items(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """A feed read as a ranking: the position in the feed is the rank."""
    return (
        feed_entries(raw, limit)
        .where("entry.title is not null and entry.url is not null")
        .select(
            "source_id",
            "run_id",
            F.col("item_pos").cast("bigint").alias("item_pos"),
            "entry.title",
            "entry.url",
            "entry.published_at",
            (F.col("item_pos") + 1).alias("rank"),
        )
    )
