"""One run: landed payloads to stored items, snapshots and a run report."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.text import strip
from broadsheet.operators import threads
from broadsheet.operators.merge import needs_page_fetch
from broadsheet.operators.records import archive_records, snapshot_records
from broadsheet.operators.report import run_report
from broadsheet.schemas import ARCHIVE_ITEM, RANKED_ITEM
from broadsheet.sources import feeds, pages, ranked
from broadsheet.sources.registry import item_limit
from broadsheet.sources.store import Store

Flattener = Callable[..., DataFrame]

# Ranked sources by the shape of their payload; how many entries count is the
# limit of their source.
RANKED_SHAPES: dict[str, Flattener] = {
    "lobsters": ranked.link_list_items,
    "releasebot": ranked.release_items,
    "hf-papers": ranked.paper_items,
    "github-trending": ranked.repo_items,
    "product-hunt": feeds.ranked_feed_items,
    "skills-sh-trending": ranked.embedded_list_items,
    "skills-sh-hot": partial(ranked.embedded_list_items, with_change=True),
}
# Archive sources whose payload is not a plain feed.
ARCHIVE_SHAPES: dict[str, Flattener] = {
    "founders-fund-anatomy": ranked.cms_items,
    "mailchimp-archive": lambda raw: feeds.feed_items(raw, normalizer=pages.newsletter_markdown),
    "paul-graham": lambda raw: feeds.feed_items(raw, item_limit("paul-graham")),
    "vercel-blog": lambda raw: feeds.feed_items(raw, item_limit("vercel-blog")),
}
# Listing sources: page rule, link prefix kept, link prefix dropped, containers.
LISTINGS = {
    "claude-blog": (pages.card_links, "/blog/", "/blog/category/", ("main", "article")),
    "openai-dev-blog": (pages.page_links, "/blog/", "/blog/topic", ("article", "main")),
}
# Feeds whose blank bodies are filled from article pages: body rule, first n.
PAGE_BODIES = {"paul-graham": (pages.font_container_markdown, 5)}
LONG_BODY_SOURCE = "hf-blog"
EMAIL_SOURCE = "alphasignal-last-email"
EMAIL_URL = "https://alphasignal.ai/last-email"
EMAIL_TITLE = "AlphaSignal Last Email"
STORY_SOURCE = "hn"
# Why a landed document gave no item.
EMPTY_PAYLOAD = "empty payload"
UNKNOWN_PAYLOAD = "payload is neither markup nor JSON"
BROKEN_PAYLOAD = "payload is broken or of another shape"


def _shaped(df: DataFrame, schema) -> DataFrame:
    """Bring a flattener's columns to the full schema."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _of(raw: DataFrame, source_id: str) -> DataFrame:
    return raw.where(F.col("source_id") == source_id)


def ranked_items(raw: DataFrame, raw_items: DataFrame | None = None) -> DataFrame:
    """Items of every ranked source in one plan; ``raw_items`` holds thread nodes."""
    parts = [
        _shaped(flatten(_of(raw, source_id), limit=item_limit(source_id)), RANKED_ITEM)
        for source_id, flatten in RANKED_SHAPES.items()
    ]
    if raw_items is not None:
        stories = threads.story_items(
            _of(raw, STORY_SOURCE), raw_items, seed_limit=item_limit(STORY_SOURCE)
        )
        parts.append(_shaped(stories, RANKED_ITEM))
    return _union(parts)


def listing_items(raw_pages: DataFrame) -> DataFrame:
    """Items of listing sources from fetched pages ``(source_id, run_id, url, html,
    listing BOOLEAN)``: links of the listing joined to the article pages."""
    parts = []
    for source_id, (links_of, keep, drop, containers) in LISTINGS.items():
        page = ["source_id", "run_id", "url"]
        own = pages.last_pages(_of(raw_pages, source_id), [*page, "listing"])
        links = links_of(
            own.where("listing").select(*page, "html"), keep, drop, item_limit(source_id)
        )
        listed = F.col("title") if "title" in links.columns else F.lit(None).cast("string")
        links = links.select(
            "source_id", "run_id", F.col("link_pos").alias("item_pos"), F.col("link").alias("url"),
            listed.alias("listed_title"),
        )
        joined = links.join(own.where("not listing").select(*page, "html"), page)
        found = pages.page_articles(joined, containers, F.col("listed_title"))
        parts.append(_shaped(found, ARCHIVE_ITEM))
    return _union(parts)


def email_items(raw: DataFrame, issue_date: str) -> DataFrame:
    """One item per run from the landed e-mail page."""
    html = F.col("body")
    return _of(raw, EMAIL_SOURCE).select(
        "source_id",
        "run_id",
        F.lit(0).alias("item_pos"),
        F.coalesce(pages.email_title(html), F.lit(EMAIL_TITLE)).alias("title"),
        F.lit(f"{EMAIL_URL}?issue={issue_date}").alias("url"),
        F.lit(issue_date).alias("published_at"),
        pages.email_markdown(html).alias("content"),
    )


def archive_items(
    raw: DataFrame, issue_date: str, raw_pages: DataFrame | None = None
) -> DataFrame:
    """Items of every archive source in one plan.

    A source without a rule of its own is read as a feed.
    """
    special = [
        *ARCHIVE_SHAPES, *RANKED_SHAPES, *LISTINGS, STORY_SOURCE, EMAIL_SOURCE, LONG_BODY_SOURCE,
    ]
    plain = raw.where(~F.col("source_id").isin(special))
    parts = [_shaped(feeds.feed_items(plain), ARCHIVE_ITEM)]
    for source_id, flatten in ARCHIVE_SHAPES.items():
        items = _shaped(flatten(_of(raw, source_id)), ARCHIVE_ITEM)
        if raw_pages is not None and source_id in PAGE_BODIES:
            rule, first_n = PAGE_BODIES[source_id]
            fetched = _of(raw_pages, source_id)
            items = pages.with_page_body(items, fetched, rule(F.col("html")), first_n)
        parts.append(items)
    long = _shaped(feeds.feed_items(_of(raw, LONG_BODY_SOURCE)), ARCHIVE_ITEM)
    if raw_pages is not None:
        # Pages are landed for the urls that need one; what was landed counts.
        fetched = _of(raw_pages, LONG_BODY_SOURCE)
        body = pages.long_body_markdown(F.col("html"))
        long = pages.with_page_body(long, fetched, body, only_blank=False)
    parts.append(long)
    parts.append(_shaped(email_items(raw, issue_date), ARCHIVE_ITEM))
    if raw_pages is not None:
        parts.append(listing_items(raw_pages))
    return _union(parts)


def quarantine(raw: DataFrame, items: DataFrame) -> DataFrame:
    """Landed documents that gave no item, with the reason as ``error``."""
    key = ["source_id", "run_id"]
    body = strip(F.coalesce("body", F.lit("")))
    reason = (
        F.when(body == "", EMPTY_PAYLOAD)
        .when(~F.substring(body, 1, 1).isin("<", "{", "["), UNKNOWN_PAYLOAD)
        .otherwise(BROKEN_PAYLOAD)
    )
    lost = raw.join(items.select(*key).distinct(), key, "left_anti")
    return lost.withColumn("error", reason)


def pages_to_fetch(store: Store, raw: DataFrame) -> DataFrame:
    """Urls of the long-body feed whose page should be landed before the run."""
    items = feeds.feed_items(_of(raw, LONG_BODY_SOURCE)).select("source_id", "url", "item_pos")
    return needs_page_fetch(items, store.items(), store.contents())


def ingest(
    store: Store,
    sources: DataFrame,
    archive: DataFrame,
    ranked_rows: DataFrame,
    run_id: str,
    run_ts: str,
    parity: bool = False,
    errors: DataFrame | None = None,
) -> DataFrame:
    """Store one run's items and return its report.

    ``errors`` are the documents of ``quarantine``; the report tells their reason.

    ``run_ts`` is the run's UTC time, ``YYYY-MM-DDTHH:MM:SSZ``; nothing in a
    run depends on the clock of the machine. Ranked rows go to the snapshot of
    that day, or of the day of their own ``taken_at`` if they bring one. Sources
    that are not in ``sources`` or disabled are left out. Nothing of the run is
    seen before its commit, which comes last.
    """
    active = sources.where("enabled")
    known = active.select("source_id")
    if "taken_at" not in ranked_rows.columns:
        ranked_rows = ranked_rows.withColumn("taken_at", F.lit(run_ts))
    attempt = store.begin(run_id)
    archive, ranked_rows = attempt.stage(
        archive.join(known, "source_id", "left_semi"),
        ranked_rows.join(known, "source_id", "left_semi"),
    )
    landed = archive.withColumnRenamed("run_id", "landed_run")
    stored = attempt.add_items(landed, run_ts, parity)
    attempt.refresh_contents(landed)
    attempt.write_snapshots(ranked_rows)
    fetched = archive.select("source_id").unionByName(ranked_rows.select("source_id"))
    report = run_report(active, fetched, stored, errors)
    attempt.record_run(report, run_ts, run_ts)
    build = store.at(attempt.head).index_build()
    if build is not None:
        attempt.upsert_index(active)
    earlier = store.at(attempt.head).valid().where(F.col("run_id") == run_id).first()
    version = attempt.commit()
    if build is not None and earlier is not None and earlier["version"] <= build["base"]:
        # The build holds rows of the attempt that this one replaces.
        store.rebuild_index(active)
    return store.at(version).runs().where(F.col("run_id") == run_id)
