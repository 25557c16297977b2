"""New items, body refreshes and index maintenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.dates import archived_date
from broadsheet.functions.text import body_of, content_path, filled, item_id, looks_like_placeholder
from broadsheet.operators.ranking import first_per_key, last_per_key, top_per_group
from broadsheet.operators.records import with_record_id

URL_KEY = ["source_id", "url"]


def arrival(items: DataFrame) -> list[str]:
    """Columns that spell out the order of arrival.

    Positions restart in each landed document, so the store's version and the
    run that landed it come first where they are known; equal places are told
    apart by what the rows say, never by the partitioning.
    """
    known = ["version", "landed_run", "item_pos", "title", "published_at", "author", "summary"]
    return [c for c in known if c in items.columns]


def latest_by_url(items: DataFrame) -> DataFrame:
    """The last manifest row of each (source, url); rows without url are skipped."""
    return last_per_key(items.where(F.col("url") != ""), URL_KEY, arrival(items))


def known_urls(items: DataFrame) -> DataFrame:
    return items.select(*URL_KEY).where(F.col("url") != "").distinct()


def new_items(incoming: DataFrame, existing: DataFrame, dedup: bool = False) -> DataFrame:
    """Incoming rows whose (source, url) is not stored yet.

    The stored urls are not updated within a batch, so a url that arrives
    twice counts as new twice; ``dedup`` keeps its first row only.
    """
    fresh = incoming.join(known_urls(existing), URL_KEY, "left_anti")
    return first_per_key(fresh, URL_KEY, arrival(fresh)) if dedup else fresh


def as_manifest_rows(items: DataFrame, archived_at: str) -> DataFrame:
    """Manifest rows and bodies of accepted items."""
    key = item_id(F.col("title"), F.col("url"))
    landed = ["landed_run"] if "landed_run" in items.columns else []
    return items.select(
        *landed,
        key.alias("id"),
        "source_id",
        "item_pos",
        "title",
        "url",
        "published_at",
        F.lit(archived_at).alias("archived_at"),
        "author",
        "summary",
        content_path(F.col("source_id"), key).alias("content_path"),
        body_of(F.col("content"), F.col("summary")).alias("body"),
    )


def refresh_candidates(incoming: DataFrame) -> DataFrame:
    """The one body per (source, url) that survives a batch applied in order.

    Each usable body replaces the stored one while that still looks like a
    placeholder: the first sound body ends the sequence, otherwise the last
    placeholder stays. Reduced before the join, so a hot url sends few rows.
    """
    body = body_of(F.col("content"), F.col("summary"))
    places = [c for c in arrival(incoming) if c in ("landed_run", "item_pos")]
    bodies = incoming.select(*URL_KEY, *places, body.alias("body")).where("body != ''")
    sound = ~looks_like_placeholder(F.col("body"))
    order = [F.desc(sound)]
    for place in [*places, "body"]:
        order += [F.asc(F.when(sound, F.col(place))), F.desc(F.when(~sound, F.col(place)))]
    return top_per_group(bodies, URL_KEY, order, 1)


def is_stale(body: Column) -> Column:
    """A stored body that a later one may replace."""
    return (body == "") | looks_like_placeholder(body)


def content_refresh(incoming: DataFrame, existing: DataFrame, contents: DataFrame) -> DataFrame:
    """Stored items whose empty or placeholder body gets a new one.

    ``contents`` is ``(content_path, content)``, or ``(content_path, stale)``
    where the verdict was stored with the body. Only the verdict travels
    through the join, not the body.
    """
    return refreshed(incoming, refresh_targets(existing, contents))


def refresh_targets(existing: DataFrame, contents: DataFrame) -> DataFrame:
    """Stored items with an empty or placeholder body: url key, id and path."""
    order = arrival(existing)
    stored = latest_by_url(existing.select(*URL_KEY, *order, "id", "content_path"))
    verdict = F.col("stale") if "stale" in contents.columns else is_stale(F.col("content"))
    stale = contents.where(verdict).select("content_path")
    return stored.join(stale, "content_path", "left_semi").drop(*order)


def refreshed(incoming: DataFrame, targets: DataFrame) -> DataFrame:
    """The bodies that ``incoming`` brings for the targets."""
    # Stale items are few: only bodies offered for them are compared.
    offered = incoming.join(targets.select(*URL_KEY), URL_KEY, "left_semi")
    return (
        refresh_candidates(offered)
        .join(targets, URL_KEY)
        .select("source_id", F.col("id").alias("item_id"), "url", "content_path", "body")
    )


def needs_page_fetch(incoming: DataFrame, existing: DataFrame, contents: DataFrame) -> DataFrame:
    """Incoming rows whose page is worth fetching, with the reason.

    Unknown url, no path, missing body, empty body or placeholder.
    """
    held = existing.select(*URL_KEY, *arrival(existing), "content_path")
    stored = latest_by_url(held).select(
        *URL_KEY, "content_path", F.lit(True).alias("known")
    )
    verdicts = contents.select(
        "content_path",
        F.when(F.col("content") == "", "empty")
        .when(looks_like_placeholder(F.col("content")), "placeholder")
        .otherwise("ok")
        .alias("verdict"),
    )
    # Rows without a path get a key of their own: NULL keys would pile up.
    key = F.coalesce(filled(F.col("content_path")), F.concat(F.lit("#"), "url"))
    judged = stored.withColumn("key", key).join(
        verdicts.withColumnRenamed("content_path", "key"), "key", "left"
    )
    reason = (
        F.when(F.col("known").isNull(), "unknown")
        .when(F.coalesce("content_path", F.lit("")) == "", "no_path")
        .when(F.col("verdict").isNull(), "missing")
        .when(F.col("verdict") != "ok", F.col("verdict"))
    )
    return (
        incoming.join(judged, URL_KEY, "left")
        .select(*incoming.columns, reason.alias("reason"))
        .where("reason is not null")
    )


def snapshot_overwrite(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored snapshots with each (source, day) of the batch replaced whole."""
    day = ["source_id", "snapshot_date"]
    kept = stored.join(incoming.select(*day).distinct(), day, "left_anti")
    return kept.unionByName(incoming)


def index_rows(records: DataFrame) -> DataFrame:
    """Records as the index keeps them: one row per record id, the last one."""
    keyed = with_record_id(records).withColumn("archived_date", archived_date(F.col("archived_at")))
    return last_per_key(keyed, ["record_id"], ["source_pos", "item_pos"])


def index_upsert(index: DataFrame, records: DataFrame, replace_days: bool = False) -> DataFrame:
    """Index after inserting ``records``; on equal ids the new row wins.

    ``replace_days`` also drops what an earlier run of the same day indexed
    for a ranked source, so that the index agrees with the tables.
    """
    arriving = index_rows(records)
    kept = index.join(arriving.select("record_id"), "record_id", "left_anti")
    if replace_days:
        day = ["source_id", "snapshot_date"]
        kept = kept.join(records.select(*day).dropna().distinct(), day, "left_anti")
    return kept.unionByName(arriving)
