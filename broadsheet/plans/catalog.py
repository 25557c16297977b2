"""Every registered query, run over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions import markup
from broadsheet.functions.dates import epoch_to_iso
from broadsheet.functions.lines import cap_blank_runs, clean_lines
from broadsheet.functions.text import (
    body_of,
    content_path,
    item_id,
    looks_like_placeholder,
    strip,
)
from broadsheet.operators import audit, history, merge, query, ranking, records, report, threads
from broadsheet.plans import ingest
from broadsheet.plans import tables as t
from broadsheet.schemas import RANKED_ITEM, RECORD_FIELDS
from broadsheet.session import configure, ensure_checkpoint_dir
from broadsheet.sources import feeds, pages, ranked, registry
from broadsheet.sources.store import Store
from broadsheet.streaming import seen

Query = Callable[[SparkSession, str], DataFrame]

TERM = "THE"
ON_DAY = "2026-01-10"
FIRST_DAY, LAST_DAY = "2024-01-20", "2026-01-07"
ONE_SOURCE = "src3"
TOP = 37
RUN_DATE = date(2026, 1, 29)
RERUN_FROM = "2024-01-16"

REGISTRY: dict[str, Query] = {}


def registered(fn: Query) -> Query:
    """Register a query under its own name; runs with the session settings."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    REGISTRY[fn.__name__] = run
    return fn


def _as_text(name: str):
    """The map as JSON, numbers that may be missing as digits."""
    if name == "extra":
        return F.to_json(name).alias(name)
    if name in ("rank", "comments_count", "score"):
        return F.col(name).cast("string").alias(name)
    return F.col(name)


def shown(df: DataFrame) -> DataFrame:
    """Record fields as answered."""
    return df.select(*[_as_text(c) for c in RECORD_FIELDS])


def flat(df: DataFrame) -> DataFrame:
    """Ranked items without their comments."""
    names = [
        "run_id", "item_pos", "title", "url", "published_at", "author", "score",
        "comments_count", "rank", "discussion_url", "extra",
    ]
    return df.select(*[_as_text(c) for c in names])


def _all(spark: SparkSession, sf_dir: str, dimension: DataFrame | None = None) -> DataFrame:
    """Records of both kinds over one source dimension."""
    dimension = t.dimension(spark, sf_dir) if dimension is None else dimension
    posts = t.posts(spark, sf_dir).withColumn("id", item_id(F.col("title"), F.col("url")))
    path = content_path(F.col("source_id"), F.col("id"))
    return records.records_union(
        records.archive_records(posts.withColumn("content_path", path), dimension),
        records.snapshot_records(t.snapshots(spark, sf_dir), dimension),
    )


# --- records and queries ------------------------------------------------------


@registered
def by_keyword(spark, sf_dir):
    return shown(query.by_keyword(_all(spark, sf_dir), TERM))


@registered
def sources(spark, sf_dir):
    return registry.source_listing(t.dimension(spark, sf_dir).where("enabled"))


@registered
def records_union(spark, sf_dir):
    return shown(_all(spark, sf_dir))


@registered
def snapshot_records(spark, sf_dir):
    entries = records.explode_snapshots(t.landed_snapshots(spark, sf_dir))
    rows = records.snapshot_records(entries, t.dimension(spark, sf_dir))
    return rows.select(
        "source_id", "source_name", "kind", "title", "url", "archived_at", "snapshot_date",
        "published_at", "author", "rank", "comments_count", "score",
        F.to_json("extra").alias("extra"),
        F.col("item_pos").cast("bigint").alias("item_pos"),
    )


@registered
def by_source(spark, sf_dir):
    return shown(query.by_source(_all(spark, sf_dir), ONE_SOURCE))


@registered
def by_source_limit(spark, sf_dir):
    return shown(query.by_source(_all(spark, sf_dir), "click", limit=TOP))


@registered
def by_keyword_source(spark, sf_dir):
    return shown(query.by_keyword(_all(spark, sf_dir), TERM, [ONE_SOURCE, "error"]))


@registered
def by_keyword_limit(spark, sf_dir):
    return shown(query.by_keyword(_all(spark, sf_dir), TERM, limit=TOP))


@registered
def archive_on(spark, sf_dir):
    return shown(query.by_archive_date(_all(spark, sf_dir), on=ON_DAY))


@registered
def archive_range(spark, sf_dir):
    return shown(query.by_archive_date(_all(spark, sf_dir), start=FIRST_DAY, end=LAST_DAY))


def _stored_records(spark: SparkSession, sf_dir: str, store: DataFrame) -> DataFrame:
    return records.archive_records(store, t.dimension(spark, sf_dir))


@registered
def has_content(spark, sf_dir):
    store = t.store(spark, sf_dir)
    flagged = records.with_has_content(_stored_records(spark, sf_dir, store), t.contents(store))
    return flagged.select("source_id", "item_pos", "content_path", "has_content")


@registered
def read_content(spark, sf_dir):
    return records.read_content(t.contents(t.store(spark, sf_dir)), ONE_SOURCE)


@registered
def record_lines(spark, sf_dir):
    store = t.store(spark, sf_dir)
    flagged = records.with_has_content(_stored_records(spark, sf_dir, store), t.contents(store))
    names = [*RECORD_FIELDS, "has_content"]
    fields = [F.get_json_object("json", f"$.{c}").alias(f"json_{c}") for c in names]
    return records.record_lines(flagged).select("source_id", "item_pos", "line", *fields)


# --- identity ------------------------------------------------------------------


@registered
def item_ids(spark, sf_dir):
    return t.posts(spark, sf_dir).select(
        "item_pos", item_id(F.col("title"), F.col("url")).alias("item_id")
    )


@registered
def record_ids(spark, sf_dir):
    keyed = records.with_record_id(_all(spark, sf_dir))
    return keyed.select("source_id", "item_pos", "record_id")


@registered
def first_content(spark, sf_dir):
    store = t.store(spark, sf_dir)
    body = body_of(F.col("body"), F.col("summary"))
    return store.select("item_pos", body.alias("body"))


@registered
def latest_by_url(spark, sf_dir):
    store = t.archived(t.store(spark, sf_dir))
    return merge.latest_by_url(store).select("source_id", "url", "item_pos", "id")


@registered
def valid_items(spark, sf_dir):
    k = F.col("comments_count")
    faulty = t.snapshots(spark, sf_dir).withColumns(
        {
            "title": F.when(k >= 5, F.col("title")).when(k > 2, ""),
            "url": F.when(k.between(5, 9), "").otherwise(F.col("url")),
        }
    )
    return ranked.valid_items(faulty).select("source_id", "item_pos", "title", "url")


@registered
def epoch_iso(spark, sf_dir):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return t.table(spark, sf_dir, "events").select("event_id", epoch_to_iso(seconds).alias("iso"))


# --- store ---------------------------------------------------------------------


@registered
def new_items(spark, sf_dir):
    existing = t.archived(t.store(spark, sf_dir))
    fresh = merge.new_items(t.posts(spark, sf_dir), existing, dedup=True)
    return fresh.select("source_id", "url", "item_pos", "title")


@registered
def new_items_parity(spark, sf_dir):
    existing = t.archived(t.store(spark, sf_dir))
    fresh = merge.new_items(t.posts(spark, sf_dir), existing)
    rows = merge.as_manifest_rows(fresh, "2026-02-01T00:00:00Z")
    return rows.select(
        "id", "source_id", "item_pos", "title", "url", "published_at", "archived_at", "author",
        "summary", "content_path",
    )


@registered
def content_refresh(spark, sf_dir):
    existing = t.archived(t.store(spark, sf_dir))
    return merge.content_refresh(t.posts(spark, sf_dir), existing, t.contents(existing))


@registered
def needs_page_fetch(spark, sf_dir):
    existing = t.archived(t.store(spark, sf_dir))
    incoming = t.posts(spark, sf_dir).select("source_id", "url", "item_pos")
    return merge.needs_page_fetch(incoming, existing, t.contents(existing))


def _snapshot_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "source_id", "snapshot_date", "item_pos", "title", "url", "score", "comments_count"
    )


def _rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run for the later days, in which half of the entries are gone."""
    again = t.snapshots(spark, sf_dir).where(
        (F.col("snapshot_date") >= RERUN_FROM) & (F.col("comments_count") < 50)
    )
    return again.withColumn("score", F.col("score") + 1)


@registered
def snapshot_overwrite(spark, sf_dir):
    stored = _snapshot_columns(t.snapshots(spark, sf_dir))
    return merge.snapshot_overwrite(stored, _snapshot_columns(_rerun(spark, sf_dir)))


_stores: dict[tuple[str, str], Store] = {}


def _stored_runs(spark: SparkSession, sf_dir: str) -> Store:
    """The store of two runs over the given tables, made once a session while its files last."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores or not _stores[key].head():
        _stores[key] = _two_runs(spark, sf_dir)
    return _stores[key]


def _two_runs(spark: SparkSession, sf_dir: str) -> Store:
    """A store after a run, a build of its index, and a run that brings new and better items.

    The second run takes the later days again and comes too late for the others.
    """
    ensure_checkpoint_dir(spark)
    store = Store.open(spark, f"{spark.sparkContext.getCheckpointDir()}/store-{uuid.uuid4().hex}")
    dimension = t.dimension(spark, sf_dir)
    none = F.lit(None).cast("string")

    def archive(df: DataFrame, run: str, summary, content: str) -> DataFrame:
        return df.select(
            "source_id", F.lit(run).alias("run_id"), "item_pos", "title", "url", "published_at",
            "author", summary.alias("summary"), F.col(content).alias("content"),
        )

    def taken(df: DataFrame, run: str, clock) -> DataFrame:
        stamp = F.concat("snapshot_date", clock).alias("taken_at")
        shaped = df.withColumns({"run_id": F.lit(run), "discussion_url": none})
        comments = F.array().cast(RANKED_ITEM["comments"].dataType)
        return shaped.withColumn("comments", comments).select(*RANKED_ITEM.names, stamp)

    late = F.when(F.col("snapshot_date") >= RERUN_FROM, "T05:00:00Z").otherwise("T00:30:00Z")
    first = t.archived(t.store(spark, sf_dir))
    ingest.ingest(
        store, dimension, archive(first, "run-1", none, "body"),
        taken(t.snapshots(spark, sf_dir), "run-1", F.lit("T01:00:00Z")), "run-1", "2026-02-01T00:00:00Z",
    )
    store.rebuild_index(dimension.where("enabled"))
    again = _rerun(spark, sf_dir).unionByName(
        t.snapshots(spark, sf_dir).where(F.col("snapshot_date") < RERUN_FROM)
    )
    ingest.ingest(
        store, dimension, archive(t.posts(spark, sf_dir), "run-2", F.col("summary"), "content"),
        taken(again, "run-2", late), "run-2", "2026-02-02T00:00:00Z",
    )
    return store


@registered
def store_items(spark, sf_dir):
    return _stored_runs(spark, sf_dir).items().select(
        "source_id", "url", "id", "title", "item_pos", "run_id", "archived_at", "version"
    )


def _body_hash():
    return F.sha1("content").alias("content_hash")


@registered
def store_bodies(spark, sf_dir):
    return _stored_runs(spark, sf_dir).contents(_body_hash()).select(
        "source_id", "item_id", "content_path", "content_hash", "stale", "run_id", "version"
    )


@registered
def store_snapshots(spark, sf_dir):
    return _snapshot_columns(_stored_runs(spark, sf_dir).snapshots())


@registered
def store_index(spark, sf_dir):
    index = _stored_runs(spark, sf_dir).index()
    return index.select("record_id", "source_id", "archived_at", "url", _as_text("score"), "item_pos")


@registered
def store_earlier(spark, sf_dir):
    """The bodies as they were before the second run."""
    return _stored_runs(spark, sf_dir).at(2).contents(_body_hash()).select(
        "source_id", "content_path", "content_hash", "stale"
    )


def _index_columns(df: DataFrame) -> DataFrame:
    day = F.date_format("archived_date", "yyyy-MM-dd").alias("archived_date")
    return df.select(
        "record_id", "source_id", "archived_at", day, "title", "url", _as_text("score"), "item_pos"
    )


def _enabled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all(spark, sf_dir, t.dimension(spark, sf_dir).where("enabled"))


@registered
def index_rebuild(spark, sf_dir):
    return _index_columns(merge.index_rows(_enabled_records(spark, sf_dir)))


@registered
def index_upsert(spark, sf_dir):
    index = merge.index_rows(_enabled_records(spark, sf_dir))
    again = records.snapshot_records(_rerun(spark, sf_dir), t.dimension(spark, sf_dir))
    return _index_columns(merge.index_upsert(index, again))


@registered
def run_report(spark, sf_dir):
    posts = t.posts(spark, sf_dir).select("source_id", "url", "item_pos")
    fetched = posts.select("source_id").unionByName(t.snapshots(spark, sf_dir).select("source_id"))
    stored = merge.new_items(posts, t.archived(t.store(spark, sf_dir)))
    landed = t.idle_payloads(spark, sf_dir)
    lost = ingest.quarantine(landed, feeds.feed_items(landed))
    enabled = t.dimension(spark, sf_dir).where("enabled")
    run = report.run_report(enabled, fetched, stored, lost)
    counts = [F.col(c).cast("string").alias(c) for c in ("fetched", "stored")]
    return run.select("source_id", "status", *counts, "error")


@registered
def decoded_extras(spark, sf_dir):
    """Extras written as JSON text and read again."""
    rows = t.snapshots(spark, sf_dir).select(
        "source_id", "item_pos", records.encoded_extra(F.col("extra")).alias("text")
    )
    back = records.decoded_extra(F.col("text"))
    return rows.select("source_id", "item_pos", "text", back["k"].alias("k"), F.size(back).cast("bigint").alias("n"))


# --- history ---------------------------------------------------------------------


def _stamp(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


@registered
def first_last_seen(spark, sf_dir):
    """Two periods, seen apart and merged."""
    seen = t.sightings(spark, sf_dir)
    early = F.col("seen_at") < F.lit(f"{RERUN_FROM} 00:00:00").cast("timestamp_ntz")
    both = history.merge_seen(
        history.first_last_seen(seen.where(early)), history.first_last_seen(seen.where(~early))
    )
    return both.select("source_id", "url", _stamp("first_seen"), _stamp("last_seen"), "times_seen")


@registered
def streamed_first_last_seen(spark, sf_dir):
    """The same from a stream of the events, read in one go."""
    ensure_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/seen-{uuid.uuid4().hex}"
    events = spark.readStream.schema(t.SCHEMAS["events"]).parquet(f"{sf_dir}/events.parquet*")
    looks = t.as_sightings(events).withColumn("seen_at", F.col("seen_at").cast("timestamp"))
    told = seen.seen_stream(looks, "1 day", 30 * 86_400_000)
    provider = "spark.sql.streaming.stateStore.providerClass"
    kept = spark.conf.get(provider)
    spark.conf.set(provider, seen.STATE_STORE)
    try:
        (
            told.writeStream.option("checkpointLocation", f"{base}/state")
            .trigger(availableNow=True)
            .outputMode("update")
            .foreachBatch(lambda df, _: df.write.mode("append").parquet(f"{base}/rows"))
            .start()
            .awaitTermination()
        )
    finally:
        spark.conf.set(provider, kept)
    table = seen.seen_table(spark.read.schema(seen.ROWS).parquet(f"{base}/rows"))
    return table.select("source_id", "url", _stamp("first_seen"), _stamp("last_seen"), "times_seen")


@registered
def content_versions(spark, sf_dir):
    versions = history.content_versions(t.sightings(spark, sf_dir))
    return versions.select(
        "source_id", "url", "version_no", "content_hash", _stamp("first_seen"), _stamp("last_seen"),
        "times_seen",
    )


@registered
def content_as_of(spark, sf_dir):
    """What each page showed at the start of each day on which any page was seen."""
    seen = t.sightings(spark, sf_dir)
    ahead = F.explode(F.array(F.lit(-1), F.lit(1), F.lit(3)))
    asked = seen.select("source_id", "url", F.date_trunc("day", "seen_at").alias("day"), ahead.alias("k"))
    at = F.date_add(F.col("day").cast("date"), F.col("k")).cast("timestamp_ntz")
    found = history.as_of(history.content_versions(seen), asked.select("source_id", "url", at.alias("at")))
    return found.select("source_id", "url", _stamp("at"), "version_no", "content_hash", _stamp("since"))


@registered
def content_latest(spark, sf_dir):
    found = history.latest(history.content_versions(t.sightings(spark, sf_dir)))
    return found.select("source_id", "url", "version_no", "content_hash", _stamp("last_seen"))


@registered
def content_updates(spark, sf_dir):
    """Each day is a run of all sources."""
    seen = t.sightings(spark, sf_dir)
    runs = seen.select("source_id", F.date_trunc("day", "seen_at").cast("timestamp_ntz").alias("started_at"))
    found = history.updates(history.content_versions(seen), runs)
    return found.select(
        "source_id", "url", "version_no", "status", "content_hash", "previous_hash", _stamp("first_seen")
    )


# --- ranking and threads ---------------------------------------------------------


@registered
def positional_rank(spark, sf_dir):
    k = F.col("comments_count")
    entries = t.snapshots(spark, sf_dir).select(
        "source_id",
        (F.col("item_pos") - F.col("rank") + 1).alias("first_event"),
        (F.col("rank") - 1).alias("item_pos"),
        F.when(k >= 5, F.col("title")).otherwise("").alias("title"),
        "url",
    )
    return ranking.positional_rank(entries, t.dimension(spark, sf_dir)).select(
        "source_id", "first_event", "rank", "title", "url"
    )


@registered
def hot_stories(spark, sf_dir):
    day = F.date_format("ts", "yyyy-MM-dd")
    stories = t.table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("source_id"),
        day.alias("snapshot_date"),
        F.col("user_id").alias("seed_pos"),
    ).agg(
        F.count(F.lit(1)).alias("comments_count"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("score"),
    )
    return ranking.hot_stories(stories, ["source_id", "snapshot_date"])


@registered
def recent_top_n(spark, sf_dir):
    repos = t.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("item_pos"),
        F.col("n_chars").alias("score"),
        F.concat(
            F.lit("2026-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")
        ).alias("created"),
    )
    return ranking.recent_top_n(repos, RUN_DATE)


@registered
def thread_bfs(spark, sf_dir):
    nodes = threads.parse_nodes(t.thread_items(spark, sf_dir))
    stories = nodes.where("type = 'story'").select(F.col("node_id").alias("story_id"), "kids")
    return threads.thread_comments(stories, nodes)


@registered
def story_items(spark, sf_dir):
    items = threads.story_items(t.thread_seeds(spark, sf_dir), t.thread_items(spark, sf_dir))
    said = F.transform("comments", lambda c: F.concat(c["author"], F.lit(": "), c["text"]))
    return items.select(
        "run_id", "title", "url", "published_at", "author", "comments_count", "rank",
        "discussion_url", F.array_join(said, "\n").alias("comments"),
    )


@registered
def events_daily_snapshot(spark, sf_dir):
    return ranking.daily_counts(t.table(spark, sf_dir, "events"), "event_type", "ts")


# --- audit -----------------------------------------------------------------------


@registered
def placeholder_docs(spark, sf_dir):
    store = t.store(spark, sf_dir)
    return store.where(looks_like_placeholder(strip(F.col("body")))).select("item_pos", "source_id")


def _store_audit(spark: SparkSession, sf_dir: str, snippets: bool = False) -> DataFrame:
    store = t.store(spark, sf_dir)
    return audit.audit(
        manifest_files=t.manifest_files(store),
        contents=t.contents(t.damaged_bodies(store)),
        metas=t.metas(store),
        snapshot_files=t.snapshot_files(spark, sf_dir),
        include_snippets=snippets,
    )


@registered
def audit_issues(spark, sf_dir):
    issues = audit.issues(_store_audit(spark, sf_dir, snippets=True))
    return issues.where("kind = 'blog'").select(*audit.ISSUE_COLUMNS)


@registered
def audit_snapshots(spark, sf_dir):
    issues = audit.issues(audit.snapshot_rows(t.snapshot_files(spark, sf_dir)))
    return issues.select("source_id", "kind", "issue_type", "path", "seq_pos")


@registered
def audit_layout(spark, sf_dir):
    """Folders of no known layout, and a store without any."""
    both = audit.layout_rows(t.layout(spark, sf_dir)).unionByName(audit.missing_root(spark, "none/sources"))
    return audit.issues(both).select("source_id", "kind", "issue_type", "path")


@registered
def audit_by_type(spark, sf_dir):
    return audit.counts_by_type(_store_audit(spark, sf_dir))


@registered
def audit_by_source(spark, sf_dir):
    entries = F.transform(
        F.array_sort(F.map_entries("issues")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return audit.counts_by_source(_store_audit(spark, sf_dir)).select(
        "source_id", "kind", "items_checked", "issues_total",
        F.array_join(entries, ", ").alias("issues"),
    )


@registered
def audit_items_checked(spark, sf_dir):
    """What was checked does not depend on bodies and side files."""
    frame = audit.audit(
        manifest_files=t.manifest_files(t.store(spark, sf_dir)),
        snapshot_files=t.snapshot_files(spark, sf_dir),
    )
    return audit.items_checked(frame).select("source_id", "kind", "items_checked")


@registered
def audit_totals(spark, sf_dir):
    return audit.totals(_store_audit(spark, sf_dir))


@registered
def audit_cube(spark, sf_dir):
    return audit.count_cube(_store_audit(spark, sf_dir)).select(
        "source_id", "issue_type", F.col("level").cast("bigint").alias("level"), "issues"
    )


@registered
def audit_examples(spark, sf_dir):
    found = audit.examples(_store_audit(spark, sf_dir))
    return found.select("source_id", "issue_type", "item_id", "path", "detail")


@registered
def audit_example_lines(spark, sf_dir):
    return audit.example_lines(_store_audit(spark, sf_dir))


@registered
def audit_source_lines(spark, sf_dir):
    return audit.source_lines(audit.counts_by_source(_store_audit(spark, sf_dir)))


# --- pages and lines -----------------------------------------------------------


@registered
def page_links(spark, sf_dir):
    links = pages.page_links(t.table(spark, sf_dir, "pages"), "/", "/the")
    return links.select("page_id", "link_pos", "link")


@registered
def page_articles(spark, sf_dir):
    found = pages.page_articles(t.table(spark, sf_dir, "pages"))
    return found.select("page_id", "title", "url", "published_at", "content")


@registered
def page_text(spark, sf_dir):
    return pages.page_text(t.table(spark, sf_dir, "pages")).select("page_id", "text")


@registered
def page_blocks(spark, sf_dir):
    blocks = pages.page_blocks(t.table(spark, sf_dir, "pages"))
    return blocks.select("page_id", "block_pos", "block")


@registered
def named_references(spark, sf_dir):
    texts = t.named_texts(spark, sf_dir)
    return texts.select("event_id", markup.decode_entities(F.col("text")).alias("text"))


@registered
def resolved_references(spark, sf_dir):
    """Each reference as a link on each page."""
    refs = F.explode(F.array(*map(F.lit, t.REFERENCES)))
    links = t.table(spark, sf_dir, "pages").select("page_id", "url", refs.alias("ref"))
    resolved = markup.absolute_url(F.col("url"), F.col("ref"))
    return links.select("page_id", "ref", resolved.alias("link"))


@registered
def clean_mail_lines(spark, sf_dir):
    mails = t.issues_of_mail(spark, sf_dir)
    return mails.select("doc_id", clean_lines(F.col("text")).alias("text"))


@registered
def capped_blank_runs(spark, sf_dir):
    mails = t.issues_of_mail(spark, sf_dir)
    return mails.select("doc_id", cap_blank_runs(F.col("text")).alias("text"))


@registered
def card_links(spark, sf_dir):
    links = pages.card_links(t.listing_pages(spark, sf_dir), "/blog/", "/blog/category/")
    return links.select("run_id", "link_pos", "link", "title")


@registered
def dated_articles(spark, sf_dir):
    found = pages.page_articles(t.document_pages(spark, sf_dir, "article"))
    return found.select("doc_id", "title", "published_at", "content")


@registered
def long_body_pages(spark, sf_dir):
    text = pages.long_body_markdown(F.col("html"))
    return t.document_pages(spark, sf_dir, "long").select("doc_id", text.alias("content"))


@registered
def font_pages(spark, sf_dir):
    html = pages.font_container_markdown(F.col("html"))
    return t.document_pages(spark, sf_dir, "font").select("doc_id", html.alias("content"))


@registered
def newsletter_pages(spark, sf_dir):
    text = pages.newsletter_markdown(F.col("html"))
    return t.document_pages(spark, sf_dir, "newsletter").select("doc_id", text.alias("content"))


@registered
def mail_pages(spark, sf_dir):
    html = F.col("html")
    return t.document_pages(spark, sf_dir, "mail").select(
        "doc_id",
        pages.email_title(html).alias("title"),
        pages.email_markdown(html).alias("content"),
    )


@registered
def page_fallback(spark, sf_dir):
    """Blank feed bodies filled from the pages of the same url."""
    store = t.store(spark, sf_dir)
    page = F.concat(F.lit("https://pages.example.org/"), F.col("item_pos").cast("string"))
    items = store.select(
        page.alias("url"), F.col("body").alias("content"), (F.col("item_pos") % 20).alias("item_pos")
    )
    fetched = t.document_pages(spark, sf_dir, "article").select("url", "html")
    text = pages.visible_text(pages.inner(F.col("html"), "h1"))
    return pages.with_page_body(items, fetched, text, first_n=5)


# --- landed payloads --------------------------------------------------------------


@registered
def feed_items(spark, sf_dir):
    items = feeds.feed_items(t.landed_feeds(spark, sf_dir))
    return items.select(
        "run_id", "item_pos", "title", "url", "published_at", "author", "content"
    )


@registered
def quarantined_payloads(spark, sf_dir):
    landed = t.damaged_feeds(spark, sf_dir)
    return ingest.quarantine(landed, feeds.feed_items(landed)).select("source_id", "run_id")


@registered
def ranked_feed_items(spark, sf_dir):
    return feeds.ranked_feed_items(t.landed_feeds(spark, sf_dir)).select(
        "run_id", "rank", "title", "url", "published_at"
    )


@registered
def cms_items(spark, sf_dir):
    return ranked.cms_items(t.landed_cms(spark, sf_dir)).select(
        "run_id", "item_pos", "title", "url", "published_at", "content"
    )


@registered
def paper_items(spark, sf_dir):
    return flat(ranked.paper_items(t.landed_papers(spark, sf_dir)))


@registered
def link_list_items(spark, sf_dir):
    return flat(ranked.link_list_items(t.landed_links(spark, sf_dir)))


@registered
def repo_items(spark, sf_dir):
    return flat(ranked.repo_items(t.landed_repos(spark, sf_dir)))


@registered
def release_items(spark, sf_dir):
    return flat(ranked.release_items(t.landed_releases(spark, sf_dir)))


@registered
def embedded_list_items(spark, sf_dir):
    return flat(ranked.embedded_list_items(t.landed_embedded(spark, sf_dir), with_change=True))
