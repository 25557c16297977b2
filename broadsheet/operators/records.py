"""From stored tables to the one record model that queries return."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.dates import archived_date, archived_ts
from broadsheet.functions.text import record_id
from broadsheet.schemas import ORDER_FIELDS, RECORD_FIELDS, SNAPSHOT_ITEM


def _complete(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "archived_ts": archived_ts(F.col("archived_at")),
            "archived_date": archived_date(F.col("archived_at")),
        }
    ).select(*RECORD_FIELDS, *ORDER_FIELDS, "archived_date")


def archive_records(items: DataFrame, sources: DataFrame) -> DataFrame:
    """One record per manifest row; name and kind come from the dimension.

    ``items`` holds ``source_id, item_pos, id, title, url, archived_at,
    published_at, author, content_path``.
    """
    dimension = sources.where("kind = 'blog'").select(
        "source_id", "source_name", "kind", "source_pos"
    )
    null = F.lit(None)
    return _complete(
        items.join(dimension, "source_id").select(
            "source_id", "source_name", "kind", "title", "url", "archived_at",
            "published_at", "author",
            null.cast("string").alias("snapshot_date"),
            null.cast("int").alias("rank"),
            null.cast("bigint").alias("comments_count"),
            null.cast("bigint").alias("score"),
            null.cast("map<string,string>").alias("extra"),
            F.col("id").alias("item_id"),
            "content_path",
            F.col("source_pos").cast("int").alias("source_pos"),
            F.col("item_pos").cast("bigint").alias("item_pos"),
        )
    )


def snapshot_records(snapshots: DataFrame, sources: DataFrame) -> DataFrame:
    """One record per snapshot entry; comments stay behind in the store."""
    dimension = sources.where("kind = 'aggregation'").select(
        "source_id", "source_name", "kind", "source_pos"
    )
    null = F.lit(None)
    return _complete(
        snapshots.join(dimension, "source_id").select(
            "source_id", "source_name", "kind", "title", "url",
            F.col("snapshot_date").alias("archived_at"),
            "published_at", "author", "snapshot_date",
            F.col("rank").cast("int").alias("rank"),
            F.col("comments_count").cast("bigint").alias("comments_count"),
            F.col("score").cast("bigint").alias("score"),
            F.when(F.size("extra") > 0, F.col("extra")).alias("extra"),
            null.cast("string").alias("item_id"),
            null.cast("string").alias("content_path"),
            F.col("source_pos").cast("int").alias("source_pos"),
            F.col("item_pos").cast("bigint").alias("item_pos"),
        )
    )


def explode_snapshots(documents: DataFrame) -> DataFrame:
    """Landed snapshot documents ``(source_id, body)`` to one row per entry.

    A document without an ``items`` list gives no rows, nor does an entry that
    is no object.
    """
    strict = {"allowSingleQuotes": "false"}
    # Entries stay JSON text first, so that a faulty one spoils no other.
    doc = F.from_json("body", "archived_at string, items array<string>", strict)
    return (
        documents.select("source_id", doc.alias("doc"))
        .select(
            "source_id",
            F.col("doc.archived_at").alias("snapshot_date"),
            F.posexplode("doc.items").alias("item_pos", "e"),
        )
        .where(F.col("e").startswith("{"))
        .select(
            "source_id", "snapshot_date", "item_pos", F.from_json("e", SNAPSHOT_ITEM, strict).alias("i")
        )
        .select("source_id", "snapshot_date", "item_pos", "i.*")
    )


def records_union(archive: DataFrame, snapshots: DataFrame) -> DataFrame:
    return archive.unionByName(snapshots)


def with_record_id(records: DataFrame) -> DataFrame:
    return records.withColumn(
        "record_id", record_id(F.col("source_id"), F.col("archived_at"), F.col("url"))
    )


def with_has_content(records: DataFrame, contents: DataFrame) -> DataFrame:
    """Flag records whose body is stored; only the path column is read."""
    stored = contents.select(F.col("content_path").alias("key")).distinct()
    stored = stored.withColumn("stored", F.lit(True))
    # Ranked records have no path; a key of their own keeps them spread out.
    key = F.coalesce(
        "content_path", F.concat(F.lit("#"), "url", F.lit("#"), F.col("item_pos").cast("string"))
    )
    return (
        records.withColumn("key", key)
        .join(stored, "key", "left")
        .select(*records.columns, F.coalesce("stored", F.lit(False)).alias("has_content"))
    )


def read_content(contents: DataFrame, source_id: str, item_ids: list[str] | None = None) -> DataFrame:
    """Bodies of one archive source, or of the named items in it."""
    found = contents.where(F.col("source_id") == source_id)
    if item_ids is not None:
        found = found.where(F.col("item_id").isin(item_ids))
    return found.select("source_id", "item_id", "content")


def encoded_extra(extra: Column) -> Column:
    """The map as JSON text, NULL for none; keys in order."""
    entries = F.map_from_entries(F.array_sort(F.map_entries(extra)))
    return F.when(F.size(extra) > 0, F.to_json(entries, {"ignoreNullFields": "false"}))


def decoded_extra(text: Column) -> Column:
    """A map from JSON text; NULL for text that is no JSON object."""
    value = F.try_parse_json(text)
    return F.when(
        F.schema_of_variant(value).startswith("OBJECT"),
        F.from_json(text, "map<string,string>"),
    )


def record_lines(records: DataFrame) -> DataFrame:
    """JSON and text rendering of records that carry ``has_content``."""
    shown = [
        F.when(F.size("extra") > 0, F.col("extra")).alias("extra") if c == "extra" else F.col(c)
        for c in RECORD_FIELDS
    ]
    mark = F.when(F.col("has_content"), F.lit("* ")).otherwise(F.lit("  "))
    return records.select(
        "source_id",
        "item_pos",
        F.to_json(
            F.struct(*shown, F.col("has_content")), {"ignoreNullFields": "false"}
        ).alias("json"),
        F.concat(
            mark, F.concat_ws(" | ", "archived_at", "source_id", "title"), F.lit("\n  "), "url"
        ).alias("line"),
    )
