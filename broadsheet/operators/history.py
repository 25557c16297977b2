"""Sightings of items over time: first and last seen, content versions, reads as of a time.

A sighting is ``(source_id, url, seen_at, tie, content_hash)``; ``tie`` orders
sightings of one instant. Nothing here joins on a range: what held at a time is
found by sorting questions among the facts and carrying the last fact forward.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["source_id", "url"]
NEW, CHANGED = "new", "changed"


def first_last_seen(sightings: DataFrame) -> DataFrame:
    """One row per item: first and last sighting and how many there were.

    Summed per task before the shuffle, so a hot item sends one row a task.
    """
    return sightings.groupBy(*KEY).agg(
        F.min("seen_at").alias("first_seen"),
        F.max("seen_at").alias("last_seen"),
        F.count(F.lit(1)).alias("times_seen"),
    )


def merge_seen(held: DataFrame, arriving: DataFrame) -> DataFrame:
    """Seen rows of two periods as one; either may hold any of the items."""
    return held.unionByName(arriving).groupBy(*KEY).agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("times_seen").alias("times_seen"),
    )


def content_versions(sightings: DataFrame, block: Column | None = None) -> DataFrame:
    """Stretches of equal content of each item, numbered from 1.

    ``source_id, url, version_no, content_hash, first_seen, last_seen,
    times_seen``. A hash that comes back after another is a new version; NULL
    is a content like any other. Stretches are first found in blocks of time (a
    rising function of ``seen_at``, its day by default): the window over a whole
    item, however hot, only sees their ends.
    """
    changed = _changes(["seen_at", "tie"], [*KEY, "block"])
    order = Window.partitionBy(*KEY, "block").orderBy("seen_at", "tie")
    blocks = (
        sightings.withColumn("block", F.to_date("seen_at") if block is None else block)
        .withColumn("changed", changed)
        .withColumn("stretch", F.sum("changed").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*KEY, "block", "stretch", "content_hash")
        .agg(
            F.min("seen_at").alias("first_seen"),
            F.max("seen_at").alias("last_seen"),
            F.count(F.lit(1)).alias("times_seen"),
        )
    )
    whole = Window.partitionBy(*KEY).orderBy("block", "stretch")
    numbered = blocks.withColumn("changed", _changes(["block", "stretch"], KEY)).withColumn(
        "version_no", F.sum("changed").over(whole.rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy(*KEY, "version_no", "content_hash").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("times_seen").alias("times_seen"),
    )


def _changes(order: list[str], keys: list[str]):
    """1 where the content differs from the one before it, or none is before it."""
    window = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(window) == 1
    same = F.lag("content_hash").over(window).eqNullSafe(F.col("content_hash"))
    return F.when(~first & same, 0).otherwise(1).cast("bigint")


def as_of(versions: DataFrame, asked: DataFrame) -> DataFrame:
    """The version of each asked ``(source_id, url, at)`` that was the latest then.

    Columns of ``asked`` distinct, ``version_no``, ``content_hash`` and
    ``since``, NULL before the first version and for unknown items.
    """
    fact = F.struct("version_no", "content_hash", F.col("first_seen").alias("since"))
    facts = versions.select(
        *KEY, F.col("first_seen").alias("at"), fact.alias("fact"), F.lit(False).alias("question")
    )
    questions = asked.select(*KEY, "at").distinct().select(
        *KEY, "at", F.lit(None).cast(facts.schema["fact"].dataType).alias("fact"),
        F.lit(True).alias("question"),
    )
    # At one instant the facts come first, the highest version last of them.
    order = Window.partitionBy(*KEY).orderBy("at", "question", "fact.version_no")
    carried = F.last("fact", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        facts.unionByName(questions)
        .withColumn("held", carried)
        .where("question")
        .select(*KEY, "at", "held.version_no", "held.content_hash", "held.since")
    )


def latest(versions: DataFrame) -> DataFrame:
    """The last version of each item."""
    last = F.max_by(F.struct("version_no", "content_hash", "first_seen", "last_seen"), "version_no")
    return versions.groupBy(*KEY).agg(last.alias("v")).select(*KEY, "v.*")


def updates(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Versions that each source's last run brought, with the one before.

    ``runs`` is ``(source_id, started_at)``. ``status`` is ``new`` for the first
    version of an item, else ``changed``. Of an item that changed more than once
    in the run every version is told.
    """
    # Versions lie by item already, so the one before costs no shuffle; one row a
    # source tells where its last run began.
    before = Window.partitionBy(*KEY).orderBy("version_no")
    last = runs.groupBy("source_id").agg(F.max("started_at").alias("since"))
    status = F.when(F.col("version_no") == 1, NEW).otherwise(CHANGED)
    return (
        versions.withColumn("previous_hash", F.lag("content_hash").over(before))
        .join(last, "source_id")
        .where(F.col("first_seen") >= F.col("since"))
        .select(*KEY, "version_no", status.alias("status"), "content_hash", "previous_hash", "first_seen")
    )
