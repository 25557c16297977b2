"""Ranks, first and last occurrences, top lists.

Windows here always keep the first few rows of a group, which Spark also
applies before the shuffle: a hot group sends at most that many rows per task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None
) -> DataFrame:
    """First ``n`` rows of each group; ``rank`` names a column for 1..n."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n)
    if rank is None:
        return ranked.drop(_RANK)
    return ranked.drop(rank).withColumnRenamed(_RANK, rank)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return top_per_group(df, keys, [F.asc(c) for c in order], 1)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return top_per_group(df, keys, [F.desc(c) for c in order], 1)


def positional_rank(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Rank = position in the payload, cut at each source's own limit.

    The limit applies before the validity check, so ranks may have gaps.
    """
    limits = sources.select("source_id", "item_limit")
    return (
        items.join(limits, "source_id")
        .where("item_limit is null or item_pos < item_limit")
        .withColumn("rank", (F.col("item_pos") + 1).cast("int"))
        .drop("item_limit")
        .where((F.col("title") != "") & (F.col("url") != ""))
    )


def hot_stories(
    stories: DataFrame, keys: list[str], seed: str = "seed_pos", limit: int = 10
) -> DataFrame:
    """Most discussed first, ties in seed order, ranks without gaps."""
    order = [F.desc(F.coalesce("comments_count", F.lit(0))), F.asc(seed)]
    return top_per_group(stories, keys, order, limit, rank="rank")


def recent_top_n(
    repos: DataFrame, run_date: date, days: int = 7, n: int = 20, tie: str = "item_pos"
) -> DataFrame:
    """Best scored among those created after ``run_date - days``."""
    since = F.date_sub(F.lit(run_date), days)
    recent = repos.where(F.col("created").cast("date") > since)
    return recent.orderBy(F.desc_nulls_last("score"), F.asc(tie)).limit(n)


def daily_counts(events: DataFrame, source: str, ts: str) -> DataFrame:
    """Entries per source and UTC day, the batch twin of the streaming bucket."""
    day = F.date_format(F.date_trunc("day", F.col(ts)), "yyyy-MM-dd")
    return events.groupBy(F.col(source).alias("source_id"), day.alias("snapshot_date")).agg(
        F.count(F.lit(1)).alias("items")
    )
