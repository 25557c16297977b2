"""The three queries: by source, by title term, by archive date.

One code path serves the stored tables and the materialised index, because
both have the record columns. Answers come newest first; equal stamps follow
registry order, then the order within the source; rows of one place, as of two
landed documents, follow their urls and titles.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.text import contains_term


def newest_first(records: DataFrame, limit: int | None = None) -> DataFrame:
    """Total order of answers; 0 or None means no limit."""
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    ordered = records.orderBy(
        F.desc_nulls_last("archived_ts"), F.asc("source_pos"), F.asc("source_id"), F.asc("item_pos"),
        F.asc("url"), F.asc("title"),
    )
    return ordered.limit(limit) if limit else ordered


def _restricted(records: DataFrame, source_ids: list[str] | str | None) -> DataFrame:
    if source_ids is None:
        return records
    wanted = [source_ids] if isinstance(source_ids, str) else list(source_ids)
    return records.where(F.col("source_id").isin(wanted))


def by_source(records: DataFrame, source_id: str, limit: int | None = None) -> DataFrame:
    return newest_first(_restricted(records, source_id), limit)


def by_keyword(
    records: DataFrame,
    term: str,
    source_ids: list[str] | str | None = None,
    limit: int | None = None,
) -> DataFrame:
    hits = _restricted(records, source_ids).where(contains_term(F.col("title"), term))
    return newest_first(hits, limit)


def date_range(
    on: str | None = None, start: str | None = None, end: str | None = None
) -> tuple[date, date]:
    """A single day wins over a range; a range needs both ends.

    Days are ISO dates; anything else, also after a date, raises ValueError.
    """
    if on:
        day = date.fromisoformat(on)
        return day, day
    if not start or not end:
        raise ValueError("a date range needs both its start and its end")
    return date.fromisoformat(start), date.fromisoformat(end)


def by_archive_date(
    records: DataFrame,
    on: str | None = None,
    start: str | None = None,
    end: str | None = None,
    source_ids: list[str] | str | None = None,
    limit: int | None = None,
) -> DataFrame:
    first, last = date_range(on, start, end)
    hits = _restricted(records, source_ids).where(
        F.col("archived_date").between(F.lit(first), F.lit(last))
    )
    return newest_first(hits, limit)
