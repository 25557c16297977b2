"""Date handling; stored dates stay strings, parsing happens on read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.text import filled, let

# Date layouts accepted besides ISO 8601. Each pairs a regular
# expression that cuts the date out of the text with its datetime pattern.
DATE_LAYOUTS = [
    (r"(?:^|[ ,])(\d{1,2} [A-Z][a-z]{2} \d{4})\b", "d MMM yyyy"),
    (r"(?:^|[ ,])(\d{1,2} [A-Z][a-z]{3,8} \d{4})\b", "d MMMM yyyy"),
    (r"\b([A-Z][a-z]{2} \d{1,2}, \d{4})\b", "MMM d, yyyy"),
    (r"\b([A-Z][a-z]{3,8} \d{1,2}, \d{4})\b", "MMMM d, yyyy"),
    (r"\b([A-Z][a-z]{2} \d{1,2} \d{4})\b", "MMM d yyyy"),
    (r"\b([A-Z][a-z]{3,8} \d{1,2} \d{4})\b", "MMMM d yyyy"),
    (r"\b(\d{1,2}-[A-Z][a-z]{2}-\d{4})\b", "d-MMM-yyyy"),
    (r"\b(\d{1,2}\.\d{1,2}\.\d{4})\b", "d.M.yyyy"),
    (r"\b(\d{4}\.\d{1,2}\.\d{1,2})\b", "yyyy.M.d"),
    (r"\b(\d{4}/\d{1,2}/\d{1,2})\b", "yyyy/M/d"),
    (r"\b(\d{1,2}/\d{1,2}/\d{4})\b", "M/d/yyyy"),
]


def _try_date(text: Column, pattern: str) -> Column:
    return F.try_to_timestamp(text, F.lit(pattern)).cast("date")


def calendar_date(col: Column) -> Column:
    """The date as written, in the text's own offset; NULL if there is none.

    Casting through a timestamp would shift ``23:30-05:00`` to the next day.
    """
    iso = F.regexp_extract(col, r"^\s*(\d{4}-\d{2}-\d{2})", 1)
    tries = [_try_date(iso, "yyyy-MM-dd")]
    for regex, pattern in DATE_LAYOUTS:
        tries.append(_try_date(F.regexp_extract(col, regex, 1), pattern))
    return F.coalesce(*tries)


def archived_date(col: Column) -> Column:
    """Calendar date of an archive stamp: ISO 8601, else any known layout."""
    iso = F.try_to_timestamp(F.substring(col, 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    return F.coalesce(iso, calendar_date(col))


def archived_ts(col: Column) -> Column:
    """Instant of an archive stamp; a date in any known layout counts as midnight UTC."""
    rfc = F.substring_index(col, ", ", -1)
    return F.coalesce(
        F.try_to_timestamp(col),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss Z")),
        calendar_date(col).cast("timestamp"),
    )


def normalize_date(col: Column) -> Column:
    """ISO date when the text can be read, the trimmed text otherwise."""
    return let(
        filled(F.trim(col)),
        lambda text: F.coalesce(F.date_format(calendar_date(text), "yyyy-MM-dd"), text),
    )


def epoch_to_iso(seconds: Column) -> Column:
    """Seconds since 1970 as ``YYYY-MM-DDTHH:MM:SS+00:00``; NULL if unreadable."""
    whole = seconds.cast("string").try_cast("bigint")
    in_range = F.when(whole.between(-62135596800, 253402300799), whole)
    return F.date_format(F.timestamp_seconds(in_range), "yyyy-MM-dd'T'HH:mm:ssxxx")
