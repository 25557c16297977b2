"""Explicit schemas of the stored and landed tables; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in pairs])


_STR, _INT, _LONG, _BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
EXTRA = T.MapType(_STR, _STR)
COMMENT = _fields(("author", _STR), ("published_at", _STR), ("text", _STR))

# One row per registered source; ``source_pos`` is the registry order.
SOURCE = _fields(
    ("source_pos", _INT),
    ("source_id", _STR),
    ("source_name", _STR),
    ("kind", _STR),
    ("method", _STR),
    ("enabled", _BOOL),
    ("item_limit", _INT),
)

# A landed response body, one row per fetched document.
RAW = _fields(("source_id", _STR), ("run_id", _STR), ("body", _STR))

# An archive entry as it arrives.
ARCHIVE_ITEM = _fields(
    ("source_id", _STR),
    ("run_id", _STR),
    ("item_pos", _LONG),
    ("title", _STR),
    ("url", _STR),
    ("published_at", _STR),
    ("author", _STR),
    ("summary", _STR),
    ("content", _STR),
)

# A ranked entry as it arrives.
RANKED_ITEM = _fields(
    ("source_id", _STR),
    ("run_id", _STR),
    ("item_pos", _LONG),
    ("title", _STR),
    ("url", _STR),
    ("published_at", _STR),
    ("author", _STR),
    ("score", _LONG),
    ("comments_count", _LONG),
    ("rank", _INT),
    ("discussion_url", _STR),
    ("comments", T.ArrayType(COMMENT)),
    ("extra", EXTRA),
)

# A line of an archive's manifest and the row kept in ``items``.
MANIFEST_ROW = _fields(
    ("id", _STR),
    ("source_id", _STR),
    ("title", _STR),
    ("url", _STR),
    ("published_at", _STR),
    ("archived_at", _STR),
    ("author", _STR),
    ("summary", _STR),
    ("content_path", _STR),
)

# An entry of a snapshot document (one document per source and UTC day).
SNAPSHOT_ITEM = _fields(
    ("title", _STR),
    ("url", _STR),
    ("published_at", _STR),
    ("author", _STR),
    ("score", _LONG),
    ("comments_count", _LONG),
    ("rank", _INT),
    ("discussion_url", _STR),
    ("comments", T.ArrayType(COMMENT)),
    ("extra", EXTRA),
)
# The fifteen fields of an answer, in output order.
RECORD_FIELDS = [
    "source_id",
    "source_name",
    "kind",
    "title",
    "url",
    "archived_at",
    "published_at",
    "author",
    "snapshot_date",
    "rank",
    "comments_count",
    "score",
    "extra",
    "item_id",
    "content_path",
]
# The columns that spell out the order of answers.
ORDER_FIELDS = ["archived_ts", "source_pos", "item_pos"]

ISSUE = _fields(
    ("source_id", _STR),
    ("kind", _STR),
    ("issue_type", _STR),
    ("item_id", _STR),
    ("path", _STR),
    ("detail", _STR),
    ("snippet", _STR),
)
