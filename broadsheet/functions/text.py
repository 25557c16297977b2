"""Text rules as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes, and those at
# which str.splitlines() breaks (besides the pair CR LF).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

# The same whitespace for patterns; the class needs the (?U) flag.
SPACE_CLASS = r"\s\x1c\x1d\x1e\x1f"
SPACE_RUN = rf"(?U)[{SPACE_CLASS}]+"

SNIPPET_CHARS = 200
SLUG_CHARS = 80


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a costly value once for an expression that mentions it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(col: Column) -> Column:
    """Remove surrounding Unicode whitespace; looks only at the two ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def lstrip(col: Column) -> Column:
    return F.ltrim(col, F.lit(WHITESPACE))


def rstrip(col: Column) -> Column:
    return F.rtrim(col, F.lit(WHITESPACE))


def collapse_whitespace(col: Column) -> Column:
    """Every run of whitespace becomes one space, none at the ends."""
    return F.trim(F.regexp_replace(col, SPACE_RUN, " "))


def is_blank(col: Column) -> Column:
    return col.isNull() | (strip(col) == "")


def filled(col: Column) -> Column:
    """NULL for the empty string, so that ``coalesce`` skips it too."""
    return F.nullif(col, F.lit(""))


def first_filled(*cols: Column) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*[filled(c) for c in cols])


def body_of(content: Column, summary: Column) -> Column:
    """What is stored as an item's body: content, else summary, else ''."""
    return F.coalesce(filled(content), filled(summary), F.lit(""))


def slugify(col: Column, max_length: int = SLUG_CHARS) -> Column:
    dashed = F.btrim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", "-"), F.lit("-"))
    cut = F.rtrim(F.substring(dashed, 1, max_length), F.lit("-"))
    return F.coalesce(filled(cut), F.lit("item"))


def item_id(title: Column, url: Column) -> Column:
    """Readable slug plus eight hex digits of the url's SHA-1."""
    return F.concat(
        slugify(F.coalesce(filled(title), url)),
        F.lit("-"),
        F.substring(F.sha1(url), 1, 8),
    )


def record_id(source_id: Column, archived_at: Column, url: Column) -> Column:
    parts = [F.coalesce(c, F.lit("")) for c in (source_id, archived_at, url)]
    return F.sha1(F.concat_ws("|", *parts))


def content_path(source_id: Column, item: Column) -> Column:
    return F.concat(F.lit("sources/"), source_id, F.lit("/items/"), item, F.lit("/content.md"))


def contains_term(title: Column, term: str) -> Column:
    """Case-insensitive literal match; ``%`` and ``_`` mean themselves."""
    return F.contains(F.lower(title), F.lower(F.lit(term)))


def looks_like_placeholder(body: Column, preview_chars: int | None = None) -> Column:
    """A layout residue instead of an article.

    True for an empty table cell, a line that holds nothing but a pipe, or a
    sign-up box at the start. The whole body is judged unless
    ``preview_chars`` limits it to its first characters.
    """
    preview = body if preview_chars is None else F.substring(body, 1, preview_chars)
    lone_pipe = rf"(?U)(?:\A|[{LINE_BREAKS}])[{SPACE_CLASS}]*\|[{SPACE_CLASS}]*(?:\z|[{LINE_BREAKS}])"
    return (
        preview.contains("|  |")
        | lstrip(preview).startswith("[Signup]")
        | (preview.contains("|") & preview.rlike(lone_pipe))
    )


def snippet(body: Column) -> Column:
    head = F.translate(F.substring(body, 1, SNIPPET_CHARS), "\n", " ")
    return F.concat(head, F.when(F.length(body) > SNIPPET_CHARS, F.lit("…")).otherwise(""))


def split_lines(col: Column) -> Column:
    return F.split(col, rf"\r\n|[{LINE_BREAKS}]")
