"""Line-level clean-up of Markdown bodies; each rule stays inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.text import rstrip, split_lines, strip

# How the first real line of an e-mail issue starts.
OPENINGS = ["hey ", "your daily briefing"]


def _is_table_border(line: Column) -> Column:
    edged = line.startswith("|") & line.endswith("|")
    return edged & (F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit(""))) > 4)


def _is_pipe_only(line: Column) -> Column:
    edged = line.startswith("|") & line.endswith("|")
    return edged & (strip(F.replace(line, F.lit("|"), F.lit(""))) == "")


def _trimmed(text: Column) -> Column:
    return F.transform(split_lines(text), rstrip)


def clean_lines(text: Column) -> Column:
    """Drop table rules, pipe lines and the preamble; collapse blank runs to one."""
    kept = F.filter(
        _trimmed(text), lambda x: ~(_is_table_border(strip(x)) | _is_pipe_only(strip(x)))
    )
    body = F.array_join(kept, "\n")
    body = F.regexp_replace(body, rf"(?dimsu)\A.*?^({'|'.join(OPENINGS)})", "$1")
    return strip(F.regexp_replace(body, r"\n{3,}", "\n\n"))


def cap_blank_runs(text: Column) -> Column:
    """Right-trim every line and keep at most two blank lines in a row."""
    body = F.array_join(_trimmed(text), "\n")
    return strip(F.regexp_replace(body, r"\n{4,}", "\n\n\n"))
