"""Data-quality audit of a store: 25 rules, one row per issue.

Bodies and side files are judged where they lie; only small verdicts travel
through the joins. Rules of one row are an array that is exploded, so a table
is read once however many rules look at it. A row that counts as checked puts a
marker without an issue type into the same array: issues, checked items and all
totals come from this one frame. ``seq`` columns carry scan order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.text import (
    content_path,
    filled,
    let,
    looks_like_placeholder,
    snippet,
    strip,
)
from broadsheet.schemas import ISSUE
from broadsheet.sources.ranked import strict_json, string_at

MIN_CHARS = 400
MAX_ISSUES = 200
MAX_EXAMPLES = 20

ISSUE_COLUMNS = ISSUE.names
# Scan order: source, landed file, position in it, rule.
SEQUENCE = ["source_id", "seq_file", "seq_pos", "seq_rule"]


def _rule(
    condition: Column, issue_type: str, number: int, detail: Column | None = None,
    snip: Column | None = None, path: Column | None = None,
) -> Column:
    null = F.lit(None).cast("string")
    issue = F.struct(
        F.lit(issue_type).alias("issue_type"),
        F.lit(number).alias("seq_rule"),
        (detail if detail is not None else null).alias("detail"),
        (snip if snip is not None else null).alias("snippet"),
        (path if path is not None else null).alias("path"),
    )
    return F.when(F.coalesce(condition, F.lit(False)), issue)


_MARKER = "marker"


def _raise(df: DataFrame, kind: str, rules: list[Column], checked: Column | None = None) -> DataFrame:
    """Explode the triggered rules of each row, with a marker where it is checked."""
    if checked is not None:
        rules = [_rule(checked, _MARKER, 0), *rules]
    present = F.filter(F.array(*rules), lambda r: r.isNotNull())
    columns = ["source_id", "item_id", "seq_file", "seq_pos"]
    marker = F.col("r.issue_type") == _MARKER
    return df.select(*columns, F.explode(present).alias("r")).select(
        "source_id",
        F.lit(kind).alias("kind"),
        F.when(~marker, F.col("r.issue_type")).alias("issue_type"),
        F.when(~marker, F.col("item_id")).alias("item_id"),
        "r.path",
        "r.detail",
        "r.snippet",
        "seq_file",
        "seq_pos",
        "r.seq_rule",
        marker.cast("bigint").alias("checked"),
    )


def issues(frame: DataFrame) -> DataFrame:
    """The issue rows of a frame."""
    return frame.where("issue_type is not null")


# --- layout --------------------------------------------------------------


def missing_root(spark: SparkSession, path: str) -> DataFrame:
    """The issue of a store whose source folder does not exist."""
    return spark.range(1).select(
        F.lit("(none)").alias("source_id"), F.lit("unknown").alias("kind"),
        F.lit("sources_root_missing").alias("issue_type"),
        F.lit(None).cast("string").alias("item_id"), F.lit(path).alias("path"),
        F.lit(None).cast("string").alias("detail"), F.lit(None).cast("string").alias("snippet"),
        F.lit("").alias("seq_file"), F.lit(0).cast("bigint").alias("seq_pos"),
        F.lit(1).alias("seq_rule"), F.lit(0).cast("bigint").alias("checked"),
    )


def layout_rows(layout: DataFrame) -> DataFrame:
    """``(source_id, path, manifests, snapshots)`` counts; neither = unknown."""
    df = layout.select(
        "source_id", F.lit(None).cast("string").alias("item_id"), F.col("path").alias("seq_file"),
        F.lit(0).cast("bigint").alias("seq_pos"), "manifests", "snapshots",
    )
    unknown = (F.col("manifests") == 0) & (F.col("snapshots") == 0)
    return _raise(
        df, "unknown", [_rule(unknown, "source_unrecognized_layout", 2, path=F.col("seq_file"))]
    )


# --- manifests -----------------------------------------------------------


def split_lines(files: DataFrame) -> DataFrame:
    """Landed manifest files ``(source_id, path, content BINARY)`` to lines.

    Lines end at ``\\n`` only, blank ones are skipped and not counted. A file
    that is no UTF-8 or has no line yields one row with ``file_issue``.
    """
    text = F.when(F.is_valid_utf8("content"), F.decode("content", "UTF-8"))
    lines = F.filter(F.split(text, "\n"), lambda x: strip(x) != "")
    file_issue = F.when(text.isNull(), "manifest_bad_utf8").when(
        F.size(lines) == 0, "manifest_empty"
    )
    return files.select(
        "source_id", "path", file_issue.alias("file_issue"), lines.alias("lines")
    ).select(
        "source_id", "path", "file_issue", F.posexplode_outer("lines").alias("pos", "line")
    ).select(
        "source_id", "path", "file_issue", (F.col("pos") + 1).cast("bigint").alias("line_no"), "line"
    )


def parsed_lines(rows: DataFrame) -> DataFrame:
    """The audited fields of ``(source_id, path, file_issue, line_no, line)``."""
    parsed = let(
        strict_json(F.col("line")),
        lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v),
    )
    return rows.select("source_id", "path", "file_issue", "line_no", parsed.alias("v")).select(
        "source_id",
        "path",
        "file_issue",
        "line_no",
        F.col("v").isNotNull().alias("json_ok"),
        string_at(F.col("v"), "$.id").alias("id"),
        string_at(F.col("v"), "$.url").alias("url"),
        string_at(F.col("v"), "$.content_path").alias("content_path"),
    )


# --- bodies and side files ------------------------------------------------


def body_verdicts(contents: DataFrame, include_snippets: bool = False) -> DataFrame:
    """``(content_path, content BINARY or STRING)`` to one small row per body."""
    raw = F.col("content")
    if dict(contents.dtypes)["content"] == "binary":
        valid = F.is_valid_utf8(raw)
        text = F.when(valid, F.decode(raw, "UTF-8"))
    else:
        valid, text = F.lit(True), raw
    trimmed = contents.select("content_path", valid.alias("valid"), strip(text).alias("body"))
    body = F.col("body")
    snip = snippet(body) if include_snippets else F.lit(None).cast("string")
    return trimmed.select(
        "content_path",
        F.struct(
            F.col("valid").alias("valid"),
            F.length(body).cast("bigint").alias("chars"),
            looks_like_placeholder(body).alias("placeholder"),
            F.contains(body, F.lit("\0")).alias("nul"),
            F.contains(body, F.lit("�")).alias("replacement"),
            snip.alias("snippet"),
        ).alias("b"),
    )


def meta_verdicts(metas: DataFrame) -> DataFrame:
    """``(source_id, item_id, content BINARY or STRING)`` to the compared fields."""
    raw = F.col("content")
    if dict(metas.dtypes)["content"] == "binary":
        raw = F.when(F.is_valid_utf8(raw), F.decode(raw, "UTF-8"))
    return metas.select("source_id", "item_id", strict_json(raw).alias("v")).select(
        "source_id",
        "item_id",
        F.struct(
            F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)).alias("json_ok"),
            string_at(F.col("v"), "$.id").alias("id"),
            string_at(F.col("v"), "$.url").alias("url"),
            string_at(F.col("v"), "$.content_path").alias("content_path"),
        ).alias("m"),
    )


def _manifest_rules(has_id: Column) -> list[Column]:
    """Rules 3 to 7, from file level down to the fields of a line."""
    line = F.concat(F.lit("line="), F.col("line_no").cast("string"))
    path = F.col("seq_file")
    parsed = F.col("file_issue").isNull() & F.col("json_ok")
    broken = F.col("file_issue").isNull() & ~F.col("json_ok")
    return [
        _rule(F.col("file_issue") == "manifest_bad_utf8", "manifest_bad_utf8", 3, path=path),
        _rule(F.col("file_issue") == "manifest_empty", "manifest_empty", 4, path=path),
        _rule(broken, "manifest_bad_json", 5, line, path=path),
        _rule(parsed & ~has_id, "manifest_missing_id", 6, line, path=path),
        _rule(
            has_id & filled(F.col("url")).isNull(), "manifest_missing_url", 7, line, path=path
        ),
    ]


def _meta_rules(stored: Column) -> list[Column]:
    """Rules 9 to 13 on the side file of a stored item."""
    path = F.concat(
        F.lit("sources/"), F.col("source_id"), F.lit("/items/"), F.col("id"), F.lit("/meta.json")
    )
    parsed = stored & F.col("m").isNotNull() & F.col("m.json_ok")
    shown = F.coalesce(F.concat(F.lit("'"), F.col("m.id"), F.lit("'")), F.lit("None"))

    def differs(name: str) -> Column:
        return F.col(name).isNotNull() & ~F.col(f"m.{name}").eqNullSafe(F.col(name))

    return [
        _rule(stored & F.col("m").isNull(), "meta_missing", 9, path=path),
        _rule(stored & ~F.col("m.json_ok"), "meta_bad_json", 10, path=path),
        _rule(
            parsed & differs("id"), "meta_id_mismatch", 11,
            F.concat(F.lit("meta.id="), shown), path=path,
        ),
        _rule(parsed & differs("url"), "meta_url_mismatch", 12, path=path),
        _rule(parsed & differs("content_path"), "meta_content_path_mismatch", 13, path=path),
    ]


def _body_rules(stored: Column, min_chars: int) -> list[Column]:
    """Rules 14 to 19 on the body of a stored item."""
    readable = stored & F.col("b.valid")
    judged = readable & (F.col("b.chars") > 0)
    chars = F.concat(
        F.lit("chars="), F.col("b.chars").cast("string"), F.lit(f" (<{min_chars})")
    )
    path, snip = F.col("body_path"), F.col("b.snippet")
    return [
        _rule(stored & ~F.col("b.valid"), "content_bad_utf8", 14, path=path),
        _rule(readable & (F.col("b.chars") == 0), "content_empty", 15, path=path),
        _rule(
            judged & (F.col("b.chars") < min_chars), "content_too_short", 16, chars, snip, path
        ),
        _rule(judged & F.col("b.placeholder"), "content_placeholder", 17, None, snip, path),
        _rule(judged & F.col("b.nul"), "content_has_nul", 18, path=path),
        _rule(judged & F.col("b.replacement"), "content_has_replacement_char", 19, path=path),
    ]


def line_rows(
    lines: DataFrame,
    bodies: DataFrame | None = None,
    metas: DataFrame | None = None,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """Rules 3 to 19 in one pass over manifest lines joined to the verdicts.

    Lines that can be read count as checked.

    A broken line or a missing id skips the rules after it, a missing body all
    later rules of the item, an unreadable or empty one those on the body, an
    unreadable side file those on its fields. Without ``metas`` rules 9 to 13
    are left out, without ``bodies`` all from 8 on.
    """
    has_id = F.coalesce(F.col("json_ok") & (F.col("id") != ""), F.lit(False))
    # Lines without an item get a key of their own: NULL keys would pile up.
    unmatched = F.concat(
        F.col("path"), F.lit("#"), F.coalesce(F.col("line_no"), F.lit(0)).cast("string")
    )
    own_path = F.coalesce(
        filled(F.col("content_path")), content_path(F.col("source_id"), F.col("id"))
    )
    df = lines.select(
        "source_id", "file_issue", "json_ok", "url", "content_path", "line_no",
        F.col("path").alias("seq_file"),
        F.coalesce("line_no", F.lit(0)).cast("bigint").alias("seq_pos"),
        F.when(has_id, F.col("id")).alias("item_id"),
        F.when(has_id, F.col("id")).otherwise(unmatched).alias("id"),
        F.when(has_id, own_path).otherwise(unmatched).alias("body_path"),
    )
    named = F.col("item_id").isNotNull()
    rules = _manifest_rules(named)
    if bodies is not None:
        df = df.join(bodies.withColumnRenamed("content_path", "body_path"), "body_path", "left")
        stored = named & F.col("b").isNotNull()
        missing = named & F.col("b").isNull()
        rules.append(_rule(missing, "content_missing", 8, path=F.col("body_path")))
        if metas is not None:
            df = df.join(metas.withColumnRenamed("item_id", "id"), ["source_id", "id"], "left")
            rules += _meta_rules(stored)
        rules += _body_rules(stored, min_chars)
    return _raise(df, "blog", rules, F.col("json_ok"))


# --- snapshots ------------------------------------------------------------


def snapshot_rows(files: DataFrame, items_per_file: int | None = None) -> DataFrame:
    """Rules 20 to 25 on landed snapshot files ``(source_id, path, content)``.

    Each file counts as checked.

    All entries are looked at; ``items_per_file`` stops after the first ones.
    """
    raw = F.col("content")
    if dict(files.dtypes)["content"] == "binary":
        raw = F.when(F.is_valid_utf8(raw), F.decode(raw, "UTF-8"))
    v = F.col("v")

    def entry(e: Column, pos: Column) -> Column:
        return F.struct(
            (pos + 1).cast("bigint").alias("pos"),
            F.schema_of_variant(e).startswith("OBJECT").alias("object"),
            filled(string_at(e, "$.url")).isNull().alias("no_url"),
            filled(string_at(e, "$.title")).isNull().alias("no_title"),
        )

    listed = F.when(
        F.schema_of_variant(v).startswith("OBJECT"),
        F.try_variant_get(v, "$.items", "array<variant>"),
    )
    docs = files.select("source_id", "path", strict_json(raw).alias("v")).select(
        "source_id", "path", v.isNotNull().alias("json_ok"), listed.alias("listed")
    )
    # The file itself is subject 0, its entries follow: one pass for all rules.
    none = F.lit(None).cast("boolean")
    whole = F.struct(
        F.lit(0).cast("bigint").alias("pos"),
        none.alias("object"), none.alias("no_url"), none.alias("no_title"),
    )
    looked_at = F.col("listed")
    if items_per_file is not None:
        looked_at = F.slice(looked_at, 1, items_per_file)
    entries = F.transform(looked_at, entry)
    subjects = F.when(F.col("listed").isNull(), F.array(whole)).otherwise(
        F.concat(F.array(whole), entries)
    )
    df = docs.select(
        "source_id",
        F.lit(None).cast("string").alias("item_id"),
        F.col("path").alias("seq_file"),
        "json_ok",
        F.col("listed").isNull().alias("no_list"),
        F.size("listed").alias("n"),
        F.explode(subjects).alias("s"),
    ).withColumn("seq_pos", F.col("s.pos"))
    path = F.col("seq_file")
    file_row, ok = F.col("s.pos") == 0, F.col("json_ok")
    is_object = F.col("s.object")
    return _raise(
        df,
        "aggregation",
        [
            _rule(file_row & ~ok, "snapshot_bad_json", 20, path=path),
            _rule(file_row & ok & F.col("no_list"), "snapshot_items_not_list", 21, path=path),
            _rule(file_row & (F.col("n") == 0), "snapshot_items_empty", 22, path=path),
            _rule(~is_object, "snapshot_item_not_object", 23, path=path),
            _rule(is_object & F.col("s.no_url"), "snapshot_item_missing_url", 24, path=path),
            _rule(is_object & F.col("s.no_title"), "snapshot_item_missing_title", 25, path=path),
        ],
        file_row,
    )


# --- report ---------------------------------------------------------------


def items_checked(frame: DataFrame) -> DataFrame:
    """Checked per source: manifest lines that can be read, snapshot files."""
    return frame.groupBy("source_id", "kind").agg(F.sum("checked").alias("items_checked")).where(
        "items_checked > 0"
    )


def counts_by_type(frame: DataFrame) -> DataFrame:
    return issues(frame).groupBy("issue_type").agg(F.count(F.lit(1)).alias("issues"))


def counts_by_source(frame: DataFrame) -> DataFrame:
    """Every source with items or issues, with its issue counts as a map.

    The kind is that of the source's last issue in scan order, or of what was
    checked where there is none.
    """
    order = F.struct(F.col("issue_type").isNotNull(), *SEQUENCE[1:])
    per_type = frame.groupBy("source_id", "issue_type").agg(
        F.count("issue_type").alias("n"), F.sum("checked").alias("checked"),
        F.max(F.struct(order.alias("at"), "kind")).alias("last"),
    )
    # One row per rule and source reaches this grouping, so at most 26.
    entry = F.when(F.col("issue_type").isNotNull(), F.struct("issue_type", "n"))
    return per_type.groupBy("source_id").agg(
        F.max("last")["kind"].alias("kind"),
        F.sum("checked").alias("items_checked"),
        F.sum("n").alias("issues_total"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("issues"),
    )


def totals(frame: DataFrame, max_issues: int = MAX_ISSUES) -> DataFrame:
    """One row: items checked, issues found, whether the list is cut."""
    return frame.agg(
        F.coalesce(F.sum("checked"), F.lit(0)).cast("bigint").alias("items_checked"),
        F.count("issue_type").alias("issues_total"),
    ).withColumn("issues_truncated", F.col("issues_total") > max_issues)


def count_cube(frame: DataFrame) -> DataFrame:
    """All three count levels in one pass over the issues."""
    return issues(frame).groupingSets(
        [("source_id", "issue_type"), ("issue_type",), ()], "source_id", "issue_type"
    ).agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("issues"))


def examples(frame: DataFrame, n: int = MAX_ISSUES) -> DataFrame:
    """First issues in scan order; the counts never depend on this cut."""
    return issues(frame).orderBy(*SEQUENCE).limit(n)


def example_lines(frame: DataFrame, n: int = MAX_EXAMPLES) -> DataFrame:
    """The first issues as text lines."""
    detail = F.when(F.col("detail").isNull(), "").otherwise(
        F.concat(F.lit(" ("), "detail", F.lit(")"))
    )
    line = F.concat(
        F.lit("- "), "source_id", F.lit(":"), F.coalesce(filled(F.col("item_id")), F.lit("-")),
        F.lit(" "), "issue_type", detail, F.lit(" "), F.coalesce("path", F.lit("")),
    )
    return examples(frame, n).select(line.alias("line"))


def source_lines(by_source: DataFrame) -> DataFrame:
    """One text line per source with its counts, sources by name."""
    counts = F.transform(
        F.array_sort(F.map_entries("issues")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    line = F.format_string(
        "- %s (%s): items_checked=%d issues=%s", "source_id", "kind", "items_checked",
        F.coalesce(filled(F.array_join(counts, ", ")), F.lit("none")),
    )
    return by_source.orderBy("source_id").select(line.alias("line"))


def audit(
    manifest_files: DataFrame | None = None,
    contents: DataFrame | None = None,
    metas: DataFrame | None = None,
    snapshot_files: DataFrame | None = None,
    layout: DataFrame | None = None,
    source_ids: list[str] | None = None,
    min_content_chars: int = MIN_CHARS,
    include_snippets: bool = False,
    items_per_snapshot: int | None = None,
    manifest_lines: DataFrame | None = None,
) -> DataFrame:
    """Audit landed files; gives the frame that all reports are made of.

    Manifests come as whole files or, from a reader that splits them, as lines.
    A source with a manifest is an archive; its snapshots are not looked at.
    """

    def wanted(df: DataFrame | None) -> DataFrame | None:
        if df is None or source_ids is None:
            return df
        return df.where(F.col("source_id").isin(source_ids))

    manifest_files, manifest_lines = wanted(manifest_files), wanted(manifest_lines)
    snapshot_files, layout = wanted(snapshot_files), wanted(layout)
    manifests = manifest_files if manifest_lines is None else manifest_lines
    parts = []
    if manifests is not None:
        lines = split_lines(manifest_files) if manifest_lines is None else manifest_lines
        parts.append(
            line_rows(
                parsed_lines(lines),
                None if contents is None else body_verdicts(contents, include_snippets),
                None if metas is None else meta_verdicts(metas),
                min_content_chars,
            )
        )
        if snapshot_files is not None:
            if layout is not None:
                archives = layout.where("manifests > 0").select("source_id")
            else:
                archives = manifests.select("source_id").distinct()
            snapshot_files = snapshot_files.join(archives, "source_id", "left_anti")
    if snapshot_files is not None:
        parts.append(snapshot_rows(snapshot_files, items_per_snapshot))
    if layout is not None:
        parts.append(layout_rows(layout))
    return reduce(DataFrame.unionByName, parts)
