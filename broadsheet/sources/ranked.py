"""JSON payloads of ranked sources and of the CMS source.

Each flattener takes landed documents ``(source_id, run_id, body)`` and gives
one row per entry. The rank is the position in the payload, so entries dropped
as invalid leave gaps. A payload is read whole unless the caller gives a limit. A body of another shape gives no rows; the run report
lists its source as failed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.markup import strip_markup, to_markdown
from broadsheet.functions.text import filled, first_filled, let
from broadsheet.schemas import RANKED_ITEM

# Prefixes from which page addresses are formed.
PAPER_URL = "https://huggingface.co/papers/"
RELEASE_URL = "https://releasebot.io/updates/"
LISTED_URL = "https://skills.sh/"
LIST_MARKER = "initialSkills"


def text_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def whole_at(value: Column, path: str) -> Column:
    """A whole number, NULL for every other JSON type (also for booleans)."""
    inside = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(inside) == "BIGINT", F.try_variant_get(value, path, "bigint"))


def string_at(value: Column, path: str) -> Column:
    """A JSON string, NULL for every other JSON type."""
    inside = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(inside) == "STRING", F.try_variant_get(value, path, "string"))


def strict_json(text: Column) -> Column:
    """The one JSON value a text consists of; NULL if anything follows it.

    The parser stops after the first value, so the text is read as the only
    element of an array, and an object must also be what the text ends with.
    """

    def only(values: Column) -> Column:
        value = F.get(values, F.lit(0))
        closed = ~is_object(value) | F.rtrim(text, F.lit(" \t\r\n")).endswith("}")
        return F.when((F.size(values) == 1) & closed, value)

    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return let(F.try_variant_get(listed, "$", "array<variant>"), only)


def is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def _first(array: Column, limit: int | None) -> Column:
    return array if limit is None else F.slice(array, 1, limit)


def _entries(raw: DataFrame, path: str, limit: int | None) -> DataFrame:
    """Objects of the array at ``path``, with their position in it."""
    array = F.try_variant_get(F.try_parse_json(F.col("body")), path, "array<variant>")
    return raw.select(
        "source_id", "run_id", F.posexplode(_first(array, limit)).alias("item_pos", "e")
    ).where(is_object(F.col("e")))


def _ranked(df: DataFrame, **fields: Column) -> DataFrame:
    """Complete the given fields to a ranked item and drop invalid rows."""
    fields.setdefault("rank", F.col("item_pos") + 1)
    known = {"source_id": F.col("source_id"), "run_id": F.col("run_id"), "item_pos": F.col("item_pos")}
    columns = [
        known.get(f.name, fields.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        for f in RANKED_ITEM.fields
    ]
    return valid_items(df.select(*columns))


def valid_items(items: DataFrame) -> DataFrame:
    """Rows that have both a title and a url; blanks are not trimmed."""
    return items.where((F.col("title") != "") & (F.col("url") != ""))


def link_list_items(raw: DataFrame, limit: int | None = None) -> DataFrame:
    e = F.col("e")
    return _ranked(
        _entries(raw, "$", limit),
        title=text_at(e, "$.title"),
        url=first_filled(text_at(e, "$.url"), text_at(e, "$.comments_url")),
        published_at=text_at(e, "$.created_at"),
        author=F.coalesce(
            string_at(e, "$.submitter_user"), string_at(e, "$.submitter_user.username")
        ),
        score=whole_at(e, "$.score"),
        comments_count=whole_at(e, "$.comments_count"),
        discussion_url=text_at(e, "$.comments_url"),
    )


def paper_items(raw: DataFrame, limit: int | None = None) -> DataFrame:
    e = F.col("e")
    own_page = F.concat(F.lit(PAPER_URL), filled(text_at(e, "$.paper.id")))
    return _ranked(
        _entries(raw, "$", limit),
        title=first_filled(text_at(e, "$.title"), text_at(e, "$.paper.title")),
        url=F.coalesce(
            own_page,
            filled(text_at(e, "$.paper.projectPage")),
            filled(text_at(e, "$.paper.project_page")),
        ),
        published_at=first_filled(
            text_at(e, "$.publishedAt"), text_at(e, "$.paper.publishedAt")
        ),
        author=text_at(e, "$.paper.authors[0].name"),
        score=whole_at(e, "$.paper.upvotes"),
        comments_count=whole_at(e, "$.numComments"),
    )


def repo_items(raw: DataFrame, limit: int | None = None) -> DataFrame:
    e = F.col("e")
    return _ranked(
        _entries(raw, "$.items", limit),
        title=text_at(e, "$.full_name"),
        url=text_at(e, "$.html_url"),
        published_at=text_at(e, "$.created_at"),
        author=text_at(e, "$.owner.login"),
        score=whole_at(e, "$.stargazers_count"),
        extra=F.create_map(
            F.lit("language"), text_at(e, "$.language"),
            F.lit("description"), text_at(e, "$.description"),
        ),
    )


def _follow(pool: Column, value: Column) -> Column:
    """A whole number >= 0 points to a slot of the pool; the rest is inline."""

    def resolve(v: Column) -> Column:
        pointer = F.when(F.schema_of_variant(v) == "BIGINT", F.try_variant_get(v, "$", "bigint"))
        return F.when(pointer >= 0, F.get(pool, pointer.cast("int"))).otherwise(v)

    return let(value, resolve)


def release_items(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """Releases from reference-table payloads (slots pointing to slots).

    Pointers are followed along the fixed path only, each step bound once.
    """
    nodes = F.try_variant_get(F.try_parse_json(F.col("body")), "$.nodes", "array<variant>")
    pools = F.transform(nodes, lambda n: F.try_variant_get(n, "$.data", "array<variant>"))
    pool = F.col("pool")

    def member(obj: Column, name: str) -> Column:
        return _follow(pool, F.try_variant_get(obj, f"$.{name}", "variant"))

    def leaf(obj: Column, name: str) -> Column:
        return filled(text_at(member(obj, name), "$")).alias(name)

    def with_product(release: Column, product: Column) -> Column:
        return let(
            member(product, "vendor"),
            lambda vendor: F.struct(
                leaf(product, "display_name"),
                leaf(product, "slug"),
                leaf(vendor, "display_name").alias("vendor_name"),
                leaf(vendor, "slug").alias("vendor_slug"),
                let(
                    member(release, "release_details"),
                    lambda d: F.struct(
                        leaf(d, "release_name"),
                        leaf(d, "release_number"),
                        leaf(d, "release_summary"),
                    ),
                ).alias("details"),
                leaf(member(release, "source"), "source_url"),
                leaf(release, "slug").alias("release_slug"),
                leaf(release, "release_date"),
                leaf(release, "created_at"),
            ),
        )

    def described(slot: Column) -> Column:
        return let(
            _follow(pool, slot),
            lambda release: let(
                member(release, "product"), lambda product: with_product(release, product)
            ),
        )

    listing = "$.releases"
    holders = F.filter(
        pools,
        lambda p: F.try_variant_get(F.get(p, F.lit(0)), listing, "variant").isNotNull(),
    )
    listed = _follow(pool, F.try_variant_get(F.get(pool, F.lit(0)), listing, "variant"))
    slots = _first(F.try_variant_get(listed, "$", "array<variant>"), limit)
    df = (
        raw.select("source_id", "run_id", F.get(holders, F.lit(0)).alias("pool"))
        .select("source_id", "run_id", F.posexplode(F.transform(slots, described)).alias("item_pos", "r"))
    )
    release_name = F.coalesce(
        "r.details.release_name", "r.details.release_number", "r.release_slug", F.lit("Release")
    )
    product_name = F.coalesce("r.display_name", "r.vendor_name")
    fallback = F.concat(
        F.lit(RELEASE_URL),
        F.coalesce("r.vendor_slug", F.lit("vendor")),
        F.lit("/"),
        F.coalesce("r.slug", F.lit("product")),
    )
    summary = F.col("r.details.release_summary")
    return _ranked(
        df,
        title=F.concat_ws(" — ", product_name, release_name),
        url=F.coalesce("r.source_url", fallback),
        published_at=F.coalesce("r.release_date", "r.created_at"),
        author=F.col("r.vendor_name"),
        extra=F.when(summary.isNotNull(), F.create_map(F.lit("summary"), summary)).otherwise(
            F.create_map().cast("map<string,string>")
        ),
    )


_LISTED = "array<struct<source string, skillId string, name string, installs bigint, " \
    "installsYesterday bigint, change bigint>>"


def embedded_list_items(
    raw: DataFrame,
    with_change: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """The JSON array that follows a marker inside a page's script.

    ``from_json`` stops at the end of the array, so what follows needs no cut.
    """
    body = F.col("body")
    marker = F.instr(body, LIST_MARKER)
    tail = F.when(marker > 0, F.substr(body, marker))
    tail = F.replace(tail, F.lit('\\"'), F.lit('"'))
    start = F.instr(tail, "[")
    listed = F.from_json(F.when(start > 0, F.substr(tail, start)), _LISTED)
    entry = F.coalesce(F.col("e.source"), F.lit(""))
    skill = F.coalesce(F.col("e.skillId"), F.lit(""))
    extra = [F.lit("source_repo"), entry, F.lit("skill_id"), skill]
    if with_change:
        extra += [
            F.lit("change"), F.col("e.change").cast("string"),
            F.lit("installs_yesterday"), F.col("e.installsYesterday").cast("string"),
        ]
    rows = raw.select(
        "source_id", "run_id", F.posexplode(_first(listed, limit)).alias("item_pos", "e")
    )
    return _ranked(
        rows,
        title=F.col("e.name"),
        url=F.concat(F.lit(LISTED_URL), entry, F.lit("/"), skill),
        author=filled(F.substring_index(entry, "/", 1)),
        score=F.col("e.installs"),
        extra=F.create_map(*extra),
    )


def cms_items(raw: DataFrame) -> DataFrame:
    """Posts with rendered title, excerpt and content."""
    e = F.col("e")
    title, link = text_at(e, "$.title.rendered"), text_at(e, "$.link")
    return (
        _entries(raw, "$", None)
        .where((title != "") & (link != ""))
        .select(
            "source_id",
            "run_id",
            F.col("item_pos").cast("bigint").alias("item_pos"),
            strip_markup(title).alias("title"),
            link.alias("url"),
            text_at(e, "$.date").alias("published_at"),
            F.lit(None).cast("string").alias("author"),
            to_markdown(filled(text_at(e, "$.excerpt.rendered"))).alias("summary"),
            to_markdown(filled(text_at(e, "$.content.rendered"))).alias("content"),
        )
    )
