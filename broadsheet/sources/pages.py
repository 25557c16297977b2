"""Listing pages to links, article pages to items.

Input is a table of fetched pages ``(url, html, ...)``; other columns pass
through. Each page is handled inside its own row, so none of this shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.dates import normalize_date
from broadsheet.functions.lines import cap_blank_runs, clean_lines
from broadsheet.functions.markup import (
    UNWANTED,
    absolute_url,
    block_texts,
    decode_entities,
    hrefs,
    inner,
    strip_markup,
    to_markdown,
    visible_text,
    without_invisible,
    without_tags,
)
from broadsheet.functions.text import filled, first_filled, is_blank, let, strip
from broadsheet.sources.dom import first_children, select_inner, without_styled

BODY_START_CHARS = 80
# Classes of widgets inside long bodies, styles that hide an
# element, words of footer blocks.
SKIPPED_CLASSES = ["SVELTE_HYDRATER", "not-prose"]
HIDDEN = ["display:none", "visibility:hidden", "max-height:0"]
FOOTER_WORDS = ["unsubscribe", "update your preferences"]


def _wanted(href: Column, include: str, exclude: str | None) -> Column:
    keep = href.startswith(include)
    return keep & ~href.startswith(exclude) if exclude else keep


def page_links(
    pages: DataFrame, include: str, exclude: str | None = None, limit: int | None = None
) -> DataFrame:
    """Distinct links of a flat listing in page order.

    ``array_distinct`` keeps first occurrences, so duplicates go without a window.
    """
    scope = F.coalesce(inner(F.col("html"), "main"), F.col("html"))
    kept = F.filter(hrefs(scope), lambda h: _wanted(h, include, exclude))
    links = F.array_distinct(F.transform(kept, lambda h: absolute_url(F.col("url"), h)))
    if limit:
        links = F.slice(links, 1, limit)
    rest = [c for c in pages.columns if c not in ("html",)]
    return pages.select(*rest, F.posexplode(links).alias("link_pos", "link"))


def card_links(
    pages: DataFrame, include: str, exclude: str | None = None, limit: int | None = None
) -> DataFrame:
    """One link per ``<article>`` card (its first anchor) with the card's title."""
    scope = F.coalesce(inner(F.col("html"), "main"), without_invisible(F.col("html")))
    cards = F.regexp_extract_all(
        scope, F.lit(r"(?is)<article(?:\s[^>]*)?>(.*?)(?:</article\s*>|\z)"), 1
    )

    def card(html: Column) -> Column:
        heading = F.regexp_extract(html, r"(?is)<h[1-3](?:\s[^>]*)?>(.*?)</h[1-3]\s*>", 1)
        return F.struct(
            F.get(hrefs(html), F.lit(0)).alias("href"),
            first_filled(visible_text(heading), visible_text(html)).alias("title"),
        )

    rest = [c for c in pages.columns if c not in ("html",)]
    found = F.filter(F.transform(cards, card), lambda c: _wanted(c["href"], include, exclude))
    # The first card of a link wins: the map keeps one title per link.
    links = F.array_distinct(F.transform(F.col("cards"), lambda c: c["href"]))
    titled = F.transform(
        links,
        lambda h: F.struct(
            h.alias("href"),
            F.get(F.filter(F.col("cards"), lambda c: c["href"] == h), F.lit(0))["title"].alias(
                "title"
            ),
        ),
    )
    if limit:
        titled = F.slice(titled, 1, limit)
    return (
        pages.select(*rest, found.alias("cards"))
        .select(*rest, F.posexplode(titled).alias("link_pos", "card"))
        .select(*rest, "link_pos", absolute_url(F.col("url"), F.col("card.href")).alias("link"),
                F.col("card.title").alias("title"))
    )


def jsonld_date(html: Column) -> Column:
    """First publication (or creation) date given in a page's JSON-LD blocks."""
    scripts = F.regexp_extract_all(
        html,
        F.lit(
            r"(?is)<script[^>]*\btype\s*=\s*[\"']?application/ld\+json[\"']?[^>]*>(.*?)</script\s*>"
        ),
        1,
    )

    def elements(v: Column, path: str = "$") -> Column:
        return F.coalesce(
            F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>")
        )

    def candidates(v: Column) -> Column:
        listed = F.when(
            F.schema_of_variant(v).startswith("ARRAY"), elements(v)
        ).otherwise(F.array(v))
        nested = F.flatten(F.transform(listed, lambda x: elements(x, "$['@graph']")))
        return F.concat(listed, nested)

    payloads = F.flatten(
        F.transform(F.filter(F.transform(scripts, F.try_parse_json), lambda v: v.isNotNull()), candidates)
    )
    dates = F.transform(
        payloads,
        lambda v: first_filled(
            F.try_variant_get(v, "$.datePublished", "string"),
            F.try_variant_get(v, "$.dateCreated", "string"),
        ),
    )
    first = F.get(F.filter(dates, lambda d: F.length(F.trim(d)) > 0), F.lit(0))
    return normalize_date(first)


def page_articles(
    pages: DataFrame,
    containers: tuple[str, ...] = ("main", "article"),
    listed_title: Column | None = None,
) -> DataFrame:
    """Title, date and body of article pages; pages without a body are dropped.

    The title is the first heading, taken out of the body; else the listing's
    title; else the url.
    """
    html = F.col("html")
    box = F.coalesce(*[inner(html, tag) for tag in containers])
    heading = r"(?s)<[hH]1(?:\s[^>]*)?>(.*?)</[hH]1\s*>"
    rest = [c for c in pages.columns if c not in ("html", "listed_title")]
    if listed_title is None:
        listed_title = F.lit(None).cast("string")
    boxed = pages.select(
        *rest,
        listed_title.alias("listed_title"),
        box.alias("box"),
        F.regexp_extract(without_invisible(html), heading, 1).alias("any_heading"),
        jsonld_date(html).alias("published_at"),
    ).withColumn("heading", first_filled(F.regexp_extract("box", heading, 1), F.col("any_heading")))
    first_heading = r"(?s)\A(.*?)<[hH]1(?:\s[^>]*)?>.*?</[hH]1\s*>"
    body = without_tags(F.regexp_replace("box", first_heading, "$1"), UNWANTED)
    article = F.struct(
        first_filled(visible_text(F.col("heading")), F.col("listed_title"), F.col("url")).alias(
            "title"
        ),
        F.col("published_at"),
        to_markdown(body).alias("content"),
    )
    # Filtered inside the generator: a filter on the result would render twice.
    kept = F.filter(F.array(article), lambda r: r["content"] != "")
    return boxed.select(*rest, F.inline(kept))


def page_text(pages: DataFrame) -> DataFrame:
    """Visible text of whole pages."""
    rest = [c for c in pages.columns if c != "html"]
    return pages.select(*rest, visible_text(F.col("html")).alias("text"))


def page_blocks(
    pages: DataFrame, container: str = "article", min_chars: int = BODY_START_CHARS
) -> DataFrame:
    """Text blocks of a container from the first one of body length on."""
    rest = [c for c in pages.columns if c != "html"]
    blocks = pages.select(*rest, block_texts(inner(F.col("html"), container)).alias("blocks"))
    start = F.array_position(F.transform("blocks", lambda b: F.length(b) >= min_chars), True)
    kept = F.when(start > 0, F.slice("blocks", start.cast("int"), F.size("blocks")))
    return blocks.select(*rest, F.posexplode(kept).alias("block_pos", "block"))


def font_container_markdown(html: Column) -> Column:
    """Body of pages laid out as one ``<font size=2 face=verdana>`` cell."""
    body = F.get(select_inner(html, "font", size="2", face="verdana"), F.lit(0))
    return let(to_markdown(body), lambda t: F.when(t != "", F.concat(t, F.lit("\n"))))


def _node_text(node: Column) -> Column:
    return F.when(node["name"].isNull(), strip(decode_entities(node["html"]))).otherwise(
        strip_markup(node["html"])
    )


def long_body_markdown(html: Column, container_class: str = "blog-content") -> Column:
    """Markdown of a long-form page: children of the container from the first
    node of body length on, without widgets and empty nodes."""
    widgets = F.array(*[F.lit(c) for c in SKIPPED_CLASSES])

    def described(node: Column) -> Column:
        return F.struct(
            node["name"].alias("name"),
            node["html"].alias("html"),
            F.arrays_overlap(node["classes"], widgets).alias("widget"),
            _node_text(node).alias("text"),
        )

    def kept(node: Column) -> Column:
        media = node["html"].rlike(r"(?i)<(?:img|pre|code)\b")
        return ~node["widget"] & ((node["text"] != "") | (node["name"].isNotNull() & media))

    def rendered(node: Column) -> Column:
        escaped = node["text"]
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            escaped = F.replace(escaped, F.lit(char), F.lit(entity))
        return F.when(
            node["name"].isNull(), F.concat(F.lit("<p>"), escaped, F.lit("</p>"))
        ).otherwise(node["html"])

    def from_start(nodes: Column) -> Column:
        start = F.array_position(
            F.transform(
                nodes, lambda n: ~n["widget"] & (F.length(n["text"]) >= BODY_START_CHARS)
            ),
            True,
        )
        body = F.when(start > 0, F.slice(nodes, start.cast("int"), F.size(nodes)))
        return F.array_join(F.transform(F.filter(body, kept), rendered), "\n")

    nodes = F.transform(first_children(html, "div", class_=container_class), described)
    text = to_markdown(let(nodes, from_start))
    return let(text, lambda t: F.when(t != "", F.concat(t, F.lit("\n"))))


def newsletter_markdown(html: Column) -> Column:
    """Text blocks of an e-mail archive page, without the footer block."""
    blocks = select_inner(html, class_="mcnTextContent")
    texts = F.filter(
        F.transform(blocks, lambda b: cap_blank_runs(to_markdown(b))),
        lambda t: (t != "")
        & ~F.exists(
            F.array(*[F.lit(w) for w in FOOTER_WORDS]), lambda w: F.contains(F.lower(t), w)
        ),
    )
    joined = F.replace(F.array_join(texts, "\n\n"), F.lit(" "), F.lit(" "))
    # Listings start on their own line after a batch code such as F2025.
    joined = F.regexp_replace(joined, r"(\b[FSW]\d{4})\s{2,}\[", "$1\n\n[")
    return F.when(F.size(blocks) > 0, strip(joined)).otherwise(to_markdown(html))


def email_markdown(html: Column) -> Column:
    """Rendered e-mail without hidden nodes and layout tables, lines cleaned."""
    text = without_tags(without_styled(html, HIDDEN), ["script", "style", "noscript", "head"])
    text = F.regexp_replace(text, r"(?i)<img\b[^>]*>|<meta\b[^>]*>", "")
    return clean_lines(to_markdown(text))


def email_title(html: Column) -> Column:
    return let(visible_text(inner(html, "title")), filled)


def last_pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    """One page per key, that of the last run; ties go to the greater text."""
    order = [c for c in ("run_id",) if c in pages.columns and c not in keys]
    last = F.max(F.struct(*order, "html"))
    return pages.groupBy(*keys).agg(last.alias("last")).select(*keys, "last.html")


def with_page_body(
    items: DataFrame,
    pages: DataFrame,
    body: Column,
    first_n: int | None = None,
    only_blank: bool = True,
) -> DataFrame:
    """Fill bodies that the feed left blank from the fetched pages.

    ``pages`` is ``(url, html)``, with ``run_id`` where several runs landed it:
    the last one counts, so a page landed twice doubles no item. Only the first
    ``first_n`` entries of a feed are eligible. Without ``only_blank`` a fetched
    page also wins over the feed's own body.
    """
    eligible = is_blank(F.col("content")) if only_blank else F.lit(True)
    if first_n is not None:
        eligible = eligible & (F.col("item_pos") < first_n)
    fetched = last_pages(pages, ["url"]).select(F.col("url").alias("page_url"), body.alias("page_body"))
    joined = items.join(fetched, eligible & (F.col("url") == F.col("page_url")), "left")
    return joined.withColumn(
        "content",
        F.when(~is_blank(F.col("page_body")), F.col("page_body")).otherwise(F.col("content")),
    ).select(*items.columns)
