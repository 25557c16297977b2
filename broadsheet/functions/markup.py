"""HTML rules as column expressions.

Everything here works on whole documents inside one row, so no rule shuffles.
Patterns avoid nested quantifiers and never look for an end tag over the rest
of a page; elements are matched by counting their start and end tags.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.text import SPACE_RUN, collapse_whitespace, let, strip

# Elements that never belong to an article's text.
UNWANTED = ["script", "style", "noscript", "header", "footer", "nav", "aside"]
# Elements that start a new block of text.
BLOCK_TAGS = (
    "h1|h2|h3|h4|h5|h6|p|ul|ol|pre|blockquote|div|table|figure|section|hr"
)

# A tag ends before the next one begins: what is never closed costs no second look.
TAG = r"</?[a-zA-Z!?](?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
# What is never closed goes on to the end of the page.
INVISIBLE = (
    r"(?s)<(?:!--.*?(?:-->|\z)|(?i:(script|style|template))(?=[\s/>]).*?(?:</(?i)\1\s*>|\z))"
)
BLOCK_MARK = "\x01"


def _references() -> tuple[Column, Column, str]:
    """Names that end in ``;`` by their first letter, the others, and a pattern of the others.

    Each table is one JSON literal that folds to a constant; a name is searched
    among those of its first letter only.
    """
    by_letter: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        if name.endswith(";"):
            by_letter.setdefault(name[0], {})[name] = text
    # The longest first: the first that fits is the longest prefix.
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    full = F.from_json(F.lit(json.dumps(by_letter)), "map<string,map<string,string>>")
    short = F.from_json(F.lit(json.dumps({n: html5[n] for n in bare})), "map<string,string>")
    return full, short, f"^({'|'.join(bare)})"


# What numbers 128 to 159 stand for, where Windows-1252 has a character.
C1 = [bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0)]


def _numeric(piece: Column) -> Column:
    """The text of a piece that begins with a numeric reference; NULL for others."""
    ref = F.regexp_extract(piece, r"^(#(?:[0-9]+|[xX][0-9a-fA-F]+);?)", 1)
    digits = F.regexp_extract(ref, r"^#[xX]?0*([0-9a-fA-F]*)", 1)
    value = F.when(
        ref.rlike("^#[xX]"), F.conv(F.substring(digits, 1, 8), 16, 10)
    ).otherwise(F.substring(digits, 1, 8))

    def text(code: Column) -> Column:
        lost = (code == 0) | (code >= 0x110000) | code.between(0xD800, 0xDFFF)
        silent = (
            ((code < 32) & ~code.isin(9, 10, 12, 13)) | (code == 127)
            | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        )
        known = F.get(F.array(*map(F.lit, C1)), (code - 0x80).cast("int"))
        other = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        shown = F.when(lost, "\ufffd").when(code.between(0x80, 0x9F), known).when(silent, "").otherwise(other)
        return F.concat(shown, F.substr(piece, F.length(ref) + 1))

    code = F.when(digits == "", F.lit(0)).when(F.length(digits) > 8, F.lit(0x110000)).otherwise(
        value.try_cast("bigint")
    )
    return F.when(ref != "", let(code.cast("bigint"), text))


def decode_entities(col: Column) -> Column:
    """Resolve character references, once each, as HTML 5 does.

    All names count, the old ones also without their semicolon, then as the
    longest prefix of what follows. Numbers that stand for no character become
    U+FFFD or nothing; 128 to 159 are read as Windows-1252.
    """
    full, short, bare = _references()

    def named(piece: Column) -> Column:
        def whole(ref: Column) -> Column:
            known = F.try_element_at(F.try_element_at(full, F.substring(ref, 1, 1)), ref)
            return F.concat(known, F.substr(piece, F.length(ref) + 1))

        def prefix(ref: Column) -> Column:
            return F.concat(F.try_element_at(short, ref), F.substr(piece, F.length(ref) + 1))

        return F.coalesce(
            let(F.regexp_extract(piece, r"^([^\t\n\f <&#;]{1,32};)", 1), whole),
            let(F.regexp_extract(piece, bare, 1), prefix),
        )

    def resolve(piece: Column) -> Column:
        # The usual four come first.
        text = F.when(piece.startswith("amp;"), F.concat(F.lit("&"), F.substr(piece, F.lit(5))))
        for name, char in (("lt;", "<"), ("gt;", ">"), ("quot;", '"')):
            rest = F.substr(piece, F.lit(len(name) + 1))
            text = text.when(piece.startswith(name), F.concat(F.lit(char), rest))
        text = text.when(piece.startswith("#"), _numeric(piece)).otherwise(named(piece))
        return F.coalesce(text, F.concat(F.lit("&"), piece))

    def joined(pieces: Column) -> Column:
        rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), resolve)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))

    # Bound once: what is decoded is often the end of a long expression.
    return let(
        col,
        lambda c: F.when(~F.contains(c, F.lit("&")), c).otherwise(let(F.split(c, "&"), joined)),
    )


def without_invisible(html: Column) -> Column:
    """Drop comments, scripts, styles and templates."""
    return F.regexp_replace(html, INVISIBLE, "<!>")


def text_nodes(html: Column) -> Column:
    """Trimmed non-empty text nodes in document order, as an array."""
    raw = F.split(without_invisible(html), rf"(?:{TAG}|<!>)++")
    return F.filter(F.transform(raw, lambda t: strip(decode_entities(t))), lambda t: t != "")


def strip_markup(html: Column) -> Column:
    """Text of a fragment: trimmed text nodes joined by one space."""
    return F.array_join(text_nodes(html), " ")


def visible_text(html: Column) -> Column:
    """``strip_markup`` with every inner whitespace run reduced to one space."""
    return collapse_whitespace(strip_markup(html))


def _pieces(html: Column, tags: list[str]) -> Column:
    """The html cut before each start and end tag of ``tags``."""
    return F.split(html, rf"(?=</?(?i:{'|'.join(tags)})[\s/>])")


def _tag_name(piece: Column, tags: list[str]) -> Column:
    """Lower-case name of the tag a piece begins with, ``/name`` for an end tag; else ''."""
    return F.lower(F.regexp_extract(piece, rf"^<(/?(?i:{'|'.join(tags)}))[\s/>]", 1))


def _int(value: int) -> Column:
    return F.lit(value).cast("int")


def inner(html: Column, tag: str) -> Column:
    """Inside of the first ``<tag>``; up to the end when it is never closed.

    Comments and scripts are dropped first; elements of the same name inside
    it are counted, so the end tag is its own.
    """

    def cut(pieces: Column) -> Column:
        # Where it starts and ends, in one pass over the pieces.
        begin = F.struct(
            _int(0).alias("at"), _int(0).alias("depth"), _int(-1).alias("start"), _int(-1).alias("end")
        )

        def step(s: Column, piece: Column) -> Column:
            name = _tag_name(piece, [tag])
            depth = s["depth"] + F.when(name == tag, 1).when(
                (name == f"/{tag}") & (s["depth"] > 0), -1
            ).otherwise(0)
            opens = (name == tag) & (s["start"] < 0)
            closes = (s["start"] >= 0) & (s["end"] < 0) & (depth == 0)
            return F.struct(
                (s["at"] + 1).cast("int").alias("at"),
                depth.cast("int").alias("depth"),
                F.when(opens, s["at"]).otherwise(s["start"]).alias("start"),
                F.when(closes, s["at"]).otherwise(s["end"]).alias("end"),
            )

        def inside(s: Column) -> Column:
            end = F.when(s["end"] >= 0, s["end"]).otherwise(s["at"])
            own = F.array_join(F.slice(pieces, s["start"] + 1, end - s["start"]), "")
            return F.when(s["start"] >= 0, F.regexp_replace(own, rf"^{TAG}", ""))

        return let(F.aggregate(pieces, begin, step), inside)

    return let(_pieces(without_invisible(html), [tag]), cut)


def without_tags(html: Column, tags: list[str]) -> Column:
    """Drop whole elements, contents and elements of the same name in them included.

    An element that is never closed goes on to the end.
    """

    def cut(pieces: Column) -> Column:
        # Inside an element only its own name counts. A run is (first piece
        # kept, first dropped); a run after an end tag begins with that tag.
        run = F.struct(_int(0).alias("from"), _int(0).alias("to"))
        none = F.slice(F.array(run), 1, 0)
        begin = F.struct(
            _int(0).alias("at"), F.lit("").alias("name"), _int(0).alias("depth"),
            _int(0).alias("kept"), none.alias("runs"),
        )

        # Adding to a list copies it: each stretch of pieces fills a short list of
        # its own, and there are no more stretches than pieces in one.
        stretch = F.greatest(F.ceil(F.sqrt(F.size(pieces))), F.lit(16)).cast("int")

        def fold(s: Column, first: Column) -> Column:
            fresh = F.struct(*[s[c].alias(c) for c in ("at", "name", "depth", "kept")], none.alias("runs"))
            own = F.aggregate(F.slice(pieces, first, stretch), fresh, step)
            return let(own, lambda o: F.struct(
                *[o[c].alias(c) for c in ("at", "name", "depth", "kept")],
                F.concat(s["runs"], o["runs"]).alias("runs"),
            ))

        def step(s: Column, piece: Column) -> Column:
            def moved(name: Column) -> Column:
                free = s["depth"] == 0
                opens = free & (name != "") & ~name.startswith("/")
                deeper = ~free & (name == s["name"])
                closes = ~free & (name == F.concat(F.lit("/"), s["name"]))
                depth = s["depth"] + F.when(opens | deeper, 1).when(closes, -1).otherwise(0)
                done = F.struct(s["kept"].alias("from"), s["at"].alias("to"))
                return F.struct(
                    (s["at"] + 1).cast("int").alias("at"),
                    F.when(opens, name).otherwise(s["name"]).alias("name"),
                    depth.cast("int").alias("depth"),
                    F.when(closes & (depth == 0), s["at"]).otherwise(s["kept"]).alias("kept"),
                    F.when(opens, F.concat(s["runs"], F.array(done))).otherwise(s["runs"]).alias("runs"),
                )

            return let(_tag_name(piece, tags), moved)

        def joined(s: Column) -> Column:
            last = F.array(F.struct(s["kept"].alias("from"), s["at"].alias("to")))
            runs = F.when(s["depth"] == 0, F.concat(s["runs"], last)).otherwise(s["runs"])
            texts = F.transform(
                runs, lambda r: F.array_join(F.slice(pieces, r["from"] + 1, r["to"] - r["from"]), "")
            )
            # Each run but the first begins with the end tag of what was dropped.
            ends = rf"^</(?i:{'|'.join(tags)})\s*[^>]*>"
            rest = F.transform(
                F.slice(texts, F.lit(2), F.size(texts)), lambda t: F.regexp_replace(t, ends, "")
            )
            return F.concat(F.get(texts, F.lit(0)), F.array_join(rest, ""))

        starts = F.sequence(F.lit(1), F.size(pieces), stretch)
        return let(F.aggregate(starts, begin, fold), joined)

    return let(html, lambda h: F.when(h == "", h).otherwise(let(_pieces(h, tags), cut)))


_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'<>]++)"


def _before(name: str) -> str:
    """Pattern of the attributes before ``name``; loops that give nothing back don't recurse."""
    return rf"(?:\s++(?!(?i:{name})\s*+=)[^\s\"'<>=]++(?:\s*+=\s*+{_VALUE})?+)*+"


def hrefs(html: Column) -> Column:
    """Trimmed ``href`` of every anchor in order, entities resolved."""
    pattern = rf"<[aA]{_before('href')}\s++(?i:href)\s*+=\s*+({_VALUE})"
    found = F.regexp_extract_all(without_invisible(html), F.lit(pattern), 1)
    return F.transform(
        found, lambda h: strip(decode_entities(F.btrim(h, F.lit("\"'"))))
    )


def _without_dots(path: Column) -> Column:
    """A path with its dot segments taken, folded over a stack of segments."""

    def step(stack: Column, segment: Column) -> Column:
        shorter = F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))
        return (
            F.when(segment == "..", shorter)
            .when(segment == ".", stack)
            .otherwise(F.concat(stack, F.array(segment)))
        )

    def folded(segments: Column) -> Column:
        stack = F.aggregate(segments, F.array().cast("array<string>"), step)
        last = F.element_at(segments, -1).isin(".", "..")
        out = F.array_join(F.when(last, F.concat(stack, F.array(F.lit("")))).otherwise(stack), "/")
        return F.when(out.startswith("/"), out).otherwise(F.concat(F.lit("/"), out))

    # Most paths have none.
    dotted = path.rlike(r"(?:^|/)\.\.?(?:/|$)")
    return F.when(dotted, let(F.split(path, "/"), folded)).otherwise(path)


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve a reference against its page (RFC 3986).

    A dot segment above the root is dropped. A reference with a scheme or a
    host of its own stays as it is.
    """
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    site = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*/)", 1)
    page = F.regexp_extract(base, r"^([^#]*)", 1)
    own = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.substr(href, F.length(own) + 1)
    folder = F.coalesce(F.nullif(path, F.lit("")), F.lit("/"))
    # Empty segments inside a merged path fall away with the dots.
    merged = F.regexp_replace(F.concat(folder, own), "/{2,}", "/")
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(site, _without_dots(own), rest))
        .when(href.startswith("#"), F.concat(page, href))
        .when(href.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), href))
        .otherwise(F.concat(site, _without_dots(merged), rest))
    )


def block_texts(html: Column) -> Column:
    """Text of each block-level piece in order; empty pieces are dropped."""
    marked = F.regexp_replace(
        without_invisible(html), rf"(</?(?i:{BLOCK_TAGS})[\s/>])", f"{BLOCK_MARK}$1"
    )
    return F.filter(
        F.transform(F.split(marked, BLOCK_MARK), visible_text), lambda t: t != ""
    )


# What the start and the end of an element turn into.
_MARKS = {
    "b": "**", "strong": "**", "/b": "**", "/strong": "**",
    "i": "*", "em": "*", "/i": "*", "/em": "*",
    "code": "`", "/code": "`",
    "pre": "\n\n```\n", "/pre": "\n```\n\n",
    "br": "  \n", "hr": "\n\n---\n\n",
    "li": "\n* ", "blockquote": "\n\n> ", "/blockquote": "\n\n",
    "h1": "\n\n# ", "h2": "\n\n## ", "h3": "\n\n### ",
    "h4": "\n\n#### ", "h5": "\n\n##### ", "h6": "\n\n###### ",
}
_PARAGRAPH = ["p", "div", "section", "article", "ul", "ol", "table", "figure"]
_ROW = ["tr", "td", "th"]
_HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
# These swallow the blanks that follow their start tag.
_OPENERS = [*_HEADINGS, "li", "blockquote"]
_START, _STOP = "\x01", "\x02"
_LINK, _LABEL, _UNLINK = "\x03", "\x04", "\x05"


def _mark(name: Column) -> Column:
    """Markdown for one tag name (``/name`` for an end tag)."""
    breaks = [*_PARAGRAPH, *("/" + t for t in (*_PARAGRAPH, *_HEADINGS))]
    rows = [*_ROW, *("/" + t for t in _ROW)]
    marks = _MARKS | dict.fromkeys(breaks, "\n\n") | dict.fromkeys(rows, "\n")
    table = F.create_map(*[F.lit(x) for pair in marks.items() for x in pair])
    return F.coalesce(F.try_element_at(table, name), F.lit(""))


def to_markdown(html: Column) -> Column:
    """Light Markdown: headings, emphasis, links, lists, code, paragraphs.

    Tables lose their grid; their cells stay as lines of text. All tags are
    found in one pass and then rendered piece by piece.
    """
    text = F.regexp_replace(without_invisible(html), "<!>", "")
    # Source line breaks are layout only; keep them where there is a <pre>.
    text = let(
        text,
        lambda t: F.when(t.rlike(r"<(?i:pre)\b"), t).otherwise(
            F.regexp_replace(t, SPACE_RUN, " ")
        ),
    )
    attribute = r"\s*+=\s*+[\"']?([^\"'<>\s]*+)[\"']?[^<>]*+>"
    # A link is put together when all tags are gone: address, text, end.
    text = F.regexp_replace(
        text, rf"<[aA]{_before('href')}\s++(?i:href){attribute}", f"{_LINK}$1{_LABEL}"
    )
    text = F.regexp_replace(text, r"</[aA]\s*>", _UNLINK)
    text = F.regexp_replace(text, rf"<(?i:img){_before('src')}\s++(?i:src){attribute}", "![]($1)")
    tag = r"<(/?[a-zA-Z][a-zA-Z0-9]*+)(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>|<[!?][^<>]*+>"
    text = F.regexp_replace(text, tag, f"{_START}$1{_STOP}")

    def rendered(piece: Column) -> Column:
        def with_name(name: Column) -> Column:
            rest = F.substr(piece, F.length(name) + 2)
            rest = F.when(name.isin([*_OPENERS, "/li"]), F.ltrim(rest)).otherwise(rest)
            return F.concat(_mark(name), rest)

        return F.when(
            piece.contains(_STOP), let(F.lower(F.substring_index(piece, _STOP, 1)), with_name)
        ).otherwise(piece)

    text = F.array_join(F.transform(F.split(text, _START), rendered), "")
    link = f"{_LINK}([^{_LABEL}]*){_LABEL}([^{_LINK}{_UNLINK}]*){_UNLINK}"
    text = F.regexp_replace(text, link, "[$2]($1)")
    text = F.regexp_replace(text, f"{_LINK}[^{_LABEL}]*{_LABEL}|{_UNLINK}", "")
    text = decode_entities(text)
    text = F.regexp_replace(text, r"\n[ \t]+(?=\n)", "\n")
    return strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))
