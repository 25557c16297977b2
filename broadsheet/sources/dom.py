"""Element selection where a regular expression is unsafe (nested tags).

Only the few page layouts that need nesting go through this Arrow-batched
helper; everything else stays in ``broadsheet.functions.markup``.
"""

from __future__ import annotations

import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Python workers get this helper with the job; nothing to install there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODES = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("classes", T.ArrayType(T.StringType())),
            T.StructField("html", T.StringType()),
        ]
    )
)

# Elements that have no end tag.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


class _Spans(HTMLParser):
    """Offsets of every element: tag, attributes, depth, inner and outer span."""

    def __init__(self, text: str) -> None:
        super().__init__(convert_charrefs=False)
        self._at = 0
        self.spans: list[list] = []
        self._open: list[int] = []
        self._names: dict[str, int] = {}  # how many of each name are open
        self.feed(text)
        self.close()
        for index in self._open:
            self.spans[index][4] = self.spans[index][5] = len(text)

    def updatepos(self, i: int, j: int) -> int:
        """Keeps the offset in the text in place of line and column."""
        self._at += max(0, j - i)
        return j

    def handle_starttag(self, tag: str, attrs: list) -> None:
        start = self._at
        end = start + len(self.get_starttag_text())
        self.spans.append([tag, dict(attrs), len(self._open), start, end, end, end])
        if tag not in VOID:
            self._open.append(len(self.spans) - 1)
            self._names[tag] = self._names.get(tag, 0) + 1

    def _close_last(self) -> int:
        index = self._open.pop()
        self._names[self.spans[index][0]] -= 1
        return index

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close_last()

    def handle_endtag(self, tag: str) -> None:
        if not self._names.get(tag):
            return
        at = self._at
        while True:
            index = self._close_last()
            self.spans[index][4] = at
            if self.spans[index][0] == tag:
                self.spans[index][5] = at + len(tag) + 3
                return
            self.spans[index][5] = at


def _select(text: str | None, tag: str | None, wanted: dict[str, str]) -> list[str] | None:
    if text is None:
        return None
    found = []
    for name, attrs, _, _, inner_end, _, inner_start in _Spans(text).spans:
        if tag and name != tag:
            continue
        classes = (attrs.get("class") or "").split()
        if all(
            v in classes if k == "class" else attrs.get(k) == v for k, v in wanted.items()
        ):
            found.append(text[inner_start:inner_end])
    return found


def _children(text: str | None) -> list[dict] | None:
    if text is None:
        return None
    nodes, at = [], 0
    for name, attrs, depth, start, _, end, _ in _Spans(text).spans:
        if depth or start < at:
            continue
        if start > at:
            nodes.append({"name": None, "classes": [], "html": text[at:start]})
        nodes.append(
            {"name": name, "classes": (attrs.get("class") or "").split(), "html": text[start:end]}
        )
        at = end
    if at < len(text):
        nodes.append({"name": None, "classes": [], "html": text[at:]})
    return nodes


def select_inner(html: Column, tag: str | None = None, **attrs: str) -> Column:
    """Inner HTML of every matching element in document order.

    ``class_`` matches one of the element's classes, other names whole values.
    """
    wanted = {k.rstrip("_"): v for k, v in attrs.items()}

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(lambda text: _select(text, tag, wanted))

    return run(html)


@F.pandas_udf(NODES)
def child_nodes(batch: pd.Series) -> pd.Series:
    """Direct children of a fragment; text nodes have no name."""
    return batch.map(_children)


def first_children(html: Column, tag: str, **attrs: str) -> Column:
    """Direct children of the first element that ``select_inner`` would give."""
    wanted = {k.rstrip("_"): v for k, v in attrs.items()}

    @F.pandas_udf(NODES)
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(lambda text: _children(next(iter(_select(text, tag, wanted) or []), None)))

    return run(html)


def _without_styled(text: str | None, markers: list[str]) -> str | None:
    if text is None:
        return None
    kept, at = [], 0
    for _, attrs, _, start, _, end, _ in _Spans(text).spans:
        style = (attrs.get("style") or "").lower()
        if start >= at and any(marker in style for marker in markers):
            kept.append(text[at:start])
            at = end
    return "".join(kept) + text[at:]


def without_styled(html: Column, markers: list[str]) -> Column:
    """Drop every element whose inline style holds one of the markers."""

    @F.pandas_udf(T.StringType())
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(lambda text: _without_styled(text, markers))

    return run(html)
