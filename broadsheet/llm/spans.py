"""Digest columns of span lists: counts, text form, hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def digests(spans: Column, kinds: list[str]) -> list[Column]:
    """n_<kind> of each base kind, base_sha256, spans."""
    base = base_only(spans)

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")

    return [
        *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(spans).alias("spans"),
    ]


def apart(found: list[tuple], busy: list[tuple[int, int]]) -> list[tuple]:
    """Those of ``found`` (start, end, ...) that touch none of ``busy`` (start, end).

    ``found`` comes by start, without overlaps; one sweep over both.
    """
    kept, held, at = [], merged(busy), 0
    for span in found:
        while at < len(held) and held[at][1] <= span[0]:
            at += 1
        if at == len(held) or held[at][0] >= span[1]:
            kept.append(span)
    return kept


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans as one, by start."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
