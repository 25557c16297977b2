"""Fill-in-the-middle rearrangement, cut by an indexable skip list.

A text's units are words with the white space before them; white space at the
end of the text is one more. Two hashes of the row's id give two cut ranks; two
more decide whether the text is rearranged and in which order. Hashes, form and
pieces are column expressions; only the cuts are found in Python.

The skip list holds one text's units. A link of the lowest lane spans one unit;
a node of a lane goes on to the lane above by the toss of a hashed coin, so a
link there spans some units more. Each link carries its width in units and in
code points. A search starts in the top lane, follows links while they don't
pass the rank and goes down a lane where the next would; the widths it has
passed add up to the rank and to its place in the text, both exact. A lane is
two arrays, summed from the lane below; the lowest is filled block by block,
so of a very long text only the widths are held besides the text itself.

Defined cases: a NULL text is empty; an empty text, one that holds a marker and
one that the hash leaves out stay plain; a NULL doc_id is hashed as the empty
string; repeated rows get the same result each; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 42
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE = 50  # texts rearranged, of 100
SUFFIX_FIRST = 80  # of 100 rearranged ones

#: Code points looked at together; bounds the scratch memory of a long text.
BLOCK = 1 << 20
#: A lane this short has none above it.
SHORT_LANE = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)


def unit_widths(text: str) -> np.ndarray:
    """Code points in each unit of ``text``, from left to right."""
    widths, open_width, in_word = [], 0, False
    for at in range(0, len(text), BLOCK):
        # A lone surrogate has no UTF-8 form, but a width like any other.
        data = text[at : at + BLOCK].encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(data, np.uint32)
        word = ~((points == 32) | ((points >= 9) & (points <= 13)))
        # A unit ends where white space follows its word.
        before = np.concatenate([[in_word], word[:-1]])
        starts = np.flatnonzero(before & ~word)
        if len(starts):
            own = np.diff(starts, prepend=0)
            own[0] += open_width
            widths.append(own)
            open_width = len(points) - starts[-1]
        else:
            open_width += len(points)
        in_word = bool(word[-1])
    if open_width:
        widths.append(np.array([open_width]))
    return np.concatenate(widths).astype(np.int64) if widths else np.empty(0, np.int64)


class SkipList:
    """Express lanes over units; a lane is (units, code points, node below) per link."""

    def __init__(self, widths: np.ndarray):
        self.n = len(widths)
        self.lanes = [(np.ones(self.n, np.int64), widths, np.arange(self.n))]
        while len(widths) > SHORT_LANE:
            units, widths, _ = self.lanes[-1]
            toss = np.arange(len(units), dtype=np.uint64) + np.uint64(len(self.lanes) << 40)
            toss = (toss * _MIX) >> np.uint64(62)
            toss[0] = 0  # the head is in every lane
            tall = np.flatnonzero(toss == 0)
            if len(tall) == len(units):
                break
            widths = np.add.reduceat(widths, tall)
            self.lanes.append((np.add.reduceat(units, tall), widths, tall))

    def offset(self, rank: int) -> int:
        """Code points before the unit of this rank, 0 to n."""
        passed = place = node = 0
        for units, points, below in reversed(self.lanes):
            while node < len(units) and passed + units[node] <= rank:
                passed += int(units[node])
                place += int(points[node])
                node += 1
            if passed == rank:
                break
            node = int(below[node])
        return place


def _cuts(texts: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
    rows = []
    for text, a, b in zip(texts, first, second, strict=True):
        units = SkipList(unit_widths(text))
        low, high = sorted((int(a) % (units.n + 1), int(b) % (units.n + 1)))
        start = units.offset(low)
        rows.append((units.n, start, units.offset(high) - start))
    return pd.DataFrame(rows, columns=["n", "prefix_chars", "middle_chars"])


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""

    def between(left, right):
        return F.substring_index(F.substring_index(output, left, -1), right, 1)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def rearrange(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row; no shuffle."""
    cuts = F.pandas_udf(_cuts, "n bigint, prefix_chars bigint, middle_chars bigint")
    own_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), own_id).cast("binary"), 256)
    hashes = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
    rows = docs.select(
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
        *[h.alias(f"h{k + 1}") for k, h in enumerate(hashes)],
    ).withColumn("cuts", cuts("text", "h1", "h2"))

    text = F.col("text")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    plain = (text == "") | marked | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm")
    # A text is shorter than 2^31 bytes.
    start, width = (F.col(f"cuts.{x}").cast("int") for x in ("prefix_chars", "middle_chars"))
    prefix = text.substr(F.lit(1), start)
    middle = text.substr(start + 1, width)
    suffix = text.substr(start + width + 1, F.lit(2**31 - 1))
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    named = rows.withColumn("form", form)
    return named.select(
        "doc_id",
        F.col("cuts.n").alias("n"),
        "form",
        F.when(F.col("form") != "plain", F.col("cuts.prefix_chars")).alias("prefix_chars"),
        F.when(F.col("form") != "plain", F.col("cuts.middle_chars")).alias("middle_chars"),
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(text)
        .alias("output"),
    )
