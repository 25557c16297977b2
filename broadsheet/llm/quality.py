"""Quality rules with thresholds learnt per language and source.

Each text is measured once. The measures of all documents go into mergeable
quantile sketches, one per (language, source, measure): counts of logarithmic
buckets with a relative error of about 1 %, which add up in any order, so the
result does not depend on partitioning or retries. A document is dropped when
a measure lies beyond its group's upper fence, the 90 % quantile plus ``FENCE``
times its distance from the median, or below the lower fence, made of the 10 %
quantile likewise, for the measures with ``low``. So a tenth of a group may be
junk without moving its own fence far. Only rounding is allowed for: the
sketch's error, and one unit of a count, so that a single symbol or line is no
reason in a group that has none. A group's quantiles are merged with those of
its language, and these with those of all rows, as if ``PRIOR_ROWS`` rows more had
been seen there: a group of few rows leans on the wider ones, one of many hardly
does, and no number of rows changes the rule.

Hot groups cost a row per bucket and task: sketches are summed before the
shuffle. The thresholds are joined back to the measures, without the texts.

Defined cases: a NULL or empty text has no words and fails the base rule; a
NULL language or source is a group of its own; repeated rows count each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import written

SYMBOLS = re.compile(r"[#*$%&|<>]")
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_WORDS = 50
ERROR = 0.01
FENCE = 6.0
#: Rows that the wider group's quantiles count for in a merge.
PRIOR_ROWS = 20

_SCHEMA = (
    "doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, "
    "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_upper bigint"
)


@dataclass(frozen=True)
class Measure:
    name: str
    value: Column
    low: bool = False
    #: What one unit less of its count would give.
    less: Column | None = None


def measures() -> list[Measure]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))

    def share(name: str, count: str, of: Column) -> Measure:
        return Measure(name, F.col(count) / of, less=(F.col(count) - 1) / of)

    return [
        Measure("word_length", F.col("word_chars") / words, low=True),
        share("symbol_share", "n_symbols", words),
        share("upper_share", "n_upper", words),
        share("duplicate_line_share", "n_dup_lines", lines),
        share("repeat_share", "n_repeat_words", words),
    ]


def measure_text(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper."""
    data = text.encode()
    words = data.split()
    n = len(words)
    # Code points in words: all but the six white-space characters.
    chars = len(text) - sum(map(text.count, " \t\n\r\f\v"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeated = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            counts = Counter(windows)
            covered = -1  # the last word counted
            for i, w in enumerate(windows):
                if counts[w] > 1:
                    repeated += i + 2 - max(covered, i - 1)
                    covered = i + 2
    upper = len(data) - len(data.translate(None, UPPER))
    return n, chars, len(SYMBOLS.findall(text)), dup, repeated, len(lines), upper


def _measured(batches):
    for batch in batches:
        rows = [measure_text(x or "") for x in batch.column("text").to_pylist()]
        columns = zip(*rows, strict=True) if rows else [()] * 7
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("doc_id", "lang", "source")]
            + [pa.array(list(c), pa.int64()) for c in columns],
            ["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
             "n_repeat_words", "n_lines", "n_upper"],
        )


def bucket(value: Column) -> Column:
    """Bucket of a logarithmic sketch; values up to ``ERROR`` share bucket 0."""
    gamma = math.log((1 + ERROR) / (1 - ERROR))
    over = F.ceil(F.log(value / ERROR) / gamma).cast("int")
    return F.when(value <= ERROR, F.lit(0)).otherwise(over)


def bucket_value(b: Column) -> Column:
    """The value that stands for a bucket, within the relative error."""
    gamma = (1 + ERROR) / (1 - ERROR)
    return F.when(b == 0, F.lit(0.0)).otherwise(
        F.lit(ERROR) * F.pow(F.lit(gamma), b) * (2 / (1 + gamma))
    )


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, rows): the sketch of each group."""
    entries = F.array(
        *[F.struct(F.lit(m.name).alias("measure"), bucket(m.value).alias("bucket")) for m in measures()]
    )
    each = measured.select("lang", "source", F.explode(entries).alias("e"))
    return each.groupBy("lang", "source", "e.measure", "e.bucket").agg(
        F.count(F.lit(1)).alias("rows")
    )


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Median and outer tenths of the sketches merged by ``keys``; null-safe keys."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("rows").alias("rows"))
    # A group has a bounded number of buckets, however many rows it sums up.
    order = Window.partitionBy(*keys, "measure").orderBy("bucket")
    whole = Window.partitionBy(*keys, "measure")
    below = merged.withColumn("upto", F.sum("rows").over(order)).withColumn(
        "total", F.sum("rows").over(whole)
    )

    def at(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= q * F.col("total"), bucket_value(F.col("bucket"))))

    return below.groupBy(*keys, "measure").agg(
        F.max("total").alias("total"), at(0.1).alias("p10"), at(0.5).alias("q2"), at(0.9).alias("p90"),
    )


def merged(own: str, wider: Column, prior: int) -> Column:
    """Quantiles of a group with those of the wider one, weighted by rows."""
    weight = F.col(f"{own}.total") / (F.col(f"{own}.total") + prior)
    names = ("p10", "q2", "p90")
    return F.struct(
        *[(F.col(f"{own}.{x}") * weight + wider[x] * (1 - weight)).alias(x) for x in names]
    )


def thresholds(sketch: DataFrame, prior: int = PRIOR_ROWS, fence: float = FENCE) -> DataFrame:
    """(lang, source, measure, low, high): the fences of each group."""
    levels = []
    for k, keys in enumerate((["lang", "source"], ["lang"], [])):
        found = quantiles(sketch, keys)
        stats = F.struct("total", "p10", "q2", "p90").alias(f"level{k}")
        levels.append((keys, found.select(*keys, "measure", stats)))
    out = levels[0][1]
    for keys, found in levels[1:]:
        right = found.select(*[F.col(k).alias(f"r_{k}") for k in keys], F.col("measure").alias("r_measure"), found.columns[-1])
        same = F.col("measure") == F.col("r_measure")
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"r_{k}"))
        out = out.join(right, same).drop("r_measure", *[f"r_{k}" for k in keys])
    lows = [m.name for m in measures() if m.low]
    both = merged("level0", merged("level1", F.col("level2"), prior), prior)
    out = out.select("lang", "source", "measure", both.alias("s"))
    up = F.col("s.p90") + fence * (F.col("s.p90") - F.col("s.q2"))
    down = F.col("s.p10") - fence * (F.col("s.q2") - F.col("s.p10"))
    return out.select(
        "lang", "source", "measure",
        (up * (1 + 2 * ERROR) + ERROR).alias("high"),
        F.when(F.col("measure").isin(*lows), down * (1 - 2 * ERROR) - ERROR).alias("low"),
    )


def judge(docs: DataFrame) -> DataFrame:
    """The measures of each document, base_failed and kept."""
    rows = docs.select(
        F.col("doc_id").cast("bigint"), F.col("lang").cast("string"),
        F.col("source").cast("string"), "text",
    )
    measured = written(rows.mapInArrow(_measured, _SCHEMA), "quality-measures")
    fences = thresholds(sketches(measured))
    wide = fences.groupBy("lang", "source").agg(
        F.map_from_entries(F.collect_list(F.struct("measure", F.struct("low", "high")))).alias("fences")
    )  # one entry per measure
    right = wide.select(F.col("lang").alias("r_lang"), F.col("source").alias("r_source"), "fences")
    same = F.col("lang").eqNullSafe(F.col("r_lang")) & F.col("source").eqNullSafe(F.col("r_source"))
    joined = measured.join(right, same)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    outside = F.lit(False)
    for m in measures():
        fence = F.col("fences")[m.name]
        outside |= (m.value if m.less is None else m.less) > fence["high"]
        if m.low:
            outside |= m.value < fence["low"]
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~outside).alias("kept"),
    )
