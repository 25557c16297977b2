"""How five filters overlap: Shapley shares by exact constrained least squares.

Each document gets one bit per filter that it fails. Counting documents by part
and bits (at most 32 rows a part) is all that the corpus is read for. From them
the removals of all 32 coalitions of filters are tabulated. The Shapley values
of a part solve a least-squares problem over these: an additive game with one
share per filter that fits the removals of all coalitions, weighted by the
Shapley kernel (M - 1) / (C(M, s) s (M - s)), under the constraint that the
shares sum to the removals of all filters. Its normal equations, bordered by
the constraint, are solved in rationals, so the values are exact. What a step
of an order removes is the difference of two coalitions.

Filters: A under 200 words; B less than half of the words distinct; C over 3 %
capitals A-Z; D one of ``#$%&*|``; E a text that a smaller doc_id has too.

Copies: rows are counted by id and text hash, then by text hash, before the
smallest id of a text meets them, so a text of any number of copies is a few
rows there. Labels of an id are joined once, after that count.

Defined cases: a NULL text is empty and equal to other empty ones; a NULL
doc_id is no smaller or larger id, so it never fails E nor makes others fail,
and has no label; rows with the same id and text don't fail E by each other;
several labels of one id count if any of them says 1; a NULL lang is the part
of the empty string; an empty table gives no row.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations, permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # percent of the words
MOST_CAPITALS = 3  # percent of the code points
SYMBOLS = "[#$%&*|]"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

EARLIER = 1 << FILTERS.index("E")
COALITIONS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def own_failures(text: Column, words: Column) -> Column:
    """Bits of the filters that a text fails by itself: A is bit 0, D bit 3."""
    n, kinds = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    tests = [
        n < LEAST_WORDS,
        kinds * 100 < n * LEAST_DISTINCT,
        capitals.cast("long") * 100 > F.length(text).cast("long") * MOST_CAPITALS,
        text.rlike(SYMBOLS),
    ]
    return sum((F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(tests)), F.lit(0))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents by the filters they fail."""
    text = F.col("text")
    split = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    # Only a hash of each text and its bits are shuffled.
    rows = split.select(
        "doc_id",
        "part",
        F.sha2(text.cast("binary"), 256).alias("hash"),
        own_failures(text, F.col("words")).alias("bits"),
    )
    counted = rows.groupBy("doc_id", "part", "hash", "bits").agg(F.count(F.lit(1)).alias("n"))
    # A row without an id has a key of its own: NULLs would all meet in one task.
    key = F.coalesce(F.col("doc_id").cast("string"), F.col("hash"))
    marks = labels.groupBy(F.col("doc_id").cast("bigint").cast("string").alias("key")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    named = counted.withColumn("key", key).join(marks, "key", "left")
    group = [F.coalesce(x, F.lit(0)).alias(x) for x in ("good", "toxic")]
    copies = named.groupBy("hash", "part", "bits", *group).agg(
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("at_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("without"),
        F.sum("n").alias("n"),
    )
    # Of one text a row per part and labels is left, however many copies it has.
    first = F.min("least").over(Window.partitionBy("hash"))
    met = copies.withColumn("first", first)
    smallest = F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    dealt = met.withColumn("stay", F.col("without") + smallest).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct("bits", F.col("stay").alias("n")),
                F.struct((F.col("bits") + EARLIER).alias("bits"), (F.col("n") - F.col("stay")).alias("n")),
            )
        ).alias("d"),
    )
    n = F.col("d.n")
    return (
        dealt.where(n > 0)
        .groupBy("part", F.col("d.bits").alias("bits"))
        .agg(
            F.sum(n).alias("n"),
            F.sum(n * F.col("good")).alias("good"),
            F.sum(n * F.col("toxic")).alias("toxic"),
        )
    )


def removals(by_bits: dict[int, int]) -> list[int]:
    """Documents that each coalition removes: those that fail one of its filters."""
    return [sum(n for bits, n in by_bits.items() if bits & c) for c in range(COALITIONS)]


def solved(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Gauss-Jordan elimination in rationals."""
    rows = [[*row, x] for row, x in zip(matrix, right, strict=True)]
    size = len(rows)
    for k in range(size):
        pivot = next(i for i in range(k, size) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(size):
            if i != k and rows[i][k]:
                rows[i] = [x - rows[i][k] * y for x, y in zip(rows[i], rows[k], strict=True)]
    return [row[-1] for row in rows]


def shapley(removed: list[int], size: int = len(FILTERS)) -> list[Fraction]:
    """Shapley values of the game ``removed`` (by coalition bits)."""
    normal = [[Fraction(0)] * size for _ in range(size)]
    right = [Fraction(0)] * size
    for s in range(1, size):
        weight = Fraction(size - 1, comb(size, s) * s * (size - s))
        for members in combinations(range(size), s):
            value = removed[sum(1 << i for i in members)]
            for i in members:
                right[i] += weight * value
                for j in members:
                    normal[i][j] += weight
    # The border: shares sum to what all filters remove; the last is its multiplier.
    bordered = [[*row, Fraction(1)] for row in normal]
    bordered.append([*([Fraction(1)] * size), Fraction(0)])
    return solved(bordered, [*right, Fraction(removed[(1 << size) - 1])])[:size]


_NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
          "good_lost", "toxic_lost", "shapley"]
_KINDS = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def part_rows(part: str, counts: list[dict]) -> list[tuple]:
    """All orders and steps of one part, from its counts by bits."""
    total = sum(c["n"] for c in counts)
    all_, good, toxic = (
        removals({c["bits"]: c[name] for c in counts}) for name in ("n", "good", "toxic")
    )
    size = len(FILTERS)
    shares = [x * factorial(size) for x in shapley(all_)]
    rows = []
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << FILTERS.index(letter)
            after = before | own
            here = all_[after] - all_[before]
            share = shares[FILTERS.index(letter)]
            rows.append(
                (part, order, step, total - all_[after], here, all_[own] - here,
                 all_[-1] - all_[COALITIONS - 1 - own], good[after] - good[before],
                 toxic[after] - toxic[before], share.numerator // share.denominator)
            )
            before = after
    return rows


def _reported(batches):
    for batch in batches:
        for row in batch.to_pylist():
            columns = zip(*part_rows(row["part"], row["counts"]), strict=True)
            arrays = [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, _NAMES)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; counts of documents.

    kept, removed, redundant, unique_fails, good_lost, toxic_lost, and shapley:
    the Shapley value times the number of orders, an integer.
    """
    # At most 32 rows of a part come together.
    parts = failure_counts(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("counts")
    )
    return parts.mapInArrow(_reported, SCHEMA)
