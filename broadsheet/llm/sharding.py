"""Sharding: uniform shuffle with exact shard sizes.

The number of rows that each input partition sends to each shard is drawn
exactly (multivariate hypergeometric, without replacement from the shards'
free places), on the driver, from the partitions' row counts alone. Each
partition permutes its rows and deals them out by its counts. In its shard a
row goes to a random block of bounded size and is permuted again there; a
place in the shard is the block's first place plus the place in the block. A
random block and a random order in it make a uniform permutation of the shard,
so no task ever holds a shard.

Random orders come from a seeded hash of the row's place in the input, which
is written to the shared folder first: a repeated task deals the same rows.

Law ``rows``: shard row counts differ by one at most. Equal texts are placed
independently of each other. Defined cases: a NULL text has size 1 and crc32
0; NULL or repeated doc_ids are ordinary rows; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import UID, with_uid, written

SHARDS = 8
BLOCK_ROWS = 10_000
SEED = 7_919


def draw_count(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Hypergeometric: how many of ``n`` places drawn without replacement are good.

    Inversion over the ratios of neighbouring probabilities around the mode. It
    has no upper bound on the population; the range of 12 standard deviations
    leaves out less than one double can show.
    """
    low, high, total = max(0, n - bad), min(good, n), good + bad
    if low == high:
        return low
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    spread = n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1))
    width = int(12 * spread**0.5) + 20
    k = np.arange(max(low, mode - width), min(high, mode + width) + 1, dtype=np.float64)
    ratio = (good - k[:-1]) * (n - k[:-1]) / ((k[:-1] + 1) * (bad - n + k[:-1] + 1))
    log = np.concatenate([[0.0], np.cumsum(np.log(ratio))])
    mass = np.cumsum(np.exp(log - log.max()))
    return int(k[min(len(k) - 1, np.searchsorted(mass, rng.random() * mass[-1], side="right"))])


def draw_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each partition sends to each shard; sums are exact."""
    total = sum(counts)
    free = [total // shards + (s < total % shards) for s in range(shards)]
    rng = np.random.default_rng(seed)
    matrix = []
    for n in counts:
        own, left = [], n
        for s in range(shards):
            own.append(draw_count(rng, free[s], sum(free[s + 1 :]), left))
            left -= own[-1]
        free = [f - x for f, x in zip(free, own, strict=True)]
        matrix.append(own)
    return matrix


def shard(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of each row; slots of a shard have no gap."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = with_uid(docs.select(F.col("doc_id").cast("bigint"), "text")).select(
        UID,
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.shiftright(UID, 33).alias("part"),
    )
    placed = written(rows, "sharding-rows")
    # One number per input partition reaches the driver.
    found = placed.groupBy("part").count().collect()
    counts = {r["part"]: r["count"] for r in found}
    parts = sorted(counts)
    matrix = draw_matrix([counts[p] for p in parts], shards, seed)
    ends = [(p, np.cumsum(own).tolist()) for p, own in zip(parts, matrix, strict=True)]
    dealt = spark.createDataFrame(ends, "part bigint, ends array<bigint>")

    local = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), UID), UID)
    first = (
        placed.withColumn("place", F.row_number().over(local))
        .join(dealt, "part")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("place"))))
        .drop("part", "place", "ends")
    )
    blocks = max(1, -(-sum(counts.values()) // (shards * block_rows)))
    first = written(
        first.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), UID), F.lit(blocks))),
        "sharding-exchange",
    )
    # One row per block, a bounded number of documents each.
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        first.groupBy("shard", "block")
        .count()
        .select(
            "shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
        )
    )
    inside = Window.partitionBy("shard", "block").orderBy(F.xxhash64(F.lit(seed + 2), UID), UID)
    return (
        first.withColumn("slot", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "block"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.col("shard").cast("int").alias("shard"),
            (F.col("slot") + F.col("first")).cast("bigint").alias("slot"),
        )
    )
