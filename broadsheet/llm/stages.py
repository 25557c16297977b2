"""The stages of ``corpus_pipeline``: operators with their decisions carried out.

What a stage returns is written before the next one begins. So a stage first
deletes the scratch tables of the one before; run one pipeline at a time.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import decontamination, language_id, packing, pii
from broadsheet.llm import near_dedup as dedup
from broadsheet.llm.common import (
    UID,
    prepare,
    release,
    remainder,
    scratch_mark,
    take_scratch,
    with_uid,
    written,
)


_CELL = 32_768  # rows of one aggregated bitmap
_left: list[str] = []


def unused(docs: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def _stage(fn):
    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(prepare(spark), _left)
        _left.clear()
        since = scratch_mark()
        out = fn(spark, docs, sf_dir)
        _left.extend(take_scratch(since))
        return out

    return run


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages; learns from the rows that op9 learns from.

    Texts without a letter go, and so do texts that are foreign by the kernels:
    long enough to tell, and below the margins that learnt texts show for all
    languages. A low score alone is no reason: texts of a word or two are clean
    and can't score high. Where nothing can be learnt, every text with a letter
    stays.
    """
    model = language_id.train(docs.where(remainder(F.col("doc_id"), 5) != 0))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    made = unused(docs, "language", "score", "foreign")
    found = language_id.predict(docs, model, *made)
    kept = (F.col(made[0]) != language_id.UNDETERMINED) & ~F.col(made[2])
    return found.where(kept).select(*docs.columns)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    own = unused(docs, "kept-of-" + UID)[0]
    held = {c: f"{own}-{c}" for c in docs.columns if c.startswith("__")}
    rows = written(with_uid(docs.withColumnsRenamed(held)), "stage-numbered")
    dropped = dedup.near_duplicates(rows).where(~F.col("chosen")).select(UID)
    # One bit per row: what is joined to the texts is small, so they mostly stay.
    part, place = F.shiftright(UID, 33), F.col(UID).bitwiseAND(F.lit((1 << 33) - 1))
    cell = F.floor(place / _CELL).alias("cell")
    marked = dropped.groupBy(part.alias("part"), cell).agg(
        F.bitmap_construct_agg(place % _CELL).alias("__bits")
    )
    at = (place % _CELL).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    gone = F.coalesce(F.call_function("getbit", byte, at % 8) == 1, F.lit(False))
    placed = rows.withColumns({"__part": part, "__cell": F.floor(place / _CELL)})
    joined = placed.join(
        marked.select(F.col("part").alias("__part"), F.col("cell").alias("__cell"), "__bits"),
        ["__part", "__cell"], "left",
    )
    return joined.where(~gone).select(*[rows[held.get(c, c)].alias(c) for c in docs.columns])


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.clean(docs, items)


@_stage
def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs, pii.train(docs))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences: the pieces with their token ids."""
    return packing.pack(docs)
