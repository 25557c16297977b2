"""A training corpus from ``documents``: the stages, in order.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns rows with the columns of ``documents``; the last returns packed
sequences. Between stages the rows are written to the shared folder and read
again, so a lost executor repeats tasks of one stage only.

No SQL can express the stages (a trained classifier, a trained tagger, a
tokenizer); tests/llm compares their rows with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from broadsheet.llm import stages
from broadsheet.llm.common import documents, release, scratch_mark, take_scratch, written

STAGES = [
    ("language", stages.language),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("redact", stages.redact),
    ("pack", stages.pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; the packed pieces.

    Once a stage is written, its input is deleted.
    """
    docs, before = documents(spark, sf_dir), []
    for name, stage in STAGES:
        since = scratch_mark()
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        release(spark, before)
        before = take_scratch(since)
    return docs
