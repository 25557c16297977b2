"""Outcome of a run, per source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the error of a source that gave nothing.
NO_ITEMS = "no items returned"


def run_report(
    sources: DataFrame, fetched: DataFrame, stored: DataFrame, errors: DataFrame | None = None
) -> DataFrame:
    """Fetched and stored counts of every source; nothing fetched is a failure.

    ``fetched`` and ``stored`` only need a ``source_id`` column; a failing
    source never stops the others. Ranked sources store what they fetch.
    ``errors`` (source_id, error) says why a source gave nothing; of several
    the first by text is shown.
    """
    got = fetched.groupBy("source_id").agg(F.count(F.lit(1)).alias("fetched"))
    kept = stored.groupBy("source_id").agg(F.count(F.lit(1)).alias("stored"))
    joined = sources.join(got, "source_id", "left").join(kept, "source_id", "left")
    why = F.lit(NO_ITEMS)
    if errors is not None:
        told = errors.groupBy("source_id").agg(F.min("error").alias("told"))
        joined = joined.join(told, "source_id", "left")
        why = F.coalesce("told", why)
    ok = F.coalesce("fetched", F.lit(0)) > 0
    return joined.select(
        "source_id",
        F.when(ok, "success").otherwise("failure").alias("status"),
        F.when(ok, F.coalesce("fetched", F.lit(0))).alias("fetched"),
        F.when(
            ok,
            F.when(F.col("kind") == "aggregation", F.col("fetched")).otherwise(
                F.coalesce("stored", F.lit(0))
            ),
        ).alias("stored"),
        F.when(~ok, why).alias("error"),
    )
