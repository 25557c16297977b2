"""First and last sighting of each item as a stream.

State is one small row per item, kept while the item goes on being seen and for
``horizon`` after its last sighting; an event-time timer then closes it. An item
seen again later opens a new period, so memory follows the items of the last
``horizon`` and not all there ever were. ``seen_table`` makes of the rows of all
batches what the batch operator gives.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from broadsheet.operators.history import KEY, merge_seen

#: The state store that keyed state with timers needs.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

ROWS = (
    "source_id string, url string, opened timestamp, first_seen timestamp, last_seen timestamp, "
    "times_seen bigint, closed boolean"
)
_STATE = "opened bigint, first_seen bigint, last_seen bigint, times_seen bigint"


class Sightings(StatefulProcessor):
    """Times in the state are microseconds, those of timers milliseconds."""

    def __init__(self, horizon_ms: int):
        self.horizon_ms = horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", _STATE)

    def _due(self, last_seen: int) -> int:
        return last_seen // 1000 + self.horizon_ms + 1

    def _row(self, key, opened, first, last, times, closed) -> pd.DataFrame:
        stamps = [pd.Timestamp(x, unit="us") for x in (opened, first, last)]
        names = [c.split()[0] for c in ROWS.split(", ")]
        return pd.DataFrame([(*key, *stamps, times, closed)], columns=names)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = last = None
        times = 0
        for part in rows:  # the rows of a hot item come in several parts
            seen = part["seen_at"].astype("datetime64[us]").astype("int64")
            low, high = int(seen.min()), int(seen.max())
            first = low if first is None else min(first, low)
            last = high if last is None else max(last, high)
            times += len(seen)
        opened = first
        if self.state.exists():
            opened, held_first, held_last, held_times = self.state.get()
            self.handle.deleteTimer(self._due(held_last))
            first, last, times = min(first, held_first), max(last, held_last), times + held_times
        self.state.update((opened, first, last, times))
        self.handle.registerTimer(self._due(last))
        yield self._row(key, opened, first, last, times, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        opened, first, last, times = self.state.get()
        self.state.clear()
        yield self._row(key, opened, first, last, times, True)


def seen_stream(sightings: DataFrame, lateness: str, horizon_ms: int) -> DataFrame:
    """A stream of ``(source_id, url, seen_at)`` to the state of each item it touches.

    Sightings up to ``lateness`` late count; older ones are dropped by Spark.
    Rows without ``seen_at`` or key are left out. Needs ``STATE_STORE``.
    """
    named = F.col("seen_at").isNotNull()
    for column in KEY:
        named = named & F.col(column).isNotNull()
    return (
        sightings.where(named)
        .select(*KEY, "seen_at")
        .withWatermark("seen_at", lateness)
        .groupBy(*KEY)
        .transformWithStateInPandas(
            statefulProcessor=Sightings(horizon_ms),
            outputStructType=ROWS,
            outputMode="Update",
            timeMode="EventTime",
        )
    )


def seen_table(rows: DataFrame) -> DataFrame:
    """One row per item from all rows the stream gave, repeated ones included."""
    last = F.max(F.struct("times_seen", "closed", "first_seen", "last_seen"))
    periods = rows.groupBy(*KEY, "opened").agg(last.alias("p"))
    periods = periods.select(*KEY, "p.first_seen", "p.last_seen", "p.times_seen")
    return merge_seen(periods, periods.limit(0))
