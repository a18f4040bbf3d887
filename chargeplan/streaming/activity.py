"""Activity per quarter hour of a stream of events: the batch time-line's counterpart for files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_activity(events: DataFrame, ts: str = "ts", by: str = "event_type", late: str = "1 hour") -> DataFrame:
    """(start, by, n): events that begin in each quarter hour, closed when the watermark passes it."""
    quarter = F.window(ts, "15 minutes")
    return events.withWatermark(ts, late).groupBy(quarter, by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), by, "n")
