"""Job statuses from a stream of changes: an extension, built on Structured Streaming's own state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.stages import STATUSES


def latest_statuses(changes: DataFrame, late: str = "1 hour") -> DataFrame:
    """job_id, status, changes: the status with the greatest (ts, seq) of each job so far; unknown statuses don't count.

    changes has job_id, ts, seq, status; for batch and (in update or complete mode) streaming input.
    """
    known = changes.filter(F.col("status").isin(STATUSES))
    if changes.isStreaming:
        known = known.withWatermark("ts", late)
    return known.groupBy("job_id").agg(F.max_by("status", F.struct("ts", "seq")).alias("status"), F.count("*").alias("changes"))


def changes_per_window(changes: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Number of changes to each status in tumbling windows of event time."""
    rows = changes.withWatermark("ts", late) if changes.isStreaming else changes
    return rows.groupBy(F.window("ts", width).alias("w"), "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "status", "n")
