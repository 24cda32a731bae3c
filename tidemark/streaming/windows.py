"""Hourly totals of a stream, final once the watermark has passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.retail import WATERMARK_DELAY


def hourly_totals(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    event_time: str = "ts",
    delay: str = WATERMARK_DELAY,
    width: str = "1 hour",
) -> DataFrame:
    """Sum and count of ``value`` by window and keys; the same for a batch and a stream.

    A stream emits a window once its end lies ``delay`` or more before the largest event
    time, and drops rows that come later; a batch counts every row.
    """
    if rows.isStreaming:
        rows = rows.withWatermark(event_time, delay)
    totals = rows.groupBy(F.window(event_time, width).alias("w"), *keys).agg(
        F.sum(value).alias("total"), F.count(F.lit(1)).alias("n")
    )
    return totals.select(F.col("w.start").alias("hour_start"), F.col("w.end").alias("hour_end"), *keys, "total", "n")


def closed_hours(totals: DataFrame, rows: DataFrame, *, event_time: str = "ts", delay: str = WATERMARK_DELAY) -> DataFrame:
    """The windows a stream over ``rows`` has finished."""
    last = F.date_trunc("millisecond", F.max(event_time)) - F.expr(f"interval {delay}")
    return totals.filter(F.col("hour_end") <= rows.agg(last.alias("mark")).scalar())
