"""Event-time metrics on a stream: fixed and sliding windows, late rows, duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The window widths that operations look at.
WIDTHS = ("15 minutes", "1 hour", "1 day")


def event_time(stream: DataFrame, time: str, lateness: str) -> DataFrame:
    """Mark the event time; watermarks need a timestamp with time zone semantics."""
    if dict(stream.dtypes)[time] != "timestamp":
        stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    return stream.withWatermark(time, lateness)


def whole_span(rows: DataFrame, time: str) -> str:
    """A lateness that no row of a finite table exceeds, in whatever order its files are read."""
    limits = rows.agg(F.unix_seconds(F.min(time).cast("timestamp")), F.unix_seconds(F.max(time).cast("timestamp"))).first()
    return f"{(limits[1] or 0) - (limits[0] or 0) + 1} seconds"


def without_duplicates(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop repeated keys; the state is cleared as the watermark moves on."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def windowed_metrics(
    stream: DataFrame,
    time: str,
    keys: Sequence[str],
    metrics: Mapping[str, Column],
    width: str,
    slide: str | None = None,
) -> DataFrame:
    """Aggregates per key and window. Rows are added up in every task before the shuffle, so one key or
    window with very many rows is no burden on a single task. Works on batch tables alike."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        stream.groupBy(*keys, window.alias("window"))
        .agg(*[column.alias(name) for name, column in metrics.items()])
        .select(
            *keys,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *metrics,
        )
    )


def roll_up(
    fine: DataFrame, keys: Sequence[str], sums: Sequence[str], width: str, slide: str | None = None
) -> DataFrame:
    """Wider windows from narrow ones, for metrics that add up.

    The width (and the slide) must be a multiple of the narrow width. One stream then keeps state for the
    narrow windows only, and every other width is read off its output.
    """
    return windowed_metrics(fine, "window_start", keys, {name: F.sum(name) for name in sums}, width, slide)
