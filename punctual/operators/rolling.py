"""Moving and expanding averages over calendar days.

Rows are first added up per key and day. The windows then run over at most one row per day and key, so
their length is bounded by the calendar and not by how many rows a key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_totals(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Sum and count of the non-null values per key and day."""
    return (
        df.filter(F.col(value).isNotNull() & F.col(day).isNotNull())
        .groupBy(*keys, day)
        .agg(F.sum(value).alias("day_sum"), F.count(F.lit(1)).alias("day_rows"))
    )


def _window_average(daily: DataFrame, keys: Sequence[str], day: str, start: int, end: int, name: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy("_day").rangeBetween(start, end)
    return (
        daily.withColumn("_day", F.unix_date(day).cast("long"))
        .withColumn(name, F.try_divide(F.sum("day_sum").over(window), F.sum("day_rows").over(window)))
        .drop("_day")
    )


def rolling_from_totals(
    daily: DataFrame, keys: Sequence[str], day: str, days: int = 7, name: str = "rolling_avg"
) -> DataFrame:
    """The average of the last ``days`` days from daily totals, stored or just made."""
    return _window_average(daily, keys, day, -(days - 1), Window.currentRow, name)


def prior_from_totals(daily: DataFrame, keys: Sequence[str], day: str, name: str = "prior_avg") -> DataFrame:
    """The average of all earlier days from daily totals, stored or just made."""
    return _window_average(daily, keys, day, Window.unboundedPreceding, -1, name)


def rolling_average(
    df: DataFrame, keys: Sequence[str], day: str, value: str, days: int = 7, name: str = "rolling_avg"
) -> DataFrame:
    """Average of all rows of the last ``days`` days, the current one included, per key and day."""
    return rolling_from_totals(daily_totals(df, keys, day, value), keys, day, days, name)


def prior_average(
    df: DataFrame, keys: Sequence[str], day: str, value: str, name: str = "prior_avg"
) -> DataFrame:
    """Average of all rows of earlier days per key and day; NULL on a key's first day."""
    return prior_from_totals(daily_totals(df, keys, day, value), keys, day, name)


def attach_prior_average(
    df: DataFrame, keys: Sequence[str], day: str, value: str, name: str = "prior_avg"
) -> DataFrame:
    """Give each row its key's average over earlier days, by one equi-join on key and day."""
    averages = prior_average(df, keys, day, value, name).select(*keys, day, name)
    return df.join(averages, [*keys, day], "left")
