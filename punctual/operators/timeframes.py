"""Per-station time windows and the observation requests they lead to."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import shift_days


def station_timeframes(
    df: DataFrame, stations: Mapping[str, str], time: str, width: str = "60 days"
) -> DataFrame:
    """First and last time and row count per station, role and window.

    ``stations`` maps a role name to the column with that role's station. The table is read once: each row
    gives one row per role. The windows start at 1970-01-01. Rows without a time are in no window.
    """
    roles = [F.struct(F.lit(role).alias("role"), F.col(column).alias("station")) for role, column in stations.items()]
    uses = df.select(F.col(time).alias("_time"), F.inline(F.array(*roles)))
    return (
        uses.groupBy("station", F.window("_time", width).alias("window"), "role")
        .agg(F.min("_time").alias("start_date"), F.max("_time").alias("end_date"), F.count(F.lit(1)).alias("records"))
        .select("station", "window", "start_date", "end_date", "records", "role")
    )


# What an archive request asks for besides station and days, in this order.
REQUEST_PARAMETERS = {
    "tz": "Etc/UTC",
    "format": "onlytdf",
    "latlon": "no",
    "elev": "no",
    "missing": "M",
    "trace": "T",
    "direct": "no",
    "report_type": "2",
}


def observation_requests(
    timeframes: DataFrame, margin_days: int = 1, parameters: Mapping[str, str] = REQUEST_PARAMETERS
) -> DataFrame:
    """One archive request per timeframe, whose times must be UTC, as the archive's are.

    It reaches from a day before the first time, which covers departures right after midnight, to the day after
    the last one, which the archive leaves out.
    """
    start, end = shift_days("start_date", -margin_days), shift_days("end_date", margin_days)
    parts = timeframes.select(
        "station",
        "role",
        F.year(start).alias("year1"),
        F.month(start).alias("month1"),
        F.dayofmonth(start).alias("day1"),
        F.year(end).alias("year2"),
        F.month(end).alias("month2"),
        F.dayofmonth(end).alias("day2"),
    )
    pattern = "station=%s&data=metar&year1=%d&month1=%d&day1=%d&year2=%d&month2=%d&day2=%d"
    fixed = "".join(f"&{name}={value}" for name, value in parameters.items())
    query = F.format_string(pattern, "station", "year1", "month1", "day1", "year2", "month2", "day2")
    return parts.withColumn("query", F.concat(query, F.lit(fixed)))
