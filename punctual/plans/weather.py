"""Questions on delay and weather, for the origin or the destination role."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import buckets, numbers, text

COMBINATION = (
    "wind_direction",
    "wind_speed",
    "wind_gusts",
    "visibility",
    "precipitation",
    "clouds",
    "temperature",
    "dew_point",
)


def weather_delayed(legs: DataFrame, weather_delay: str = "weather_delay") -> DataFrame:
    """Legs with some weather delay; NULL counts as none."""
    return legs.filter(F.col(weather_delay) > 0)


def delay_by_combination(
    legs: DataFrame, role: str, fields: Sequence[str] = COMBINATION, weather_delay: str = "weather_delay"
) -> DataFrame:
    """Weather delay per combination of all weather fields of one role, lists included."""
    keys = [f"{role}_{field}" for field in fields]
    return (
        weather_delayed(legs, weather_delay)
        .groupBy(*keys)
        .agg(F.avg(weather_delay).alias("avg_weather_delay"), F.count(F.lit(1)).alias("num_weather_delays"))
        .orderBy(F.desc("avg_weather_delay"))
    )


def delay_by_wind_mph(
    legs: DataFrame, wind: str = "origin_wind_speed", weather_delay: str = "weather_delay"
) -> DataFrame:
    """Weather-delayed legs per wind range; an unknown wind counts to the top range."""
    return (
        weather_delayed(legs, weather_delay)
        .groupBy(buckets.bucketize(wind, *buckets.WIND_MPH).alias("wind_bucket"))
        .agg(F.avg(weather_delay).alias("avg_weather_delay"), F.count(F.lit(1)).alias("num_weather_delays"))
        .orderBy("wind_bucket")
    )


def _share_by_bucket(legs: DataFrame, value: str, ranges, name: str, weather_delay: str) -> DataFrame:
    label = buckets.bucketize(value, *ranges, null_label=buckets.UNKNOWN)
    return legs.groupBy(label.alias(name)).agg(
        F.count(F.lit(1)).alias("num_legs"),
        numbers.rounded_avg(weather_delay).alias("avg_weather_delay"),
        numbers.percent_where(F.col(weather_delay) > 0).alias("weather_delay_pct"),
    )


def share_by_visibility(
    legs: DataFrame, visibility: str = "origin_visibility", weather_delay: str = "weather_delay"
) -> DataFrame:
    result = _share_by_bucket(legs, visibility, buckets.VISIBILITY_MILES, "visibility_bucket", weather_delay)
    return result.orderBy(F.desc_nulls_last("avg_weather_delay"))


def share_by_wind_knots(legs: DataFrame, wind: str, weather_delay: str = "weather_delay") -> DataFrame:
    result = _share_by_bucket(legs, wind, buckets.WIND_KNOTS, "wind_bucket", weather_delay)
    return result.orderBy(F.desc("wind_bucket"))


def delay_by_cloud(
    legs: DataFrame, clouds: str = "dest_clouds", weather_delay: str = "weather_delay"
) -> DataFrame:
    """Weather-delayed legs per cloud type; a leg counts once for each of its clouds."""
    return (
        weather_delayed(legs, weather_delay)
        .select(F.explode(clouds).alias("cloud"), weather_delay)
        .groupBy("cloud")
        .agg(F.count(F.lit(1)).alias("num_weather_delays"), F.avg(weather_delay).alias("avg_weather_delay"))
        .orderBy(F.desc("avg_weather_delay"))
    )


def delay_share_by_cloud(
    legs: DataFrame,
    clouds: str = "origin_clouds",
    arr_del15: str = "arr_del15",
    weather_delay: str = "weather_delay",
) -> DataFrame:
    late = F.col(arr_del15) == 1
    return (
        legs.select(F.explode(clouds).alias("cloud"), arr_del15, weather_delay)
        .groupBy("cloud")
        .agg(
            F.count(F.lit(1)).alias("total_legs"),
            F.count_if(late).alias("delayed_legs"),
            numbers.percent_where(late).alias("delay_pct"),
            numbers.rounded_avg(weather_delay).alias("avg_weather_delay"),
        )
        .orderBy(F.desc("delay_pct"))
    )


def destination_wind(
    legs: DataFrame, dest: str = "dest_city", wind: str = "dest_wind_speed", arr_del15: str = "arr_del15"
) -> DataFrame:
    late = F.col(arr_del15) == 1
    return (
        legs.groupBy(dest)
        .agg(
            F.count(F.lit(1)).alias("total_legs"),
            F.count_if(late).alias("delayed_legs"),
            numbers.rounded_avg(wind).alias("avg_wind_speed"),
            numbers.percent_where(late).alias("delay_rate_pct"),
        )
        .orderBy(F.desc_nulls_last("avg_wind_speed"))
    )


def delay_by_precipitation(
    legs: DataFrame,
    precipitation: str = "origin_precipitation",
    arr_del15: str = "arr_del15",
    arr_delay: str = "arr_delay",
) -> DataFrame:
    """Delay rate per precipitation text; legs without weather data form a NULL group of their own."""
    late = F.col(arr_del15) == 1
    label = text.list_label(precipitation, ", ", null_label=None)
    return (
        legs.groupBy(label.alias("precipitation"))
        .agg(
            F.count(F.lit(1)).alias("total_legs"),
            F.count_if(late).alias("delayed_legs"),
            numbers.percent_where(late).alias("delay_rate_pct"),
            numbers.rounded_avg(arr_delay).alias("avg_arr_delay"),
        )
        .orderBy(F.desc("delay_rate_pct"))
    )


def precipitation_frequency(
    legs: DataFrame,
    dest: str = "dest_city",
    precipitation: str = "dest_precipitation",
    arr_del15: str = "arr_del15",
) -> DataFrame:
    wet, late = F.size(precipitation) > 0, F.col(arr_del15) == 1
    return (
        legs.groupBy(dest)
        .agg(
            F.count(F.lit(1)).alias("total_legs"),
            F.count_if(wet).alias("legs_with_precip"),
            numbers.percent_where(wet).alias("precip_frequency_pct"),
            F.count_if(late).alias("delayed_legs"),
            numbers.percent_where(late).alias("delay_rate_pct"),
        )
        .orderBy(F.desc("precip_frequency_pct"))
    )
