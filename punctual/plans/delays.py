"""Delay questions over a leg table. Column names are parameters; the defaults are the stand-in view's."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numbers, text, times
from ..operators import joins, profile, ranking, rolling, shaping

CAUSES = {
    "carrier_total": "carrier_delay",
    "weather_total": "weather_delay",
    "nas_total": "nas_delay",
    "security_total": "security_delay",
    "late_aircraft_total": "late_aircraft_delay",
}


def operated(legs: DataFrame, cancelled: str = "cancelled", diverted: str | None = "diverted") -> DataFrame:
    """Legs that took place, and went where they were meant to unless ``diverted`` is None."""
    took_place = F.col(cancelled) == 0
    return legs.filter(took_place if diverted is None else took_place & (F.col(diverted) == 0))


def delay_by_destination(
    legs: DataFrame, dest: str = "dest_city", dep_delay: str = "dep_delay", arr_delay: str = "arr_delay"
) -> DataFrame:
    return legs.groupBy(dest).agg(
        F.count(F.lit(1)).alias("num_legs"),
        F.avg(dep_delay).alias("avg_dep_delay"),
        F.avg(arr_delay).alias("avg_arr_delay"),
    )


def worst_destinations(legs: DataFrame, n: int = 10, dest: str = "dest_city", **columns: str) -> DataFrame:
    return ranking.top_n(delay_by_destination(legs, dest, **columns), "avg_arr_delay", n, [dest])


def worst_destinations_per_carrier(
    legs: DataFrame,
    names: Mapping[str, str],
    k: int = 3,
    carrier: str = "carrier",
    dest: str = "dest_city",
    arr_delay: str = "arr_delay",
) -> DataFrame:
    """The k destinations with the highest average arrival delay of every carrier, named."""
    summary = (
        operated(legs, diverted=None)
        .groupBy(carrier, dest)
        .agg(F.count(F.lit(1)).alias("num_legs"), F.avg(arr_delay).alias("avg_arr_delay"))
    )
    ranked = ranking.top_k_per_group(summary, [carrier], "avg_arr_delay", k, [dest])
    return shaping.replace_codes(ranked, carrier, names, "airline").orderBy("airline", "rank")


def carrier_summary(
    legs: DataFrame, names: Mapping[str, str], carrier: str = "carrier", arr_delay: str = "arr_delay"
) -> DataFrame:
    summary = (
        operated(legs, diverted=None)
        .groupBy(carrier)
        .agg(F.count(F.lit(1)).alias("total_legs"), F.avg(arr_delay).alias("overall_avg_arr_delay"))
    )
    return shaping.replace_codes(summary, carrier, names, "airline").orderBy(F.desc("overall_avg_arr_delay"))


def cause_share(
    legs: DataFrame,
    names: Mapping[str, str],
    carrier: str = "carrier",
    arr_delay: str = "arr_delay",
    causes: Mapping[str, str] = CAUSES,
) -> DataFrame:
    """Minutes per delay cause and their share of the total arrival delay; NULL where the total is 0."""
    totals = (
        operated(legs)
        .groupBy(carrier)
        .agg(*[F.sum(c).alias(name) for name, c in causes.items()], F.sum(arr_delay).alias("arr_delay_total"))
    )
    shares = {
        name.replace("_total", "_pct"): numbers.percent(F.col(name), F.col("arr_delay_total"), 1)
        for name in causes
    }
    named = shaping.replace_codes(totals.withColumns(shares), carrier, names, "airline")
    return named.orderBy(F.desc("arr_delay_total"))


def carrier_delay_per_leg(
    legs: DataFrame, names: Mapping[str, str], carrier: str = "carrier", carrier_delay: str = "carrier_delay"
) -> DataFrame:
    summary = (
        operated(legs)
        .groupBy(carrier)
        .agg(F.sum(carrier_delay).alias("carrier_delay_total"), F.count(F.lit(1)).alias("total_legs"))
        .withColumn("carrier_delay_per_leg", numbers.ratio(F.col("carrier_delay_total"), F.col("total_legs")))
    )
    return shaping.replace_codes(summary, carrier, names, "airline").orderBy(F.desc("carrier_delay_per_leg"))


def delay_by_weekday(
    legs: DataFrame, weekday: str = "day_of_week", arr_delay: str = "arr_delay", arr_del15: str = "arr_del15"
) -> DataFrame:
    summary = (
        operated(legs)
        .groupBy(weekday)
        .agg(
            F.count(F.lit(1)).alias("total_legs"),
            numbers.rounded_avg(arr_delay).alias("avg_arr_delay"),
            numbers.percent(F.sum(arr_del15), F.count(F.lit(1))).alias("pct_delayed_15"),
        )
    )
    return summary.select(
        times.weekday_name(weekday).alias("weekday"), "total_legs", "avg_arr_delay", "pct_delayed_15"
    ).orderBy(F.desc("avg_arr_delay"))


def weather_delay_by_month(
    legs: DataFrame,
    month: str = "month",
    dest: str = "dest_city",
    date: str = "leg_date",
    weather_delay: str = "weather_delay",
) -> DataFrame:
    """Weather-delayed legs per month and destination, with the ISO weeks they fell in (53 at most)."""
    return (
        legs.filter(F.col(weather_delay) > 0)
        .groupBy(month, dest)
        .agg(
            F.count(F.lit(1)).alias("num_weather_delays"),
            numbers.rounded_avg(weather_delay).alias("avg_weather_delay"),
            F.array_sort(F.collect_set(F.weekofyear(date))).alias("weeks"),
        )
        .orderBy(F.desc("avg_weather_delay"))
    )


def weather_delay_by_block(
    legs: DataFrame, block: str = "time_block", weather_delay: str = "weather_delay"
) -> DataFrame:
    """All time blocks, also those without any weather delay, in one scan and one aggregation."""
    delayed = F.when(F.col(weather_delay) > 0, F.col(weather_delay))
    return (
        legs.groupBy(block)
        .agg(
            F.count(delayed).alias("num_weather_delays"),
            F.coalesce(numbers.rounded_avg(delayed), F.lit(0.0)).alias("avg_weather_delay"),
        )
        .orderBy(block)
    )


def weather_delay_over_domain(
    legs: DataFrame, blocks: DataFrame, block: str = "time_block", weather_delay: str = "weather_delay"
) -> DataFrame:
    """The same when the blocks to show come from another table."""
    summary = (
        legs.filter(F.col(weather_delay) > 0)
        .groupBy(block)
        .agg(
            F.count(F.lit(1)).alias("num_weather_delays"),
            numbers.rounded_avg(weather_delay).alias("avg_weather_delay"),
        )
    )
    zeros = {"num_weather_delays": 0, "avg_weather_delay": 0.0}
    return joins.densify(blocks, summary, [block], zeros).orderBy(block)


def count_by(legs: DataFrame, *keys: str, top: int | None = None) -> DataFrame:
    """Rows per key combination, most frequent first; ``top`` keeps that many."""
    counts = legs.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_legs"))
    if top is None:
        return counts.orderBy(F.desc("num_legs"), *keys)
    return ranking.top_n(counts, "num_legs", top, keys)


def touching(legs: DataFrame, part: str, *columns: str) -> DataFrame:
    """Legs where any of the columns contains the text."""
    condition = F.lit(False)
    for column in columns:
        condition = condition | text.contains_any(column, part)
    return legs.filter(condition)


def pair_counts(
    legs: DataFrame, origin: str = "origin_city", dest: str = "dest_city", elapsed: str = "elapsed"
) -> DataFrame:
    return (
        legs.groupBy(origin, dest)
        .agg(F.count(F.lit(1)).alias("num_legs"), F.avg(elapsed).alias("avg_duration"))
        .orderBy(F.desc("num_legs"))
    )


def average_by(legs: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return legs.groupBy(key).agg(F.avg(value).alias(name)).orderBy(F.desc(name))


def monthly_delay_share(
    legs: DataFrame,
    threshold: float = 15,
    year: str = "year",
    month: str = "month",
    delay: str = "arr_delay_minutes",
) -> DataFrame:
    late = numbers.flag(F.col(delay) > threshold)
    return (
        legs.groupBy(year, month)
        .agg(F.count(F.lit(1)).alias("total_legs"), F.sum(late).alias("delayed_legs"))
        .withColumn("delay_percentage", numbers.percent(F.col("delayed_legs"), F.col("total_legs"), None))
        .orderBy(F.desc("delay_percentage"))
    )


def season_counts(legs: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    return count_by(legs.withColumn("season", times.season(month)), year, "season")


def date_range(legs: DataFrame, date: str = "leg_date") -> DataFrame:
    """First and last date."""
    return legs.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def total_by_month(legs: DataFrame, month: str = "month", delay: str = "dep_delay_minutes") -> DataFrame:
    return legs.groupBy(month).agg(F.sum(delay).alias("total_delay_minutes")).orderBy(month)


def describe_by_carrier(
    legs: DataFrame, carrier: str = "carrier", delay: str = "dep_delay_minutes"
) -> DataFrame:
    return profile.describe_groups(legs, [carrier], delay)


def route_baseline(
    legs: DataFrame, keys: Sequence[str], day: str = "leg_date", delay: str = "arr_delay"
) -> DataFrame:
    """Per route and day: the average delay of all earlier days."""
    return rolling.prior_average(legs, keys, day, delay)


def rolling_delay(
    legs: DataFrame, keys: Sequence[str], day: str = "leg_date", delay: str = "arr_delay", days: int = 7
) -> DataFrame:
    return rolling.rolling_average(legs, keys, day, delay, days)


def delay_distribution(legs: DataFrame, carrier: str = "carrier", delay: str = "arr_delay", bins: int = 10) -> DataFrame:
    """Histogram of the delay per carrier over equal bins of the overall range."""
    bounds = legs.agg(F.struct(F.min(delay).alias("low"), F.max(delay).alias("high"))).scalar()
    width = (bounds["high"] - bounds["low"]) / bins
    index = F.coalesce(F.floor(F.try_divide(F.col(delay) - bounds["low"], width)), F.lit(0))
    return (
        legs.filter(F.col(delay).isNotNull())
        .select(carrier, F.least(index, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy(carrier, "bin")
        .agg(F.count(F.lit(1)).alias("num_legs"))
        .orderBy(carrier, "bin")
    )
