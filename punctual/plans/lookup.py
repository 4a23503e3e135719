"""Tables behind a lookup service: destinations, dates, legs of a day, scores by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..operators import lists


def destinations(legs: DataFrame, dest: str = "dest_city") -> DataFrame:
    return legs.select(dest).distinct().orderBy(dest)


def dates_by_destination(legs: DataFrame, dest: str = "dest_city", date: str = "leg_date") -> DataFrame:
    """Sorted dates per destination; a list is bounded by the calendar."""
    return lists.keyed_values(legs.select(dest, times.day_text(date).alias("_day")), [dest], "_day", "dates")


def legs_by_destination_date(
    legs: DataFrame,
    dest: str = "dest_city",
    date: str = "leg_date",
    leg_id: str = "leg_id",
    dep_hhmm: str = "dep_hhmm",
    arr_hhmm: str = "arr_hhmm",
    page_size: int = 1000,
) -> DataFrame:
    """Leg records per destination and date, on as many pages as a key needs."""
    records = legs.select(
        dest,
        times.day_text(date).alias("leg_day"),
        F.col(leg_id).alias("leg_id"),
        times.minutes_of_day(dep_hhmm).alias("departure_minute"),
        times.minutes_of_day(arr_hhmm).alias("arrival_minute"),
    )
    fields = ["leg_id", "departure_minute", "arrival_minute"]
    return lists.paged_records(records, [dest, "leg_day"], fields, page_size, "leg_id", "legs")


def legs_of(legs: DataFrame, dest_value: str, day: str, dest: str = "dest_city", date: str = "leg_date") -> DataFrame:
    """The legs of one destination and day as rows; both conditions reach the scan."""
    return legs.filter((F.col(dest) == dest_value) & (F.col(date) == F.lit(day).cast("date")))


def with_key_hash(df: DataFrame, columns: list[str], name: str = "leg_id") -> DataFrame:
    """An id that depends on the row's content only, so it survives retries and repartitioning."""
    return df.withColumn(name, F.xxhash64(*columns))


def with_digest_id(df: DataFrame, columns: list[str], name: str = "leg_id") -> DataFrame:
    """The same as text, by a hash that other engines have too. NULL and the empty text give different ids."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return df.withColumn(name, F.md5(F.concat_ws("|", *parts)))


def by_id(df: DataFrame, value: object, key: str = "leg_id") -> DataFrame:
    """The rows of one id; on a table from ``files.write_for_lookup`` one bucket is read."""
    return df.filter(F.col(key) == F.lit(value))


def by_ids(df: DataFrame, ids: DataFrame, key: str = "leg_id") -> DataFrame:
    """Rows for a table of ids: one equi-join in place of a filter per request."""
    return df.join(ids.select(key).distinct(), key, "left_semi")
