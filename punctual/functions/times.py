"""Schedule times written as HHMM numbers, calendar parts and time zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnLike, as_column


def hhmm_text(hhmm: ColumnLike) -> Column:
    """``5`` -> ``"0005"``; NULL stays NULL."""
    return F.lpad(as_column(hhmm).cast("int").cast("string"), 4, "0")


def hhmm_hour(hhmm: ColumnLike) -> Column:
    return F.floor(as_column(hhmm) / 100).cast("int")


def hhmm_minute(hhmm: ColumnLike) -> Column:
    return (as_column(hhmm) % 100).cast("int")


def minutes_of_day(hhmm: ColumnLike) -> Column:
    """Minutes since midnight."""
    return hhmm_hour(hhmm) * 60 + hhmm_minute(hhmm)


def hhmm_timestamp(date: ColumnLike, hhmm: ColumnLike, roll_2400: bool = False) -> Column:
    """Local wall-clock timestamp of a date and an HHMM number, NULL when the time is not a valid one.

    The result is a timestamp without time zone, because that is what a printed timetable holds.
    ``2400`` is not a valid time; ``roll_2400`` reads it as midnight of the next day.
    """
    day, clock = as_column(date), as_column(hhmm)
    built = F.try_make_timestamp_ntz(
        F.year(day), F.month(day), F.dayofmonth(day), hhmm_hour(clock), hhmm_minute(clock), F.lit(0)
    )
    if not roll_2400:
        return built
    return F.when(clock == 2400, F.date_add(day, 1).cast("timestamp_ntz")).otherwise(built)


def hour_block(hhmm: ColumnLike) -> Column:
    """``0705`` -> ``"0700-0759"``."""
    hour = F.substring(hhmm_text(hhmm), 1, 2)
    return F.concat(hour, F.lit("00-"), hour, F.lit("59"))


def iso_weekday(date: ColumnLike) -> Column:
    """1 = Monday ... 7 = Sunday, the numbering of the source data."""
    return F.weekday(as_column(date)) + 1


def weekend_flag(date: ColumnLike) -> Column:
    return F.when(F.weekday(as_column(date)) >= 5, 1).otherwise(0)


def weekday_name(number: ColumnLike) -> Column:
    """Name of an ISO weekday number, ``Unknown`` for anything else."""
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    number = as_column(number)
    inside = number.between(1, len(names))
    return F.when(inside, F.element_at(F.array(*map(F.lit, names)), number)).otherwise("Unknown")


def season(month: ColumnLike) -> Column:
    """Northern-hemisphere season of a month number; NULL for a number that is no month."""
    month = as_column(month)
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .when(month.between(9, 11), "Fall")
    )


def local_to_utc(local_time: ColumnLike, zone: ColumnLike) -> Column:
    """Wall-clock time in ``zone`` -> wall-clock time in UTC, whatever the session time zone is."""
    return F.convert_timezone(as_column(zone), F.lit("UTC"), as_column(local_time).cast("timestamp_ntz"))


def parse_text_timestamp(text: ColumnLike) -> Column:
    """``2024-01-01 00:52[:00]`` -> timestamp without time zone, NULL when it is not one."""
    return as_column(text).try_cast("timestamp_ntz")


def day_text(date: ColumnLike) -> Column:
    return F.date_format(as_column(date), "yyyy-MM-dd")


def second_text(timestamp: ColumnLike) -> Column:
    return F.date_format(as_column(timestamp), "yyyy-MM-dd HH:mm:ss")


def shift_days(timestamp: ColumnLike, days: int) -> Column:
    return as_column(timestamp) + F.expr(f"INTERVAL {int(days)} DAY")


def five_minute_start(timestamp: ColumnLike) -> Column:
    """Start of the five-minute slot a timestamp falls in."""
    return F.window(as_column(timestamp), "5 minutes")["start"]
