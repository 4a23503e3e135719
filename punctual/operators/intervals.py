"""Containment joins: points with the intervals of their key that hold them, ``start <= at <= end``.

Intervals may be of any length and overlap. Each is laid out in bins as wide as the next power of two of its own length
(in microseconds), so that it touches two bins at most, however long it is. A point looks up one bin for every width
that occurs, and those are 64 at most, in practice a handful. So the join is an equi-join on key, width and bin, followed
by the exact comparison; it is of the kind that adaptive execution splits where a key is hot. Intervals shorter than
``narrowest_seconds`` share one width, so that very short ones don't add widths of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS = 1_000_000


def _micros(time: Column, kind: str) -> Column:
    """Microseconds that grow with the time, for either kind of timestamp, dates and whole numbers."""
    if kind == "timestamp":
        return F.unix_micros(time)
    if kind == "timestamp_ntz":
        # The wall clock read as UTC, whatever the zone of the session.
        seconds = F.unix_date(F.to_date(time)).cast("long") * 86_400 + F.hour(time) * 3600 + F.minute(time) * 60
        return seconds * MICROS + (F.extract(F.lit("SECOND"), time) * MICROS).cast("long")
    if kind == "date":
        return F.unix_date(time).cast("long") * (86_400 * MICROS)
    return time.cast("long")


def _width_exponent(length: Column, narrowest: int) -> Column:
    """The least k with ``2**k > length``, but no less than ``narrowest``."""
    digits = F.length(F.bin(length))
    return F.greatest(F.when(length == 0, 0).otherwise(digits), F.lit(narrowest))


def join_containing(
    points: DataFrame,
    intervals: DataFrame,
    keys: Mapping[str, str],
    at: str,
    start: str,
    end: str,
    values: Mapping[str, str],
    how: str = "inner",
    narrowest_seconds: int = 60,
) -> DataFrame:
    """Every point with the ``values`` (interval column -> result column) of each interval that holds it.

    ``keys`` maps point columns to the interval columns that must be equal; both ends belong to the interval. ``how`` is
    ``inner``, ``left`` (points without an interval come once, with NULLs) or ``semi`` (points that any interval holds,
    once, without values). A NULL key, time or bound meets nothing, and an interval that ends before it starts is empty.
    The times must be of one type: timestamps of either kind, dates, or whole numbers (then ``narrowest_seconds`` counts
    millions). Column names that begin with an underscore are reserved.
    """
    if how not in ("inner", "left", "semi"):
        raise ValueError(f"unknown join {how!r}")
    kinds = {dict(points.dtypes)[at], dict(intervals.dtypes)[start], dict(intervals.dtypes)[end]}
    if len(kinds) != 1:
        raise TypeError(f"times must be of one type, found {sorted(kinds)}")
    kind = kinds.pop()
    narrowest = max(int(narrowest_seconds * MICROS).bit_length(), 1)
    low, high = _micros(F.col(start), kind), _micros(F.col(end), kind)
    laid = (
        intervals.filter(F.col(start) <= F.col(end))
        .select(
            *[F.col(theirs).alias(f"_k{i}") for i, theirs in enumerate(keys.values())],
            low.alias("_low"),
            high.alias("_high"),
            F.struct(*[F.col(old).alias(new) for old, new in values.items()] or [F.lit(1).alias("_")]).alias("_values"),
        )
        .withColumn("_width", _width_exponent(F.col("_high") - F.col("_low"), narrowest))
    )
    binned = laid.select(
        "*", F.explode(F.sequence(F.expr("shiftright(_low, _width)"), F.expr("shiftright(_high, _width)"))).alias("_bin")
    )
    # The widths that occur: 64 numbers at most.
    widths = laid.agg(F.array_sort(F.collect_set("_width")).alias("widths")).scalar()
    names = list(values.values())

    def looked_up(rows: DataFrame) -> DataFrame:
        """Rows with ``_values``, once for each interval that holds them."""
        looked = rows.withColumn("_at", _micros(F.col(at), kind)).withColumn("_w", F.explode(widths))
        looked = looked.withColumn("_b", F.expr("shiftright(_at, _w)"))
        condition = (F.col("_w") == F.col("_width")) & (F.col("_b") == F.col("_bin"))
        for i, mine in enumerate(keys):
            condition = condition & (F.col(mine) == F.col(f"_k{i}"))
        held = looked.join(binned, condition & (F.col("_low") <= F.col("_at")) & (F.col("_at") <= F.col("_high")))
        return held.select(*rows.columns, "_values")

    if how == "inner":
        return looked_up(points).select(*points.columns, *[F.col("_values")[name].alias(name) for name in names])
    # What holds a point depends on its keys and time alone; points that share them are looked up once.
    distinct = points.select(*keys, at).distinct()
    found = looked_up(distinct).select(*[F.col(name).alias(f"_p{i}") for i, name in enumerate([*keys, at])], "_values")
    same = F.lit(True)
    for i, name in enumerate([*keys, at]):
        same = same & (F.col(name) == F.col(f"_p{i}"))
    if how == "semi":
        return points.join(found, same, "left_semi")
    return points.join(found, same, "left").select(*points.columns, *[F.col("_values")[name].alias(name) for name in names])
