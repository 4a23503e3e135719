"""Sets of days as bitmaps: of fixed size whatever is counted, mergeable, readable as lists.

A set is some bitmaps of 4,096 bytes, each for 32,768 days (89 years), so that a key has one or two. Tasks build them up
before the shuffle; sets of parts (months, loads) are merged by OR without their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Day 1 is 0001-01-01, so that all dates have positive numbers.
FIRST_DAY = 719_163
BITS = 32_768


def day_bitmaps(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """``(keys, bucket, days)`` with the dates of each key; NULL dates are in no set."""
    number = (F.unix_date(F.col(date).cast("date")) + FIRST_DAY).cast("long")
    numbered = df.filter(F.col(date).isNotNull()).select(*keys, number.alias("_day"))
    return numbered.groupBy(*keys, F.bitmap_bucket_number("_day").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_day")).alias("days")
    )


def merged(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The union of sets per (fewer) keys."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("days").alias("days"))


def counts(bitmaps: DataFrame, keys: Sequence[str], name: str = "num_days") -> DataFrame:
    """How many different days each key has."""
    return merged(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("days")).alias(name))


def day_lists(bitmaps: DataFrame, keys: Sequence[str], name: str = "dates") -> DataFrame:
    """The sorted dates of each key as a list; its length is bounded by the calendar."""
    places = F.sequence(F.lit(0), F.lit(BITS // 8 - 1))
    octets = merged(bitmaps, keys).select(*keys, "bucket", "days", F.explode(places).alias("_octet")).select(
        *keys, "bucket", "_octet", F.conv(F.hex(F.expr("substring(days, _octet + 1, 1)")), 16, 10).cast("int").alias("_bits")
    )
    bits = octets.filter("_bits <> 0").withColumn("_bit", F.explode(F.sequence(F.lit(0), F.lit(7))))
    number = (F.col("bucket") - 1) * BITS + F.col("_octet") * 8 + F.col("_bit") + 1
    dates = bits.filter(F.expr("(shiftright(_bits, _bit) & 1) = 1")).select(
        *keys, F.date_from_unix_date((number - FIRST_DAY).cast("int")).alias("_date")
    )
    return dates.groupBy(*keys).agg(F.array_sort(F.collect_list("_date")).alias(name))
