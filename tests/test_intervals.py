import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from punctual.operators import intervals

START = dt.datetime(2024, 3, 1)


def moment(seconds):
    return START + dt.timedelta(seconds=seconds, microseconds=seconds % 7)


def random_case(seed):
    """Intervals from an instant to half a century, with shared ends, nulls and some that end before they start."""
    chance = random.Random(seed)
    spans = []
    for i in range(160):
        low = chance.randrange(-200_000, 200_000)
        length = chance.choice([0, 1, chance.randrange(60), chance.randrange(4000), chance.randrange(400_000), 50 * 365 * 86_400, -5])
        spans.append((chance.choice(["a", "b", "c", None]), moment(low), moment(low + length) if chance.random() > 0.03 else None, i))
    ends = [t for _, s, e, _ in spans for t in (s, e) if t is not None]
    points = [(n, chance.choice(["a", "b", "d", None]), chance.choice([None, *[chance.choice(ends) for _ in range(9)], moment(chance.randrange(-250_000, 250_000))])) for n in range(300)]
    points += points[:5]
    return points, spans


def brute(points, spans):
    return [(n, key, at, i) for n, key, at in points for k, s, e, i in spans if None not in (key, at, s, e) and key == k and s <= at <= e]


def ordered(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


@pytest.mark.parametrize("kind", ["TIMESTAMP", "TIMESTAMP_NTZ"])
def test_against_every_pair(spark, kind):
    points, spans = random_case(len(kind))
    left = spark.createDataFrame(points, f"n INT, station STRING, at {kind}")
    right = spark.createDataFrame(spans, f"place STRING, since {kind}, until {kind}, number INT")

    def joined(how):
        return intervals.join_containing(left, right, {"station": "place"}, "at", "since", "until", {"number": "frame"}, how)

    want = brute(points, spans)
    assert len(want) > 500
    inner = joined("inner")
    assert inner.columns == ["n", "station", "at", "frame"]
    assert ordered(map(tuple, inner.collect())) == ordered(want)
    held = {row[:3] for row in want}
    alone = [(*row, None) for row in points if row not in held]
    assert ordered(map(tuple, joined("left").collect())) == ordered(want + alone)
    assert ordered(map(tuple, joined("semi").collect())) == ordered([row for row in points if row in held])
    plan = inner._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_whole_numbers_dates_and_several_keys(spark):
    chance = random.Random(4)
    points = [(chance.choice("xy"), chance.randrange(3), chance.randrange(-1000, 1000)) for _ in range(100)]
    spans = [(chance.choice("xy"), chance.randrange(3), low := chance.randrange(-1000, 1000), low + chance.choice([0, 3, 700, 10**15])) for _ in range(60)]
    left, right = spark.createDataFrame(points, "k STRING, m INT, at LONG"), spark.createDataFrame(spans, "k STRING, m INT, a LONG, b LONG")
    got = intervals.join_containing(left, right, {"k": "k", "m": "m"}, "at", "a", "b", {"a": "low", "b": "high"}, narrowest_seconds=0)
    want = [(*p, a, b) for p in points for k, m, a, b in spans if p[:2] == (k, m) and a <= p[2] <= b]
    assert ordered(map(tuple, got.collect())) == ordered(want)
    days = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (1, dt.date(2023, 12, 31))], "k INT, at DATE")
    year = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 12, 31))], "k INT, a DATE, b DATE")
    assert intervals.join_containing(days, year, {"k": "k"}, "at", "a", "b", {}).collect() == [(1, dt.date(2024, 1, 1))]
    with pytest.raises(TypeError):
        intervals.join_containing(days, right, {"k": "m"}, "at", "a", "b", {})
    with pytest.raises(ValueError):
        intervals.join_containing(days, year, {"k": "k"}, "at", "a", "b", {}, "full")
    none = intervals.join_containing(days, year.limit(0), {"k": "k"}, "at", "a", "b", {}, "left")
    assert none.count() == 2


def test_a_long_interval_is_a_few_rows(spark):
    """Fifty years next to a minute: the rows that the join reads from either side stay few."""
    spans = spark.createDataFrame([("a", moment(0), moment(50 * 365 * 86_400)), ("a", moment(0), moment(60))], "k STRING, a TIMESTAMP, b TIMESTAMP")
    points = spark.range(1000).select(F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") + 1_709_251_200).alias("at"))
    joined = intervals.join_containing(points, spans, {"k": "k"}, "at", "a", "b", {})
    assert joined.count() == 1000 + 61
    laid = spans.select(F.unix_micros("a").alias("low"), F.unix_micros("b").alias("high")).withColumn("w", intervals._width_exponent(F.col("high") - F.col("low"), 1))
    bins = laid.select(F.expr("shiftright(high, w) - shiftright(low, w) + 1").alias("n"))
    assert max(row.n for row in bins.collect()) <= 2
