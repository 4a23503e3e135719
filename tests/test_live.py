import datetime as dt
import functools
import random

import pytest
from pyspark.sql import functions as F

from punctual.operators import asof
from punctual.streaming import live, sinks

START = dt.datetime(2024, 5, 1)
LEG, SEEN = "id INT, station STRING, at TIMESTAMP, note STRING, extra STRING", "place STRING, when TIMESTAMP, speed DOUBLE, sky STRING"


def minutes(n):
    return START + dt.timedelta(minutes=n, microseconds=137)


class Feed:
    """Two folders of files and the join over them."""

    def __init__(self, spark, folder, max_age=3600, lateness="30 minutes", parts=1, per_batch=1):
        self.spark, self.folder, self.max_age = spark, folder, max_age
        self.lateness, self.parts, self.per_batch = lateness, parts, per_batch

    def add(self, legs, seen):
        for name, rows, schema in (("legs", legs, LEG), ("seen", seen, SEEN)):
            if rows is not None:
                self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/{name}")

    def run(self):
        streams = [sinks.file_stream(self.spark, f"{self.folder}/{name}", self.spark.createDataFrame([], schema).schema, files_per_batch=self.per_batch) for name, schema in (("legs", LEG), ("seen", SEEN))]
        seen = streams[1].withColumnRenamed("place", "station")
        values = {"speed": "wind", "sky": "cloud"}
        joined = live.join_live(streams[0], seen, "station", "at", "when", values, self.lateness, self.max_age, "seen_at", self.parts)
        self.schema = joined.schema
        query = live.start(joined, f"{self.folder}/out", f"{self.folder}/state")
        query.awaitTermination()
        assert query.exception() is None
        return query

    def held(self, name):
        state = self.spark.read.format("statestore").option("stateVarName", name).option("flattenCollectionTypes", True)
        return state.load(f"{self.folder}/state").count()

    def rows(self):
        out = self.spark.read.schema(self.schema).parquet(f"{self.folder}/out").collect()
        return sorted((r.id, r.station, r.at, r.note, r.wind, r.cloud, r.seen_at) for r in out)


def expected(legs, seen, max_age, until):
    """By looking at every observation for every leg."""
    out = []
    for key, station, at, note, _ in legs:
        if at is None or station is None:
            out.append((key, station, at, note, None, None, None))
            continue
        if at > until:
            continue
        fits = [s for s in seen if s[0] == station and s[1] is not None and at - dt.timedelta(seconds=max_age) <= s[1] <= at]
        best = max(fits, key=lambda s: (s[1], s[2] is not None, s[2] or 0, s[3] or "")) if fits else (None, None, None, None)
        out.append((key, station, at, note, best[2], best[3], best[1]))
    return sorted(out, key=lambda r: r[0])


def test_observations_after_their_legs(spark, tmp_path):
    """Every batch of observations comes one batch after the legs that need it."""
    chance = random.Random(3)
    legs = [(i, chance.choice("AB"), minutes(chance.randrange(600)), "x", None) for i in range(120)]
    seen = [(chance.choice("ABC"), minutes(chance.randrange(600)), chance.choice([None, 1.5, 2.5]), chance.choice([None, "clear"])) for _ in range(300)]
    feed = Feed(spark, str(tmp_path))
    for low in range(0, 720, 120):
        feed.add(
            [row for row in legs if low <= (row[2] - START).total_seconds() / 60 < low + 120],
            [row for row in seen if low - 120 <= (row[1] - START).total_seconds() / 60 < low],
        )
    feed.run()
    until = min(max(r[2] for r in legs), max(r[1] for r in seen)) - dt.timedelta(minutes=30)
    assert feed.rows() == expected(legs, seen, 3600, until)
    assert len(feed.rows()) > 80


def test_restart_goes_on_with_waiting_legs(spark, tmp_path):
    legs = [(1, "A", minutes(10), "first", None), (2, "A", minutes(70), "late obs", None), (3, None, minutes(5), None, None), (4, "A", None, "", None), (1, "A", minutes(10), "first", None)]
    feed = Feed(spark, str(tmp_path))
    feed.add(legs, [("A", minutes(9), 1.0, "few"), ("A", None, 9.0, "none"), (None, minutes(10), 8.0, "none")])
    feed.run()
    assert [row[0] for row in feed.rows()] == [3, 4]  # nothing has passed the watermark yet
    feed.add([(5, "B", minutes(400), "far", None)], [("A", minutes(69), 2.0, None), ("A", minutes(10), 3.0, "at once"), ("B", minutes(399), 4.0, "few")])
    feed.run()
    assert feed.rows() == [
        (1, "A", minutes(10), "first", 3.0, "at once", minutes(10)),
        (1, "A", minutes(10), "first", 3.0, "at once", minutes(10)),
        (2, "A", minutes(70), "late obs", 2.0, None, minutes(69)),
        (3, None, minutes(5), None, None, None, None),
        (4, "A", None, "", None, None, None),
    ]
    feed.run()  # nothing new: nothing twice
    assert len(feed.rows()) == 5


def test_state_is_bounded_by_the_tolerance(spark, tmp_path):
    """One observation a minute for five days: the state holds an hour and the lateness, not the days."""
    feed = Feed(spark, str(tmp_path), per_batch=1)
    days = 5
    for day in range(days):
        low = day * 1440
        feed.add([(low + i, "A", minutes(low + i), "", None) for i in range(0, 1440, 60)], [("A", minutes(low + i), float(i), "few") for i in range(1440)])
    feed.run()
    # The tolerance, the lateness, and an hour between the last leg and the last observation.
    assert 90 < feed.held("observed") < 60 + 30 + 60 + 10
    assert len(feed.rows()) > 24 * days - 3
    # A station that went silent is emptied once nothing can use its observations.
    feed.add([(99_999, "B", minutes(days * 1440 + 3000), "", None)], [("B", minutes(days * 1440 + 3000), 1.0, "few")])
    feed.run()
    assert feed.held("observed") == 1 and feed.held("waiting") == 1


@pytest.mark.parametrize("parts", [1, 3])
def test_equals_batch_join_however_a_station_is_dealt(spark, tmp_path, parts):
    chance = random.Random(8)
    legs = [(i, "HOT", minutes(chance.randrange(300)), str(i), None) for i in range(80)]
    seen = [("HOT", minutes(chance.randrange(300)), float(i), None) for i in range(90)]
    feed = Feed(spark, str(tmp_path), max_age=900, parts=parts)
    feed.add(legs, seen)
    feed.add([(900, "Z", minutes(2000), "", None)], [("Z", minutes(2000), 0.0, None)])
    feed.run()
    left, right = spark.createDataFrame(legs, LEG), spark.createDataFrame(seen, SEEN)
    batch = asof.join_asof(left, right, [asof.Role("station", "at")], "place", "when", {"speed": "wind", "sky": "cloud"}, "seen_at", tolerance_seconds=900)
    want = sorted((r.id, r.station, r.at, r.note, r.wind, r.cloud, r.seen_at) for r in batch.collect())
    assert feed.rows() == want and batch.filter(F.col("wind").isNotNull()).count() > 40


def test_many_stations_share_few_states(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(live, "join_live", functools.partial(live.join_live, buckets=3))
    monkeypatch.setattr(live, "ROWS_PER_CALL", 7)
    chance = random.Random(12)
    legs = [(i, f"S{chance.randrange(90)}", minutes(chance.randrange(600)), "x", None) for i in range(300)]
    seen = [(f"S{chance.randrange(100)}", minutes(chance.randrange(60) * 10), chance.choice([None, 1.5, 2.5]), chance.choice([None, "clear"])) for _ in range(900)]
    feed = Feed(spark, str(tmp_path))
    for low in range(0, 720, 120):
        feed.add(
            [row for row in legs if low <= (row[2] - START).total_seconds() / 60 < low + 120],
            [row for row in seen if low - 120 <= (row[1] - START).total_seconds() / 60 < low],
        )
    feed.run()
    until = min(max(r[2] for r in legs), max(r[1] for r in seen)) - dt.timedelta(minutes=30)
    assert feed.rows() == expected(legs, seen, 3600, until) and len(feed.rows()) > 200
    state = spark.read.format("statestore").option("stateVarName", "observed").option("flattenCollectionTypes", True).load(f"{tmp_path}/state")
    assert state.select("key").distinct().count() <= 3
    # Silent stations are emptied, though others of their bucket go on.
    feed.add([(9_999, "S1", minutes(5000), "", None)], [("S1", minutes(5000), 1.0, "few")])
    feed.run()
    assert feed.held("observed") == 1 and feed.held("waiting") == 1
