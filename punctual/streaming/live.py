"""Legs enriched from a live feed of observations: an as-of join of two streams with state per station.

A leg waits in the state of its station until the watermark has passed its time; by then every observation that may
still come is later than the leg, so the latest one not after it is final, and the leg is emitted once. The watermark is
the lesser of those of the two streams: a feed that lags holds the legs back and loses nothing.

Per station the state holds the legs that wait, and of the observations only those that a waiting or coming leg could
use: none older than the tolerance before the oldest waiting leg, or before the watermark where none waits. A timer at
the next due time emits legs; one at the end of the newest observation's tolerance empties stations that went silent.

Calls to the state cost far more than the few rows that most stations have in a batch. So stations share a state by a
hash of their name, ``buckets`` of them; each row names its station there. More buckets hold less at once in a task. A
station that is too busy for one task can be dealt out in ``parts``: legs go to one part by a hash of their values,
observations to all of them.

The state is kept in RocksDB under the checkpoint; a restarted query goes on with the legs that wait there.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ListState

from . import sinks
from .envelopes import TIME_FORMATS

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
MICROS = 1_000_000
# States that stations are dealt out to. All rows that wait in one are in a task's memory at once.
BUCKETS = 512
# So many rows go to the state in one call.
ROWS_PER_CALL = 10_000


def _due(micros: int) -> int:
    """The first millisecond that isn't before the time."""
    return -(-micros // 1000)


def _rank(values: str) -> list[tuple]:
    """Orders observations of one time like structs of their values: nulls first."""
    return [(value is not None, value if value is not None else 0) for value in json.loads(values).values()]


def _append(state: ListState, rows: list[tuple]) -> None:
    for start in range(0, len(rows), ROWS_PER_CALL):
        state.appendList(rows[start : start + ROWS_PER_CALL])


def _by_place(entries: Iterator[tuple]) -> dict[str, list[tuple]]:
    """Time and values of the entries of each station."""
    found = {}
    for place, micros, values in entries:
        found.setdefault(place, []).append((micros, values))
    return found


def _in_order(seen: list[tuple]) -> list[tuple]:
    """Observations by time, those of one time by their values; these are parsed only where times are equal."""
    if len({entry[0] for entry in seen}) == len(seen):
        return sorted(seen)
    return sorted(seen, key=lambda entry: (entry[0], _rank(entry[1])))


class AsOfState(StatefulProcessor):
    """Rows of the stations of one bucket: ``place`` (the station as JSON), ``micros``, ``leg`` (values of a leg, or null)
    and ``seen`` (values of an observation, or null)."""

    def __init__(self, max_age_seconds: int):
        self.max_age = max_age_seconds * MICROS

    def init(self, handle) -> None:
        self.handle = handle
        # Lists are appended to and rewritten in one go; a call to the state for every row would cost more than its work.
        self.observed = handle.getListState("observed", "place string, micros long, seen string")
        self.waiting = handle.getListState("waiting", "place string, micros long, leg string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        legs, seen = [], []
        for batch in rows:
            for place, micros, leg, values in zip(*(batch[name].tolist() for name in ("place", "micros", "leg", "seen")), strict=True):
                if leg is not None:
                    legs.append((place, micros, leg))
                else:
                    seen.append((place, micros, values))
        if legs:
            _append(self.waiting, legs)
            self.handle.registerTimer(max(_due(min(micros for _, micros, _ in legs)), watermark + 1))
        if seen:
            _append(self.observed, seen)
            self.handle.registerTimer(max(_due(max(micros for _, micros, _ in seen) + self.max_age) + 1, watermark + 1))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The legs that are due, each with its observation; then what no leg can use any more goes."""
        watermark = timerValues.getCurrentWatermarkInMs()
        waiting, observed = _by_place(self.waiting.get()), _by_place(self.observed.get())
        out, rest, useful = [], [], []
        for place, legs in waiting.items():
            legs.sort()
            n_due = bisect.bisect_right(legs, watermark, key=lambda entry: _due(entry[0]))
            rest += [(place, *entry) for entry in legs[n_due:]]
            seen = _in_order(observed.get(place, []))
            times = [entry[0] for entry in seen]
            for at, leg in legs[:n_due]:
                last = bisect.bisect_right(times, at) - 1
                near = last >= 0 and times[last] >= at - self.max_age
                out.append((leg, *(seen[last] if near else (None, None))))
            waiting[place] = legs[n_due:]
        for place, seen in observed.items():
            oldest = min([watermark * 1000, *(entry[0] for entry in waiting.get(place, [])[:1])]) - self.max_age
            useful += [(place, *entry) for entry in seen if entry[0] >= oldest]
        before = len(out) + len(rest), sum(map(len, observed.values()))
        for state, held, after in ((self.waiting, before[0], rest), (self.observed, before[1], useful)):
            if len(after) < held:
                state.clear()
                _append(state, after)
        if rest:
            self.handle.registerTimer(max(_due(min(micros for _, micros, _ in rest)), watermark + 1))
        if out:
            match = pd.array([row[1] for row in out], "Int64")
            yield pd.DataFrame({"leg": [row[0] for row in out], "match": match, "seen": [row[2] for row in out]})

    def close(self) -> None:
        pass


def _json(names) -> Column:
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false", **TIME_FORMATS})


def join_live(
    legs: DataFrame,
    observations: DataFrame,
    station: str,
    leg_time: str,
    obs_time: str,
    values: Mapping[str, str],
    lateness: str,
    max_age_seconds: int,
    matched_time: str | None = None,
    parts: int = 1,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The stream of legs, each once, with the values of the latest observation of its station, not after it and at most
    ``max_age_seconds`` older; NULLs where there is none.

    ``values`` maps observation columns to result columns. Of several observations at one time the greatest values
    count, as in ``operators.asof``. Both times must be timestamps with time zone semantics. Rows later than
    ``lateness`` behind their stream are dropped by Spark and counted. Legs without a time or station come out at once,
    with NULLs. A leg with a time comes out when the watermark, the lesser of the two streams', has passed it.
    """
    leg_row = legs.schema
    seen_row = T.StructType([T.StructField(new, observations.schema[old].dataType) for old, new in values.items()])
    part = F.pmod(F.xxhash64("leg"), F.lit(parts)).cast("int")
    known = F.col(station).isNotNull() & F.col(leg_time).isNotNull()

    def timed(rows: DataFrame, time: str, leg: Column, seen: Column) -> DataFrame:
        made = rows.filter(F.col(station).isNotNull() & F.col(time).isNotNull()).select(
            _json([F.col(station).alias("place")]).alias("place"), F.pmod(F.xxhash64(station), F.lit(buckets)).cast("int").alias("bucket"),
            F.col(time).alias("at"), F.unix_micros(time).alias("micros"),
            leg.alias("leg"), seen.alias("seen"),
        )
        return made.withWatermark("at", lateness)

    none = F.lit(None).cast("string")
    left = timed(legs, leg_time, _json(legs.columns), none).withColumn("part", part)
    payload = _json([F.col(old).alias(new) for old, new in values.items()])
    right = timed(observations, obs_time, none, payload).withColumn("part", F.explode(F.array(*map(F.lit, range(parts)))))
    both = left.unionByName(right)
    found = both.groupBy("bucket", "part").transformWithStateInPandas(
        AsOfState(max_age_seconds), "leg string, match long, seen string", "Append", "EventTime"
    )
    leg, seen = F.from_json("leg", leg_row), F.from_json("seen", seen_row)
    parsed = found.select(leg.alias("leg"), F.timestamp_micros("match").alias("match"), seen.alias("seen"))
    # Legs that can't match anything needn't wait.
    nothing = F.lit(None).cast(seen_row)
    unknown = legs.filter(~known).select(F.struct(*legs.columns).alias("leg"), F.lit(None).cast("timestamp").alias("match"), nothing.alias("seen"))
    matched = [F.col("match").alias(matched_time)] if matched_time else []
    return parsed.unionByName(unknown).select("leg.*", "seen.*", *matched)


def start(joined: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the joined stream; its state goes to RocksDB, whatever the session uses elsewhere."""
    conf = joined.sparkSession.conf
    before = conf.get(_STORE_KEY)
    conf.set(_STORE_KEY, STATE_STORE)
    try:
        return sinks.append_parquet(joined, path, checkpoint)
    finally:
        conf.set(_STORE_KEY, before)
