"""Attach the latest observation to a stream of legs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import asof
from . import sinks


def relevant(
    observations: DataFrame, time: str, legs: DataFrame, leg_times: Sequence[str], max_age_seconds: int
) -> DataFrame:
    """Observations that can match a batch of legs: between the oldest useful and the last leg time.

    Both limits are scalar subqueries, so they become a range filter on the observation scan.
    """
    lows = [F.min(column) for column in leg_times]
    highs = [F.max(column) for column in leg_times]
    low = F.least(*lows) if len(lows) > 1 else lows[0]
    high = F.greatest(*highs) if len(highs) > 1 else highs[0]
    bounds = legs.agg(F.struct(low.alias("low"), high.alias("high"))).scalar()
    oldest = bounds["low"] - F.expr(f"INTERVAL {int(max_age_seconds)} SECOND")
    return observations.filter((F.col(time) >= oldest) & (F.col(time) <= bounds["high"]))


def enrich_stream(
    legs: DataFrame,
    observations: DataFrame,
    roles: Sequence[asof.Role],
    station: str,
    time: str,
    values: Mapping[str, str],
    path: str,
    checkpoint: str,
    max_age_seconds: int,
    **options,
) -> StreamingQuery:
    """As-of join of every micro-batch with the observation table, written batch by batch.

    A join of two streams by a time range would emit every observation in the range for every leg and
    sort them out afterwards. The batch as-of join emits one row per leg, and the observation scan is cut
    to the batch's time range.
    """

    def attach(batch: DataFrame) -> DataFrame:
        times = list(dict.fromkeys(role.time for role in roles))
        near = relevant(observations, time, batch, times, max_age_seconds)
        return asof.join_asof(
            batch, near, roles, station, time, values, tolerance_seconds=max_age_seconds, **options
        )

    return sinks.per_batch_folders(legs, path, checkpoint, "append", attach)
