"""Sharding by proportional stratified interleaving, with built-in expressions only.

The rows of each source are put in a seeded random order. Row ``r`` of a source with ``n`` rows stands at the fraction
``(r - 1 + v) / n``, where ``v`` in [0, 1) is a seeded hash of the source, so that small sources are spread too; all rows sorted by that fraction are a sequence in which every stretch holds the sources in the
proportion of the whole table. Cutting the sequence into equal runs gives shards whose row counts differ by one at
most, and in which a source's share differs from its share of the table by a row or two.

No task holds a source: see ``ranks``. Texts are not shuffled unless the caller keeps them in ``df``.

Results in edge cases: null sources are a source of their own; a row counts like any other whatever is null or empty in
it; rows equal in source and keys are dealt like different rows; an empty table gives an empty table; helper columns
start with ``_shard_`` and are dropped, a column named ``shard`` or ``slot`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import ranked_in_groups, unit_interval


def assign_shards(df: DataFrame, source: str, keys: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Add ``shard`` (int, 0 to ``shards - 1``) and ``slot`` (long, gapless from 0 within the shard).

    ``keys`` tell rows apart; the same seed and rows give the same shards, however the rows are stored.
    """
    hashed = F.xxhash64(F.lit(seed), *(F.col(key) for key in keys))
    seeded = df.drop("shard", "slot").withColumns({"_shard_hash": hashed, "_shard_at": unit_interval(hashed)})
    within = ranked_in_groups(seeded, [source], "_shard_at", ["_shard_hash", *keys], "_shard_rank", "_shard_rows")
    # One more rank, over the whole table: the fractions are spread evenly, those of sources with few rows by the offset.
    offset = unit_interval(F.xxhash64(F.lit(seed), F.lit("offset"), F.col(source)))
    fraction = ((F.col("_shard_rank") - 1).cast("double") + offset) / F.col("_shard_rows").cast("double")
    order = ["_shard_hash", source, *keys]
    ordered = ranked_in_groups(
        within.withColumn("_shard_fraction", fraction), [], "_shard_fraction", order, "_shard_place", "_shard_total"
    )
    place, total = F.col("_shard_place") - 1, F.col("_shard_total")
    shard = F.floor(place * shards / total)
    slot = place - F.ceil(shard * total / shards)
    dealt = ordered.withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")})
    return dealt.drop(*(name for name in dealt.columns if name.startswith("_shard_")))
