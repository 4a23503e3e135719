"""Row numbers within groups of any size, without a task that holds a whole group.

Rows are ordered by a uniform hash. A group is cut into ranges of that hash, about ``ROWS_PER_RANGE`` rows each;
row numbers inside a range plus the running count of the ranges before it give the number inside the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RANGE = 512
# At most so many ranges per group, so that the running count over them stays a small sort.
MAX_RANGES = 65536


def unit_interval(hashed: Column) -> Column:
    """A 64-bit hash as a double in [0, 1)."""
    return F.shiftrightunsigned(hashed, 11).cast("double") / F.lit(float(1 << 53))


def ranked_in_groups(
    df: DataFrame, group: list[str], position: str, order: list[str], rank: str, size: str
) -> DataFrame:
    """Add ``rank`` (from 1) and ``size`` (rows of the group), both long.

    ``position`` is a double in [0, 1) that is spread evenly within every group; rows are ordered by it and then by
    ``order``. Null group values form a group of their own. Rows equal in all order columns get consecutive numbers
    in no fixed order among them. An empty ``group`` ranks the whole table. Names of helper columns begin with that of
    ``rank`` or with ``_ranks_``.
    """
    at, rows, start, inside_range = (f"{rank}{end}" for end in ("_range", "_in_range", "_start", "_inside"))
    if group:
        sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias(size))
        sized = _join_null_safe(df, sizes, group)
    else:
        sized = df.withColumn(size, F.lit(df.count()))
    ranges = F.least(F.ceil(F.col(size) / ROWS_PER_RANGE), F.lit(MAX_RANGES))
    cut = sized.withColumn(at, F.floor(F.col(position) * ranges))
    counts = cut.groupBy(*group, at).agg(F.count(F.lit(1)).alias(rows))
    before = Window.partitionBy(*group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, at, F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(*group, at).orderBy(position, *order)
    numbered = cut.withColumn(inside_range, F.row_number().over(inside))
    return (
        _join_null_safe(numbered, starts, [*group, at])
        .withColumn(rank, F.col(start) + F.col(inside_range))
        .drop(at, start, inside_range)
    )


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join on ``keys`` where null meets null; the keys stay once."""
    mine = [f"_ranks_key_{i}" for i in range(len(keys))]
    renamed = right.select(*(F.col(k).alias(name) for k, name in zip(keys, mine, strict=True)), *(c for c in right.columns if c not in keys))
    on = [left[k].eqNullSafe(renamed[name]) for k, name in zip(keys, mine, strict=True)]
    return left.join(renamed, on).drop(*mine)
