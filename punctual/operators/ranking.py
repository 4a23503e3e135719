"""Top-k per group and top-n of a result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _descending(metric: str, ties: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(metric), *map(F.col, ties)]


def top_k_per_group(
    df: DataFrame, groups: Sequence[str], metric: str, k: int, ties: Sequence[str], rank: str = "rank"
) -> DataFrame:
    """The k rows with the highest metric in each group, numbered from 1; ``ties`` decide equal metrics.

    The rank filter follows the window directly, so Spark cuts each partition to k rows per group
    (``WindowGroupLimit``) before the shuffle: a group that holds most rows costs no more than others.
    """
    window = Window.partitionBy(*groups).orderBy(*_descending(metric, ties))
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def top_n(df: DataFrame, metric: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The n rows with the highest metric; each task sends n rows at most."""
    return df.orderBy(*_descending(metric, ties)).limit(n)


def numbered_by_digest(
    df: DataFrame, groups: Sequence[str], digest: str | Column, number: str, digits: int = 3
) -> DataFrame:
    """Number the rows of each group from 1 in the order of a hexadecimal hash, however many rows there are.

    The leading ``digits`` of the hash cut a group into 16 to that power equal parts; rows are numbered inside their
    part, after the rows of the parts before it. Rows with equal hashes come in no fixed order. The hash is a column, or an
    expression of columns: then it is computed again behind the shuffle, which moves the number of the part in its place.
    """
    whole = F.col(digest) if isinstance(digest, str) else digest
    parted = df.withColumn("_part", F.conv(F.substring(whole, 1, digits), 16, 10).cast("int"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parted.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select(*groups, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    dealt = parted.repartition(*groups, "_part").withColumn("_order", whole)
    inside = F.row_number().over(Window.partitionBy(*groups, "_part").orderBy("_order"))
    joined = dealt.withColumn("_inside", inside).drop("_order").join(starts, [*groups, "_part"])
    return joined.withColumn(number, F.col("_start") + F.col("_inside")).drop("_part", "_inside", "_start")
