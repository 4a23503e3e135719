"""Work on pairs inside groups of any size: a group is cut into blocks, and each pair of blocks is one piece of work.

Members are dealt to ``ceil(size / block_rows)`` blocks by a hash. Block pair (i, j) meets in one place, so a piece of
work holds two blocks at most, every pair of members meets exactly once, and no pair is ever a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import give_back

PLACE = ["group", "low", "high", "own"]


def block_pairs(members: DataFrame, group: str, node: str, block_rows: int) -> DataFrame:
    """Members of groups with two rows or more, once per block pair they take part in.

    Adds ``group``, ``low`` and ``high`` (the blocks that meet) and ``own`` (the row's block).
    """
    sizes = members.groupBy(F.col(group).alias("group")).agg(F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    blocks = F.ceil(F.col("_size") / block_rows)
    own = F.pmod(F.xxhash64(F.lit(7), node), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    met = members.join(sizes, F.col(group) == F.col("group")).withColumn("own", own).withColumn("_other", other)
    return met.withColumns({"low": F.least("own", "_other"), "high": F.greatest("own", "_other")}).drop("_size", "_other")


def in_block_pairs(dealt: DataFrame, work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``work`` to all rows of each block pair, streaming through sorted partitions."""
    keys = ["group", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        held_key = None
        for batch in batches:
            columns = [batch.column(key).to_numpy(zero_copy_only=False) for key in keys]
            at = 0
            while at < batch.num_rows:
                key = tuple(int(column[at]) for column in columns)
                same = (columns[0][at:] == key[0]) & (columns[1][at:] == key[1]) & (columns[2][at:] == key[2])
                length = int(same.argmin()) if not same.all() else len(same)
                if key != held_key and held:
                    made = work(pa.Table.from_batches(held))
                    if made is not None:
                        yield made
                    held = []
                held_key = key
                held.append(batch.slice(at, length))
                at += length
        if held:
            made = work(pa.Table.from_batches(held))
            held = []
            if made is not None:
                yield made
        give_back()

    placed = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(run, schema)
