"""Keyed lists: sets of bounded domains, and record lists split into pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_values(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sorted distinct values per key, for values from a bounded domain (days, weeks, categories)."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(value)).alias(name))


def paged_records(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    page_size: int,
    spread: str,
    name: str = "records",
) -> DataFrame:
    """All records per key as sorted lists, in as many pages as the key needs.

    The row count of each key gives its number of pages; the integer column ``spread`` (an id or a hash)
    decides on which page a record goes. So a key with a third of all rows becomes many lists of about
    ``page_size`` records, built by many tasks, and no record is left out.
    """
    # Names of the table stay inside structs, so that no column name can clash with a helper's.
    slim = df.select(
        F.struct(*[F.col(key).alias(f"k{at}") for at, key in enumerate(keys)]).alias("_key"),
        F.struct(*fields).alias("_record"),
        F.col(spread).alias("_spread"),
    )
    page_count = F.ceil(F.count(F.lit(1)) / F.lit(page_size)).cast("long")
    sizes = slim.groupBy(F.col("_key").alias("_same")).agg(page_count.alias("_pages"))
    joined = slim.join(sizes, F.col("_key").eqNullSafe(F.col("_same"))).withColumn("_page", F.pmod("_spread", "_pages"))
    listed = joined.groupBy("_key", "_page", "_pages").agg(
        F.count(F.lit(1)).alias("_rows"), F.sort_array(F.collect_list("_record")).alias("_records")
    )
    return listed.select(
        *[F.col(f"_key.k{at}").alias(key) for at, key in enumerate(keys)],
        F.col("_page").alias("page"),
        F.col("_pages").alias("pages"),
        F.col("_rows").alias("num_records"),
        F.col("_records").alias(name),
    )
