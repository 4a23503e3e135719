"""Late rows of a stream kept aside, and added to the windows that were closed without them.

A row is late if its window ended at or before the watermark of its micro-batch: the greatest time of all earlier
batches, less the lateness. Every batch writes its rows in time, its late rows and its greatest time to folders of its
own, so a batch that is repeated after a failure overwrites its part and judges its rows by the same mark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import stored
from ..sources.files import read_parts, replace_parts

MARKS = T.StructType([T.StructField("mark", T.LongType()), T.StructField("batch", T.LongType())])


def split_late(stream: DataFrame, time: str, width: str, lateness_seconds: int, path: str, checkpoint: str) -> StreamingQuery:
    """Write the stream to ``path/on_time`` and ``path/late``, by micro-batch; ends when all present input is read.

    Rows without a time are in no window and not written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            mark = None
            if batch_id:
                marks = spark.read.schema(MARKS).parquet(f"{path}/marks")
                mark = marks.filter(F.col("batch") < batch_id).agg(F.max("mark")).first()[0]
            timed = batch.filter(F.col(time).isNotNull())
            ends = F.unix_micros(F.window(time, width)["end"].cast("timestamp"))
            is_late = F.lit(False) if mark is None else ends <= F.lit(mark - lateness_seconds * 1_000_000)
            for name, keep in (("on_time", ~is_late), ("late", is_late)):
                timed.filter(keep).write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
            seen = timed.agg(F.max(F.unix_micros(F.col(time).cast("timestamp"))).alias("mark"))
            seen.write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    )


def read_part(spark: SparkSession, path: str, name: str, schema: T.StructType) -> DataFrame:
    """The rows in time (``on_time``) or late (``late``), without the batch that they came in."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{path}/{name}").drop("batch")


def store_windows(windows: DataFrame, path: str, start: str = "window_start") -> None:
    """Store aggregates of closed windows, a folder per day of their start; days that come again are replaced."""
    replace_parts(windows.withColumn("window_day", F.to_date(start)), "window_day", path)


def merge_late(
    spark: SparkSession, path: str, late: DataFrame, keys: Sequence[str], sums: Mapping[str, Column] | Sequence[str], start: str = "window_start"
) -> None:
    """Add aggregates of late rows (same columns as the stored ones) to the stored windows.

    Only the days that the late rows fall on are read and replaced. ``sums`` names the columns that add up. Adding the
    same late rows twice counts them twice: do it once for each run of the stream.
    """
    new = late.withColumn("window_day", F.to_date(start))
    known = read_parts(spark, path)
    touched = known.join(new.select("window_day").distinct(), "window_day", "left_semi")
    names = list(sums)
    both = touched.select(*keys, start, *names, "window_day").unionByName(new.select(*keys, start, *names, "window_day"))
    merged = both.groupBy(*keys, start, "window_day").agg(*[F.sum(name).alias(name) for name in names])
    # The folders that are read are about to be replaced.
    replace_parts(stored(spark, merged, "merged-windows"), "window_day", path)


def windows(spark: SparkSession, path: str) -> DataFrame:
    return read_parts(spark, path).drop("window_day")
