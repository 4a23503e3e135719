"""Sources and sinks of the streaming jobs. Every sink has a checkpoint and survives a restart."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def file_stream(
    spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A folder that receives files, or a pattern for such folders and files, as a stream."""
    reader = spark.readStream.schema(schema).format(kind)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def append_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append-mode Parquet sink, exactly once; ends when all present input is read."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def per_batch_folders(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    change: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write every micro-batch to a folder of its own.

    A batch that is repeated after a failure overwrites its folder, so no row is written twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch={batch_id}"
        if change is None:
            batch.write.mode("overwrite").parquet(target)
            return
        # A change may read its batch several times.
        batch.persist()
        try:
            change(batch).write.mode("overwrite").parquet(target)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that a finished query left out because they came later than its watermark allows."""
    operators = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(state["numRowsDroppedByWatermark"] for state in operators)


def latest_state(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest version of each key in a table written batch by batch in update mode."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    return written.withColumn("_age", F.row_number().over(newest)).filter("_age = 1").drop("_age", "batch")
