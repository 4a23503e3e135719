"""One new column from one old one, in Arrow batches; memory of Python workers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_ARROW = {"string": pa.string(), "binary": pa.binary()}


def give_back() -> None:
    """Hand the memory that a task has freed back to the system: Python workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def with_mapped(df: DataFrame, source: str, target: str, kind: str, change: Callable[[], Callable]) -> DataFrame:
    """Add ``target`` (of Spark type ``kind``, string or binary): ``change()`` applied to each value of ``source``.

    ``change`` is called once per task and gives the function for the values. A column named ``target`` is replaced.
    """
    kept = [name for name in df.columns if name != target]
    spark_type = {"string": T.StringType(), "binary": T.BinaryType()}[kind]
    schema = T.StructType([*(df.schema[name] for name in kept), T.StructField(target, spark_type)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = change()
        for batch in batches:
            made = pa.array([apply(value.as_py()) for value in batch.column(source)], _ARROW[kind])
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), made], [*kept, target])
        give_back()

    return df.mapInArrow(rows, schema)
