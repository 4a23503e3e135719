"""Replay of a table as five-minute envelopes, and the way back from envelopes to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.numbers import nan_to_null
from ..operators.lists import paged_records
from ..sources import schemas

# Written with microseconds; readers accept any ISO fraction without being told.
TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def with_slot(df: DataFrame, time: str, width: str = "5 minutes") -> DataFrame:
    """Add the start of the time slot, ``window_start``; rows without a time belong to no slot."""
    return df.filter(F.col(time).isNotNull()).withColumn("window_start", F.window(time, width)["start"])


def without_time(df: DataFrame, time: str) -> DataFrame:
    """How many rows a replay leaves out because they have no time."""
    return df.agg(F.count_if(F.col(time).isNull()).alias("rows_without_time"))


def slot_counts(df: DataFrame, time: str, width: str = "5 minutes") -> DataFrame:
    """Rows per slot, counted in every task before the shuffle."""
    return with_slot(df, time, width).groupBy("window_start").agg(F.count(F.lit(1)).alias("num_records"))


def build_envelopes(df: DataFrame, time: str, width: str = "5 minutes", page_size: int = 1000) -> DataFrame:
    """``(window_start, num_records, records, page)``, in several parts where a slot holds very many rows.

    Readers explode the records, so it makes no difference to them in how many parts a slot comes.
    """
    fields = df.columns
    plain = [name for name, kind in df.dtypes if not kind.startswith("map")]
    slotted = with_slot(df, time, width).withColumn("_spread", F.xxhash64(*plain))
    paged = paged_records(slotted, ["window_start"], fields, page_size, "_spread")
    return paged.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.col("num_records").cast("int").alias("num_records"),
        "records",
        "page",
    )


def envelope_lines(envelopes: DataFrame) -> DataFrame:
    """One JSON text per envelope, with what to sort it by."""
    envelope = F.struct("window_start", "num_records", "records")
    return envelopes.select(F.to_json(envelope, TIME_FORMATS).alias("value"), "window_start", "page")


def publish(
    df: DataFrame, time: str, path: str, width: str = "5 minutes", page_size: int = 1000, files: int | None = None
) -> None:
    """Write the envelopes of a table as JSON lines, in slot order across and within files.

    ``files`` is the number of files; without it Spark chooses by size.

    NaN becomes NULL, which JSON has a word for.
    """
    numbers = {name: nan_to_null(name) for name, kind in df.dtypes if kind in ("double", "float")}
    clean = df.withColumns(numbers) if numbers else df
    lines = envelope_lines(build_envelopes(clean, time, width, page_size))
    # The page number in the range key lets one busy slot be written by several tasks.
    keys = ["window_start", "page"]
    ranged = lines.repartitionByRange(files, *keys) if files else lines.repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions("window_start", "page")
    ordered.select("value").write.mode("overwrite").text(path)


def read_envelopes(lines: DataFrame, record: StructType = schemas.STREAM_RECORD) -> DataFrame:
    """JSON lines (batch or stream, column ``value``) -> one row per record.

    A line that is no envelope yields no rows.
    """
    parsed = lines.select(F.from_json("value", schemas.envelope(record)).alias("envelope"))
    return parsed.select(F.explode("envelope.records").alias("record")).select("record.*")
