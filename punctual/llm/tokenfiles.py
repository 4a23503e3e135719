"""Flat token files: written end to end, and counted by a scan for end-of-document identifiers.

A flat token file is nothing but little-endian unsigned 32-bit ids, each document followed by the end id; no index says
where documents begin. ``write`` makes such files, ``scan`` finds the documents again.

The scan works on blocks of ``BLOCK_TOKENS`` ids. Each block is searched with one vectorised comparison, and gives its
number of ids and the places of its end ids. What a document has in earlier blocks follows from a prefix scan over the
blocks of its file: the running number of ids, and the place after the last end id so far.

Files go through Spark's readers and writers alone, so they may lie in any store that Spark reaches. ``write`` makes one
file per partition of its input, and a file is read by one task; Spark's reader takes files up to 2 GB.

Results in edge cases: a document without ids counts 0; ids after a file's last end id are a document of their own,
marked ``complete = false``; an empty file has no documents; bytes after the last whole id raise an error, as do ids
equal to the end id in ``write``; null ids are a document without ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .hashing import binary_texts, word_hashes

BLOCK_TOKENS = 1 << 16
# Id 0 ends a document; its four bytes are text characters, so Spark's text writer can put it after each row.
END_ID = 0


def hashed_word_ids(docs: DataFrame, text: str, ids: str, vocabulary: int = 1 << 20) -> DataFrame:
    """Replace the rows by one binary column ``ids``: each word's hash modulo ``vocabulary``, never the end id."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts = word_hashes(binary_texts(batch.column(0)))
            packed = (hashes % np.uint64(vocabulary - 1) + np.uint64(1)).astype("<u4").tobytes()
            ends = np.concatenate([[0], np.cumsum(counts)]) * 4
            made = [packed[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], [ids])

    return docs.select(text).mapInArrow(rows, f"`{ids}` binary")


def write(packed: DataFrame, ids: str, path: str) -> None:
    """Write the binary column ``ids`` (little-endian unsigned 32-bit) as flat token files, documents in row order."""
    end = "\0" * 4

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value and (np.frombuffer(value, "<u4") == END_ID).any():
                    raise ValueError("a document holds the end id")
            yield batch

    whole = packed.select(F.coalesce(F.col(ids), F.lit(b"")).alias(ids)).mapInArrow(checked, f"`{ids}` binary")
    # A cast keeps the bytes as they are; the writer adds the end id as its line separator.
    whole.select(F.col(ids).cast("string").alias("value")).write.option("lineSep", end).text(path)


def _blocks(spark: SparkSession, path: str, block_tokens: int, names: str | None) -> DataFrame:
    """One row per block: file, block number, ids in it, and the places of its end ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = content.as_buffer()
                if raw.size % 4:
                    raise ValueError(f"{name}: {raw.size} bytes are not a whole number of ids")
                tokens = np.frombuffer(raw, "<u4")
                for block, start in enumerate(range(0, len(tokens), block_tokens)):
                    part = tokens[start : start + block_tokens]
                    ends = np.flatnonzero(part == END_ID).astype("int32")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([block], pa.int64()), pa.array([len(part)], pa.int64()), pa.array([ends], pa.list_(pa.int32()))],
                        ["file", "block", "n", "ends"],
                    )

    reader = spark.read.format("binaryFile")
    files = (reader if names is None else reader.option("pathGlobFilter", names)).load(path)
    # The place below the folder that is read, or the whole path where that is a pattern.
    root = path.split(":", 1)[-1].rstrip("/") + "/"
    inside = F.instr("path", root)
    name = F.when(inside > 0, F.expr(f"substring(path, instr(path, '{_quoted(root)}') + {len(root)})")).otherwise(F.col("path"))
    named = files.select(name.alias("file"), "content")
    return named.mapInArrow(rows, "file string, block long, n long, ends array<int>")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def scan(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, names: str | None = None) -> DataFrame:
    """One row per document: ``file`` (its path below ``path``, whole where that is a pattern), ``document`` (its number in the file), ``start`` (place of its first id),
    ``n_tokens`` (without the end id) and ``complete``.

    ``names`` is a pattern for the names of the files to read, as ``*.bin``; without it all are read but hidden ones (names
    that begin with ``_`` or ``.``).
    """
    blocks = _blocks(spark, path, block_tokens, names)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("file").orderBy("block").rowsBetween(1, 1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    counted = blocks.withColumn("_before", before)
    after_end = F.when(F.size("ends") > 0, F.col("_before") + F.element_at("ends", -1) + 1)
    stitched = counted.withColumns(
        {
            "_open": F.coalesce(F.max(after_end).over(earlier), F.lit(0)),
            "_documents": F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)),
            "_is_last": F.count(F.lit(1)).over(later) == 0,
        }
    )
    file_end = F.col("_before") + F.col("n")
    starts = F.concat(F.array("_open"), F.transform("ends", lambda end: F.col("_before") + end + 1))
    stops = F.concat(F.transform("ends", lambda end: F.col("_before") + end), F.array(file_end))
    documents = F.arrays_zip(
        starts.alias("start"), stops.alias("stop"), F.sequence(F.lit(0), F.size("ends")).alias("at")
    )
    cut = stitched.select("file", "_documents", "_is_last", F.size("ends").alias("_ends"), F.explode(documents).alias("d"))
    # The last piece of a block goes on in the next one, unless the file ends there with ids left.
    complete = F.col("d.at") < F.col("_ends")
    return cut.filter(complete | (F.col("_is_last") & (F.col("d.stop") > F.col("d.start")))).select(
        "file",
        (F.col("_documents") + F.col("d.at")).alias("document"),
        F.col("d.start").alias("start"),
        (F.col("d.stop") - F.col("d.start")).alias("n_tokens"),
        complete.alias("complete"),
    )
