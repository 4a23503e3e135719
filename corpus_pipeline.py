"""Corpus pipeline: quality rules, near-duplicates, mixing to target weights, byte-level BPE.

Every stage takes (session, documents, table folder) and gives a DataFrame; ``run`` writes each stage's rows as Parquet
to the shared folder and hands them on from there. All stages but the last keep the columns of ``documents``:

1. quality rules drop the documents that fail them;
2. near-duplicates keep one document of each group;
3. mixing drops documents that the mix leaves out and repeats those that it takes several times (up to three);
4. BPE adds ``ids`` (little-endian unsigned 32-bit), ``n_tokens`` and ``decoded_bytes``, the size of the decoded text.

Null or empty texts fail the quality rules, so later stages see none from here; each stage's module says what it does
with them when run alone. An empty ``documents`` table gives empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm import bpe, minhash, mixing, quality
from punctual.llm.queries import MIX_CEILING, RANKS, mixing_weight
from punctual.llm.words import word_count
from punctual.session import stored, tune


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return quality.passing(docs, rules=quality.EVERY_TEXT_RULES)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return minhash.mark(docs).filter("kept").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return mixing.mix(docs, "source", word_count(F.col("text")), ["doc_id"], mixing_weight(), MIX_CEILING)


def tokenize(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    rank_path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = bpe.encode_and_decode(docs, rank_path, pattern, decoded="decoded_bytes", sizes_only=True)
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    kept = [name for name in docs.columns if name not in ("ids", "n_tokens", "decoded_bytes")]
    return encoded.withColumn("n_tokens", n_tokens).select(*kept, "ids", "n_tokens", "decoded_bytes")


STAGES = [
    ("quality rules", keep_good),
    ("MinHash near-dedup", keep_one_of_each),
    ("mixing to target weights", mix_sources),
    ("byte-level BPE", tokenize),
]

# SQL has no ProbMinHash verification at this size and no BPE; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents`` in ``sf_dir``."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), "pipeline")
    return docs
