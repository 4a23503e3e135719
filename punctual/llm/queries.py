"""The numbered operators, each bound to its whole test table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from ..session import scratch_path
from . import bpe, conversation, embeddings, hmm, htmltext, minhash, mixing, quality, sharding, tokenfiles, toxicity, urlfilter, whitening
from .oracles import ORACLES
from .words import word_count

SHARDS = 40


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


RANKS = "byte_bpe_multi_50k.tiktoken"
MIX_WEIGHTS, MIX_CEILING = [5, 2, 1], 3


def hidden_markov_scores(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.score(_read(spark, folder, "documents").select("doc_id", "text"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text", "lang")
    judged = quality.judge(docs, rules=quality.EVERY_TEXT_RULES)
    counts = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
    return judged.select("doc_id", *counts, "base_failed", "kept")


def stratified_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``rows``: shard sizes differ by one row at most; equal texts are dealt like different ones."""
    slim = _read(spark, folder, "documents").select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    dealt = sharding.assign_shards(slim, "source", ["doc_id", "text_crc32", "size"], SHARDS)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def separator_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as a flat file of hashed word ids, and the documents that the scan finds in it."""
    ids = tokenfiles.hashed_word_ids(_read(spark, folder, "documents"), "text", "ids")
    path = scratch_path(spark, "token-files")
    tokenfiles.write(ids, "ids", path)
    return tokenfiles.scan(spark, path)


# Parts of host names that the filter list names.
LISTED_TERMS = ["casino", "bets", "pills", "ads-"]
LIST_START = 1704067200  # 2024-01-01 in UTC


def list_entries(domains: DataFrame) -> DataFrame:
    """Dated list entries for the domains (column ``domain``) that hold a listed term, and for a quarter of the others.

    A domain is blocked on a day that its length gives, some are allowed again and some blocked once more; the English
    part of some is allowed for good.
    """
    n = F.length("domain")

    def entry(key: Column, action: str, day: Column, when: Column) -> Column:
        since = F.timestamp_seconds(LIST_START + day * 86400)
        return F.when(when, F.struct(key.alias("key"), F.lit(action).alias("action"), since.alias("since")))

    listed = domains.filter(F.col("domain").rlike("|".join(LISTED_TERMS)) | (n % 4 == 0))
    made = F.array(
        entry(F.col("domain"), urlfilter.BLOCK, n * 5 % 60, F.lit(True)),
        entry(F.col("domain"), urlfilter.ALLOW, n + 60, n % 2 == 0),
        entry(F.col("domain"), urlfilter.BLOCK, n + 120, n % 3 == 0),
        entry(F.concat("domain", F.lit("/en")), urlfilter.ALLOW, n % 30 + 30, n % 5 < 2),
    )
    return listed.select(F.explode(F.filter(made, lambda one: one.isNotNull())).alias("one")).select("one.*")


def temporal_url_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as captures spread over half a year, judged by dated list entries for their own hosts."""
    seconds = F.lit(LIST_START) + F.pmod(F.col("page_id") * 7919, F.lit(180 * 86400))
    captures = _read(spark, folder, "pages").select("page_id", "url", F.timestamp_seconds(seconds).alias("fetched"))
    domain = F.regexp_replace(urlfilter.host_of(F.col("url")), r"^(www|m|blog)\.", "")
    entries = list_entries(captures.select(domain.alias("domain")).distinct())
    judged = urlfilter.evaluate(captures, urlfilter.intervals(entries))
    return judged.select(
        "page_id",
        "url",
        F.unix_timestamp("fetched").alias("fetched_s"),
        "matched_key",
        F.unix_timestamp("matched_from").alias("matched_from_s"),
        "kept",
    )


def line_block_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = htmltext.extract(_read(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def mixing_weight() -> Column:
    return mixing.cycling_weight(MIX_WEIGHTS)


def subset_sum_mixture(spark: SparkSession, folder: str) -> DataFrame:
    slim = _read(spark, folder, "documents").select("doc_id", "source", word_count(F.col("text")).alias("words"))
    fitted = mixing.fit(slim, "source", F.col("words"), ["doc_id"], mixing_weight(), MIX_CEILING)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return fitted.select("doc_id", "size", "source_size", "target", taken, "source", "copies")


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.mark(_read(spark, folder, "documents").select("doc_id", "text")).drop("text")


def collision_counting(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.link(_read(spark, folder, "embeddings"), "vec_id", "embedding", "label", threshold=0.98)


def byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    rank_path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_and_decode(docs, rank_path, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def weighted_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from the labels of two thirds of the ids and scores all documents."""
    held_out = F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1, F.lit(False))
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    labels = _read(spark, folder, "labels").filter(~held_out).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.learn(docs, labels, "doc_id"))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def incremental_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_read(spark, folder, "embeddings"), "vec_id", "embedding", components=8)


def survivor_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations with the faults that the ids and turns give, repaired."""
    rows = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    known = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    fate = F.crc32(F.encode(F.concat(known[0], F.lit(":"), known[1]), "UTF-8")) % 20
    faulty = conversation.damaged(rows, "conv_id", "turn", "role", "text", fate)
    return conversation.digests(conversation.edits(faulty, keys=rows.select("conv_id")))


QUERIES = {
    "op1_hidden_markov_scores": hidden_markov_scores,
    "op2_stratified_shards": stratified_shards,
    "op3_separator_scan": separator_scan,
    "op4_quality_rules": quality_rules,
    "op5_temporal_url_lists": temporal_url_lists,
    "op6_line_block_text": line_block_text,
    "op7_prob_minhash": near_duplicates,
    "op8_subset_sum_mixture": subset_sum_mixture,
    "op9_collision_counting": collision_counting,
    "op10_byte_level_bpe": byte_level_bpe,
    "op11_weighted_lexicon": weighted_lexicon,
    "op12_incremental_whitening": incremental_whitening,
    "op13_survivor_viterbi": survivor_viterbi,
}

__all__ = ["ORACLES", "QUERIES"]
