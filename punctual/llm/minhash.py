"""Near-duplicate documents by ProbMinHash, banding and exact verification.

**Signature.** A document is the weighted set of its runs of five words (A to Z in lower case), a run that occurs ``n``
times weighing ``1 + ln n``. Every element is a Poisson process whose rate is its weight: its arrivals, drawn from a
generator that the element's hash seeds, fall on one of ``REGISTERS`` registers each, and a register keeps the element
of its earliest arrival. Two documents agree on a register with the probability Jaccard similarity of their weighted
sets, which is the plain Jaccard similarity where weights are equal. An element is dropped as soon as its next arrival
comes after the latest of all registers, so all but the first few elements end at their first arrival.

**Candidates.** ``BANDS`` bands of ``ROWS`` registers; documents that agree on a band share a bucket. A text in which a
run occurs more than once has further bands, from the same arrivals with all weights 1: registers of these agree with the
plain Jaccard similarity, whatever is repeated. So of documents at a plain similarity of 0.8, one pair in 14,000 shares
no bucket. Without a repeated run both signatures are the same, and a band on which they agree is one bucket.

**Verification** compares the sets of runs themselves: a link is a plain Jaccard similarity of ``similarity`` or more.

1. Every member of a bucket is compared with the bucket's least member, once for each different pair. Verified pairs
   join components.
2. A bucket whose members are not in one component by then is *open*. In open buckets, every pair of members from
   different components is compared; the bucket is cut into blocks that meet pairwise (``blocks``), and pairs that
   became connected on the way are passed over. Open buckets with the same members are worked on once.

So every pair that shares a bucket is either verified, or connected by verified pairs. Pairs are never emitted for a
whole group: the first step has a pair for each member at most, the second a spanning tree for each block pair.

Exact copies are one node, named by the digest of the text, from the start; only slim rows of nodes are shuffled, and
texts only of documents that share a bucket.

Results in edge cases: null texts and texts without a word link with nothing and are kept; a text of one to four words
is a single run; the document with the smallest id of a component is kept (a null id only where all are null); of rows
equal in id and text one is kept; an empty table gives an empty table; helper columns start with ``_dup_``.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .arrow import give_back
from .blocks import block_pairs, in_block_pairs
from .components import connected
from .hashing import binary_texts, mix, word_hashes
from .words import WORD

WORDS = 5
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
BLOCK_ROWS = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)
# Texts of one task are worked on in runs of about so many words.
RUN_WORDS = 1 << 16


def shingles(texts: list[bytes | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``words`` words, repeats included, and the number of runs of each text."""
    hashes, counts = word_hashes(texts)
    runs = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    out = np.empty(int(runs.sum()), np.uint64)
    begin, to = np.cumsum(counts) - counts, np.cumsum(runs) - runs
    long = counts >= words
    place = np.repeat((begin - to)[long], runs[long])
    # Places in ``out`` of the runs of long texts, in order.
    target = np.repeat(to[long], runs[long]) + _within(runs[long])
    start = target + place
    rolled = hashes[start] if len(start) else np.zeros(0, np.uint64)
    for step in range(1, words):
        rolled = mix(rolled * _ODD + hashes[start + step])
    out[target] = rolled
    for at in np.flatnonzero((counts > 0) & ~long).tolist():
        value = np.array([counts[at]], np.uint64)
        for one in hashes[begin[at] : begin[at] + counts[at]]:
            value = mix(value * _ODD + one)
        out[to[at]] = value[0]
    return out, runs


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... anew for every size."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def weighted_sets(runs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different runs of each text: the text's place, the run's hash, and how often it occurs."""
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((runs, owner))
    owner, runs = owner[order], runs[order]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:] != runs[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], runs[at], np.diff(np.append(at, len(runs)))


def signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """``REGISTERS`` element hashes for each text; texts without elements keep zeros."""
    earliest = np.full(texts * REGISTERS, np.inf)
    kept = np.zeros(texts * REGISTERS, np.uint64)
    clock = np.zeros(len(elements))
    state = elements.copy()
    live = np.arange(len(elements))
    latest = np.full(texts, np.inf)
    while len(live):
        state[live] += _ODD
        drawn = mix(state[live])
        clock[live] -= np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)) / weights[live]
        live = live[clock[live] < latest[owner[live]]]
        register = (mix(state[live] ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) % np.uint64(REGISTERS)
        place = owner[live] * REGISTERS + register.astype(np.int64)
        np.minimum.at(earliest, place, clock[live])
        won = earliest[place] == clock[live]
        kept[place[won]] = elements[live[won]]
        touched = np.unique(owner[live])
        latest[touched] = earliest.reshape(texts, REGISTERS)[touched].max(axis=1)
        live = live[clock[live] < latest[owner[live]]]
    return kept.reshape(texts, REGISTERS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different for equal registers of different bands."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    keys = np.tile(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(signature), 1))
    for row in range(ROWS):
        keys = mix(keys * _ODD + parts[:, :, row])
    return keys


def bands_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The band keys of all texts in order, weighted and plain ones, and the number of keys of each text."""
    owner, elements, counts = weighted_sets(*shingles(texts))
    keys = band_keys(signatures(owner, elements, 1 + np.log(counts), len(texts)))
    again = np.zeros(len(texts), bool)
    again[owner[counts > 1]] = True
    inside = again[owner]
    place = (np.cumsum(again) - 1)[owner[inside]]
    plain = band_keys(signatures(place, elements[inside], np.ones(len(place)), int(again.sum())))
    other = plain != keys[again]
    text = np.repeat(np.arange(len(texts)), BANDS)
    text = np.concatenate([text, text.reshape(-1, BANDS)[again][other]])
    order = np.argsort(text, kind="stable")
    return np.concatenate([keys.reshape(-1), plain[other]])[order], np.bincount(text, minlength=len(texts))


def jaccard(first: np.ndarray, second: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays without repeats."""
    if not len(first) or not len(second):
        return 0.0
    place = np.minimum(np.searchsorted(first, second), len(first) - 1)
    common = int((first[place] == second).sum())
    return common / (len(first) + len(second) - common)


def _set_of(text: bytes) -> np.ndarray:
    return np.unique(shingles([text])[0])


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = binary_texts(batch.column("_dup_text"))
        at = 0
        while at < len(texts):
            size, upto = 0, at
            while upto < len(texts) and (upto == at or size < RUN_WORDS * 6):
                size += len(texts[upto])
                upto += 1
            keys, counts = bands_of(texts[at:upto])
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("_dup_node").slice(at, upto - at), lists], ["node", "bands"])
            at = upto
    give_back()


def _verified(similarity: float):
    """Pairs (first, second) with their texts, those that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[bytes, np.ndarray] = OrderedDict()

        def known(node: bytes, text: bytes) -> np.ndarray:
            found = recent.pop(node, None)
            recent[node] = found if found is not None else _set_of(text)
            if len(recent) > 64:
                recent.popitem(last=False)
            return recent[node]

        for batch in batches:
            first, second = batch.column("first").to_pylist(), batch.column("second").to_pylist()
            texts = zip(binary_texts(batch.column("first_text")), binary_texts(batch.column("second_text")))
            good = [jaccard(known(a, x), known(b, y)) >= similarity for a, b, (x, y) in zip(first, second, texts)]
            yield batch.select(["first", "second"]).filter(pa.array(good, pa.bool_()))
        recent.clear()
        give_back()

    return run


def _spanning(similarity: float):
    """A spanning tree of the links between different components in one block pair of an open bucket."""

    def run(rows: pa.Table) -> pa.RecordBatch | None:
        sets = [_set_of(text) for text in binary_texts(rows.column("text").combine_chunks())]
        nodes = rows.column("node").to_pylist()
        own, low, high = (rows.column(name).to_numpy() for name in ("own", "low", "high"))
        names: dict[bytes, int] = {}
        parent = [names.setdefault(root, at) for at, root in enumerate(rows.column("root").to_pylist())]
        parent = np.array(parent)
        sizes = np.array([len(one) for one in sets])
        edges = []
        for at in range(len(nodes)):
            other = np.arange(at + 1, len(nodes))
            if low[0] != high[0]:
                other = other[own[other] != own[at]]
            near = np.minimum(sizes[other], sizes[at]) >= similarity * np.maximum(sizes[other], sizes[at])
            for to in other[near & (parent[other] != parent[at])].tolist():
                if parent[to] != parent[at] and jaccard(sets[at], sets[to]) >= similarity:
                    edges.append((nodes[at], nodes[to]))
                    parent[parent == parent[to]] = parent[at]
        if not edges:
            return None
        return pa.RecordBatch.from_arrays([pa.array(side, pa.binary()) for side in zip(*edges)], ["first", "second"])

    return run


def _texts_of(nodes: DataFrame, least: DataFrame, named: DataFrame) -> DataFrame:
    """``node`` and ``text`` of some nodes; of several rows with the text, one with the least id (or a few equal ones)."""
    wanted = least.join(nodes, "node", "left_semi")
    rows = named.select(F.col("_dup_node").alias("node"), F.col("_dup_id").alias("id"), F.col("_dup_text").alias("text"))
    return rows.join(
        wanted.select(F.col("node").alias("_n"), F.col("least_id").alias("_i")),
        (F.col("node") == F.col("_n")) & F.col("id").eqNullSafe(F.col("_i")),
    ).select("node", "text")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = 0.8) -> DataFrame:
    """``docs`` with ``class_id``, the smallest id among its near-duplicates, and ``kept``."""
    spark = docs.sparkSession
    worded = F.coalesce(F.col(text).rlike(WORD), F.lit(False))
    node = F.when(worded, F.unhex(F.md5(F.encode(F.col(text).cast("string"), "UTF-8"))))
    base = docs.drop("class_id", "kept").withColumn("_dup_node", node)
    named = base.filter(F.col("_dup_node").isNotNull()).select(
        "_dup_node", F.col(doc_id).alias("_dup_id"), F.col(text).cast("string").alias("_dup_text")
    )
    least = stored(
        spark,
        named.groupBy(F.col("_dup_node").alias("node"), F.col("_dup_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("node")
        .agg(F.min("id").alias("least_id"), F.max("rows").alias("rows")),
        "texts",
    )
    banded = named.select("_dup_node", "_dup_text").mapInArrow(_band_rows, "node binary, bands array<long>")
    signed = stored(spark, banded.groupBy("node").agg(F.first("bands").alias("bands")), "bands")
    bucketed = signed.select("node", F.explode("bands").alias("bucket"))
    shared = bucketed.groupBy("bucket").agg(F.min("node").alias("second"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = stored(spark, bucketed.join(shared.drop("n"), "bucket"), "buckets")

    # Step 1: every member with the least one of its bucket.
    pairs = members.filter("node != second").select(F.col("node").alias("first"), "second").distinct()
    texts = stored(spark, _texts_of(members.select("node").distinct(), least, named), "candidate-texts")
    both = pairs.join(texts.select(F.col("node").alias("first"), F.col("text").alias("first_text")), "first").join(
        texts.select(F.col("node").alias("second"), F.col("text").alias("second_text")), "second"
    )
    near = both.mapInArrow(_verified(similarity), "first binary, second binary")
    roots = connected(near, "first", "second")

    # Step 2: buckets that are not in one component.
    rooted = members.join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    same = [F.count(F.lit(1)), F.min("node"), F.max("node"), F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64(F.lit(1), "node"))]
    fingerprints = rooted.groupBy("bucket").agg(
        F.min("root").alias("_from"), F.max("root").alias("_to"), *(one.alias(f"_f{at}") for at, one in enumerate(same))
    )
    open_buckets = fingerprints.filter("_from != _to").groupBy(*(f"_f{at}" for at in range(len(same)))).agg(F.min("bucket").alias("bucket"))
    open_members = rooted.join(open_buckets.select("bucket"), "bucket", "left_semi")
    dealt = block_pairs(open_members, "bucket", "node", BLOCK_ROWS).drop("bucket")
    further = in_block_pairs(dealt.join(texts, "node"), _spanning(similarity), "first binary, second binary")
    tree = roots.select(F.col("node").alias("first"), F.col("root").alias("second"))
    final = connected(tree.union(further), "first", "second")

    # Results per text, then per row.
    per_text = least.join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = per_text.groupBy("root").agg(F.min(F.struct(F.col("least_id").isNull(), "least_id", "node")).alias("_least"))
    joined = per_text.join(smallest, "root").select(
        F.col("node").alias("_dup_of"),
        F.col("_least.least_id").alias("class_id"),
        (F.col("_least.node") == F.col("node")).alias("_dup_chosen"),
        F.col("rows").alias("_dup_rows"),
    )
    result = base.join(joined, F.col("_dup_node") == F.col("_dup_of"), "left").withColumn(
        "class_id", F.coalesce("class_id", F.col(doc_id))
    )
    kept = F.coalesce(F.col("_dup_chosen") & F.col(doc_id).eqNullSafe(F.col("class_id")), F.lit(True))
    return result.withColumn("kept", kept).select(*base.columns, "class_id", "kept", "_dup_rows")


def mark(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = 0.8) -> DataFrame:
    """``docs`` with ``class_id`` and ``kept``; of rows equal in id and text, one is kept."""
    marked = classes(docs, doc_id, text, similarity)
    columns = [name for name in docs.columns if name not in ("class_id", "kept")] + ["class_id", "kept"]
    again = F.col("kept") & (F.coalesce("_dup_rows", F.lit(1)) > 1)
    if marked.filter(again).isEmpty():
        return marked.select(*columns)
    twice = marked.filter(again)
    keys = Window.partitionBy("_dup_node").orderBy(F.lit(0))
    first = twice.withColumn("kept", F.row_number().over(keys) == 1)
    return marked.filter(~again).union(first).select(*columns)
