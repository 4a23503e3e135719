"""A hidden Markov language model: Baum-Welch over all training texts, exact likelihood by scaled forward recursion.

**Model.** A text is its words (runs of characters other than ASCII white space, A to Z in lower case) and one end
token. A chain of ``states`` latent states emits one token each; a state emits a *class* of words, and the class emits
the word: ``P(word | state) = P(class | state) * P(word | class)``. Classes are ``CLASSES`` ranges of the word hash and
one for the end, so the part of the model that is learnt by iteration has a fixed size, while every word keeps its own
count: ``P(word | class) = (count + 0.5) / (class total + 0.5 * (words of the class + 1))``, where unseen words share the
place of one more word. All probabilities sum to 1 over known words and "any unseen word of the class".

**Training.** Each pass of Baum-Welch runs the exact forward-backward recursion over every training text in tasks; what a
task hands on are expected counts (start, transitions, class emissions), which are summed in parallel by pieces. The
driver sees only these sums, whose size is fixed by ``states`` and ``CLASSES``.

**Word counts** follow the corpus and are never gathered. Texts are dealt into splits by a hash. Every task counts its
words per split; the counts meet by word, and each split gets back the words it asked for with their total counts.

**Long texts.** A text is cut into segments of ``SEGMENT`` tokens. The recursion over a segment is the product of its
scaled step matrices, computed for all segments at once; segments of a text are then chained. This is the recursion
itself, in another order of multiplication, so the likelihood is exact, and a batch takes ``SEGMENT`` steps, however long
its longest text is.

Results in edge cases: a null or empty text is one end token; a null id counts as an empty id text; equal rows are scored
alike and all returned; without training texts all counts are 0 and classes are uniform; an empty table gives an empty
table. Words are identified by 64-bit hashes (``hashing``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .arrow import give_back
from .hashing import binary_texts, mix, word_hashes

CLASSES = 1 << 14
END_CLASS = CLASSES
PAD = CLASSES + 1
SEGMENT = 128
# Steps between rescalings; emissions are at least SMOOTH-sized, so a product of so many stays a normal double.
RESCALE = 8
SPLIT_BYTES = 24 << 20
COUNT_BYTES = 16 << 20
FLUSH_WORDS = 2_000_000
BATCH_WORDS = 1 << 17


class Model(NamedTuple):
    """``start`` (states), ``step`` (states x states, rows sum to 1) and ``emit`` (classes + end x states)."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray

    def padded(self) -> np.ndarray:
        """Emissions with a last row of ones: a step over padding changes no likelihood."""
        return np.vstack([self.emit, np.ones((1, len(self.start)))])


def class_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CLASSES - 1)).astype(np.int32)


class Segments(NamedTuple):
    """Texts in rows of ``SEGMENT`` classes: the rows, of each text its first row and number of rows."""

    ids: np.ndarray
    first: np.ndarray
    rows: np.ndarray


def segments(classes: np.ndarray, counts: np.ndarray) -> Segments:
    """Lay out the word classes of texts (``counts`` words each), each followed by the end class."""
    tokens = counts + 1
    rows = -(-tokens // SEGMENT)
    first = np.concatenate([[0], np.cumsum(rows)[:-1]]).astype(np.int64)
    ids = np.full(int(rows.sum()) * SEGMENT, PAD, np.int32)
    starts = first * SEGMENT
    begin = np.cumsum(counts) - counts
    ids[np.arange(len(classes)) + np.repeat(starts - begin, counts)] = classes
    ids[starts + counts] = END_CLASS
    return Segments(ids.reshape(-1, SEGMENT), first, rows)


def transfer(model: Model, table: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row, the product of its step matrices, scaled, and the logarithm of the scale."""
    states = len(model.start)
    product = np.tile(np.eye(states), (len(ids), 1, 1))
    scale = np.zeros(len(ids))
    for at in range(SEGMENT):
        product = (product.reshape(-1, states) @ model.step).reshape(-1, states, states)
        product *= table[ids[:, at]][:, None, :]
        if at % RESCALE == RESCALE - 1:
            most = product.max(axis=(1, 2))
            product /= most[:, None, None]
            scale += np.log(most)
    return product, scale


def chain(model: Model, laid: Segments, product: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The forward vectors before each row (sum 1), and per text the logarithm of its likelihood without row scales."""
    before = np.empty((len(laid.ids), len(model.start)))
    total = np.zeros(len(laid.rows))
    vector = np.tile(model.start, (len(laid.rows), 1))
    live = np.arange(len(laid.rows))
    for at in range(int(laid.rows.max(initial=0))):
        live = live[laid.rows[live] > at]
        row = laid.first[live] + at
        before[row] = vector[live]
        after = np.einsum("nk,nkj->nj", vector[live], product[row])
        norm = after.sum(axis=1)
        total[live] += np.log(norm)
        vector[live] = after / norm[:, None]
    return before, total


def log_likelihoods(model: Model, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each text's sequence of classes, end included."""
    table, out = model.padded(), np.empty(len(counts))
    for at, upto, part in _batches(classes, counts):
        laid = segments(part, counts[at:upto])
        product, scale = transfer(model, table, laid.ids)
        _, total = chain(model, laid, product)
        out[at:upto] = total + np.add.reduceat(scale, laid.first)
    return out


def _batches(classes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Runs of texts with about ``BATCH_WORDS`` words."""
    ends = np.cumsum(counts + 1)
    at, word = 0, 0
    while at < len(counts):
        done = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + BATCH_WORDS, side="right")))
        size = int(counts[at:upto].sum())
        yield at, upto, classes[word : word + size]
        at, word = upto, word + size


def expected_counts(model: Model, classes: np.ndarray, counts: np.ndarray) -> Model:
    """The sums of Baum-Welch over some texts: expected starts, transitions and emissions."""
    states = len(model.start)
    table = model.padded()
    start, step, emit = np.zeros(states), np.zeros((states, states)), np.zeros((PAD + 1, states))
    for at, upto, part in _batches(classes, counts):
        laid = segments(part, counts[at:upto])
        # A text of one row hands on no vector.
        handing = np.ones(len(laid.ids), bool)
        handing[laid.first[laid.rows == 1]] = False
        product = np.ones((len(laid.ids), states, states))
        product[handing], _ = transfer(model, table, laid.ids[handing])
        before, _ = chain(model, laid, product)
        # Backward vectors after each row, from the last row of every text to its first.
        after = np.ones_like(before)
        last = laid.first + laid.rows - 1
        live = np.arange(len(last))
        for back in range(1, int(laid.rows.max(initial=0))):
            live = live[laid.rows[live] > back]
            row = last[live] - back + 1
            vector = np.einsum("nkj,nj->nk", product[row], after[row])
            after[row - 1] = vector / vector.max(axis=1)[:, None]
        # Inside the rows, all at once.
        seen = table[laid.ids.T]
        forward = np.empty((SEGMENT + 1, len(laid.ids), states))
        forward[0] = before
        for at_step in range(SEGMENT):
            vector = (forward[at_step] @ model.step) * seen[at_step]
            forward[at_step + 1] = vector / vector.sum(axis=1)[:, None] if at_step % RESCALE == RESCALE - 1 else vector
        backward = after
        for at_step in range(SEGMENT - 1, -1, -1):
            gamma = forward[at_step + 1] * backward
            # It takes the place of the forward vectors, which no earlier step needs.
            np.divide(gamma, gamma.sum(axis=1)[:, None], out=forward[at_step + 1])
            coming = seen[at_step] * backward
            real = laid.ids[:, at_step] != PAD
            backward = coming @ model.step.T
            weight = (forward[at_step] * backward).sum(axis=1)
            step += (forward[at_step] * (real / weight)[:, None]).T @ coming * model.step
            if at_step % RESCALE == 0:
                backward /= backward.max(axis=1)[:, None]
        # All steps at once: a count writes a place for every class, however few rows it adds up.
        column = laid.ids.T.ravel()
        for state in range(states):
            emit[:, state] += np.bincount(column, forward[1:, :, state].ravel(), PAD + 1)
        begin = before[laid.first] * backward[laid.first]
        start += (begin / begin.sum(axis=1)[:, None]).sum(axis=0)
    return Model(start, step, emit[:PAD])


def first_model(class_counts: np.ndarray, states: int, seed: int) -> Model:
    """Class shares of the whole corpus, moved apart at random; states last, on average, for ten tokens."""
    chance = np.random.default_rng(seed)
    shares = (class_counts + 0.5) / (class_counts + 0.5).sum()
    emit = shares[:, None] * np.exp(chance.normal(0, 0.5, (len(shares), states)))
    step = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(step, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), step, emit / emit.sum(axis=0))


def next_model(sums: Model, class_counts: np.ndarray, strength: float) -> Model:
    """The model that the expected counts imply; emissions lean on the corpus shares with ``strength`` counts."""
    shares = (class_counts + 0.5) / (class_counts + 0.5).sum()
    emit = sums.emit + strength * shares[:, None]
    step = sums.step + 0.1
    start = sums.start + 0.1
    return Model(start / start.sum(), step / step.sum(axis=1)[:, None], emit / emit.sum(axis=0))


def _is_training(doc_id: Column, folds: int, held_out: int) -> Column:
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(folds)) != held_out


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        yield batch, *word_hashes(binary_texts(batch.column("text")))


def _asked_words(splits: int, groups: int):
    """Of every task: its different words per split, with how often they occur in training texts.

    Rows are packed: one for a split and a group of words, which is a range of classes (and of further hash bits where
    there are more groups than classes).
    """
    ranges, finer = min(groups, CLASSES), -(-groups // CLASSES)

    def packed(split: np.ndarray, hashes: np.ndarray, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        group = class_of(hashes).astype(np.int64) * ranges // CLASSES * finer
        group += ((hashes >> np.uint64(40)) % np.uint64(finer)).astype(np.int64)
        order = np.lexsort((hashes, split, group))
        split, hashes, seen, group = split[order], hashes[order], seen[order], group[order]
        new = np.ones(len(order), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (split[1:] != split[:-1])
        at = np.flatnonzero(new)
        seen = np.add.reduceat(seen, at) if len(at) else seen
        split, hashes, group = split[at], hashes[at], group[at]
        cell = np.ones(len(at), bool)
        cell[1:] = (group[1:] != group[:-1]) | (split[1:] != split[:-1])
        bounds = [*np.flatnonzero(cell).tolist(), len(at)]
        rows = [
            (int(group[a]), int(split[a]), hashes[a:b].tobytes(), seen[a:b].tobytes())
            for a, b in zip(bounds[:-1], bounds[1:])
        ]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                ["part", "split", "words", "seen"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch, hashes, counts in _unpacked(batches):
            split = np.repeat(batch.column("split").to_numpy(), counts)
            training = np.repeat(batch.column("training").to_numpy(zero_copy_only=False).astype(np.int64), counts)
            held.append((split, hashes, training))
            size += len(hashes)
            if size >= FLUSH_WORDS:
                yield from packed(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            yield from packed(*map(np.concatenate, zip(*held)))
        del held
        give_back()

    return run


def _total_words(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one group of words: for each split its words with their counts in the corpus; and the group's class totals."""
    hashes = [np.frombuffer(words, np.uint64) for words in rows["words"]]
    known, place = np.unique(np.concatenate(hashes), return_inverse=True)
    seen = np.concatenate([np.frombuffer(value, np.int64) for value in rows["seen"]])
    total = np.bincount(place, seen, len(known)).astype(np.int64)
    in_training = total > 0
    classes = class_of(known[in_training])
    different = np.bincount(classes, minlength=CLASSES)
    tokens = np.bincount(classes, total[in_training], CLASSES).astype(np.int64)
    used = np.flatnonzero(different)
    ends = np.cumsum([len(part) for part in hashes])
    split_of = np.repeat(rows["split"].to_numpy(), [len(part) for part in hashes])
    out = []
    order = np.lexsort((place, split_of))
    split_of, place = split_of[order], place[order]
    new = np.ones(len(order), bool)
    new[1:] = (split_of[1:] != split_of[:-1]) | (place[1:] != place[:-1])
    split_of, place = split_of[new], place[new]
    bounds = [*np.flatnonzero(np.diff(split_of, prepend=-1)).tolist(), len(split_of)] if len(ends) else [0]
    for a, b in zip(bounds[:-1], bounds[1:]):
        out.append((int(split_of[a]), known[place[a:b]].tobytes(), total[place[a:b]].tobytes(), None))
    out.append((-1, used.astype(np.int64).tobytes(), tokens[used].tobytes(), different[used].astype(np.int64).tobytes()))
    return pd.DataFrame(out, columns=["split", "words", "total", "different"])


def _class_totals(totals: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and different training words of every class: at most ``CLASSES`` rows reach the driver."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for columns in zip(*(batch.column(name).to_pylist() for name in ("words", "total", "different"))):
                arrays = [pa.array(np.frombuffer(value, np.int64)) for value in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["class", "tokens", "different"])

    sums = (
        totals.filter("split = -1")
        .select("words", "total", "different")
        .mapInArrow(rows, "class long, tokens long, different long")
        .groupBy("class")
        .agg(F.sum("tokens").alias("tokens"), F.sum("different").alias("different"))
    )
    tokens, different = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for row in sums.collect():
        tokens[row["class"]], different[row["class"]] = row["tokens"], row["different"]
    return tokens, different


# Pieces of the emission sums; one more piece holds the start and the transition sums.
PIECES = 64


def _summed(partial: DataFrame) -> dict[int, np.ndarray]:
    """Add up binary vectors of doubles by piece, streaming; ``PIECES + 1`` rows reach the driver."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, value in zip(batch.column("piece").to_pylist(), batch.column("value").to_pylist()):
                part = np.frombuffer(value, np.float64)
                sums[piece] = sums[piece] + part if piece in sums else part.copy()
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                ["piece", "value"],
            )

    # A first round in many parts, then one row per piece and part is left to add.
    spread = partial.repartition("piece", "salt").select("piece", "value").mapInArrow(rows, "piece int, value binary")
    final = spread.repartition("piece").mapInArrow(rows, "piece int, value binary")
    return {row["piece"]: np.frombuffer(row["value"], np.float64) for row in final.collect()}


def _pass(training: DataFrame, model: Model) -> Model:
    """One pass of Baum-Welch over all training texts: the summed expected counts."""
    states = len(model.start)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, step, emit = np.zeros(states), np.zeros((states, states)), np.zeros((PAD, states))
        salt = None
        for _, hashes, counts in _unpacked(batches):
            salt = int(counts.sum() % 16) if salt is None else salt
            if len(counts):
                sums = expected_counts(model, class_of(hashes), counts)
                start, step, emit = start + sums.start, step + sums.step, emit + sums.emit
        if salt is not None:
            parts = [*np.array_split(emit, PIECES), np.vstack([start, step])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array([salt] * len(parts), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["piece", "salt", "value"],
            )
        give_back()

    sums = _summed(training.select("text").mapInArrow(rows, "piece int, salt int, value binary"))
    if not sums:
        return Model(np.zeros(states), np.zeros((states, states)), np.zeros((PAD, states)))
    emit = np.concatenate([sums[piece] for piece in range(PIECES)]).reshape(PAD, states)
    ends = sums[PIECES].reshape(states + 1, states)
    return Model(ends[0], ends[1:], emit)


def train(training: DataFrame, class_tokens: np.ndarray, states: int, passes: int, seed: int, strength: float = 50.0) -> Model:
    """Baum-Welch: ``passes`` passes over the column ``text``; ``class_tokens`` counts every class and the end."""
    model = first_model(class_tokens, states, seed)
    for _ in range(passes):
        model = next_model(_pass(training, model), class_tokens, strength)
    return model


def _scorer(model: Model, tokens: np.ndarray, different: np.ndarray, texts: int, all_tokens: int, vocabulary: int, held: list[str]):
    """Scores of one split: its texts meet the counts of its words."""

    def run(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if docs.empty:
            return pd.DataFrame(columns=[*held, "n_tokens", "n_known", "base_score", "score"])
        hashes, counts = word_hashes([None if text is None else text.encode("utf-8", "replace") for text in docs["text"]])
        words = np.concatenate([np.frombuffer(part, np.uint64) for part in known["words"]] or [np.zeros(0, np.uint64)])
        total = np.concatenate([np.frombuffer(part, np.int64) for part in known["total"]] or [np.zeros(0, np.int64)])
        order = np.argsort(words)
        seen = total[order][np.searchsorted(words[order], hashes)] if len(hashes) else np.zeros(0, np.int64)
        classes = class_of(hashes)
        place = np.repeat(np.arange(len(counts)), counts)
        share = np.log10((seen + 0.5) / (tokens[classes] + 0.5 * (different[classes] + 1)))
        base = np.log10((seen + 0.5) / (all_tokens + 0.5 * (vocabulary + 1)))
        end = math.log10((texts + 0.5) / (all_tokens + 0.5 * (vocabulary + 1)))

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.bincount(place, values, len(counts))

        out = docs[held].copy()
        out["n_tokens"] = counts + 1
        out["n_known"] = per_text(seen > 0).astype(np.int64) + int(texts > 0)
        out["base_score"] = per_text(base) + end
        out["score"] = log_likelihoods(model, classes, counts) / math.log(10) + per_text(share)
        return out

    return run


def score(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    states: int = 6,
    passes: int = 4,
    folds: int = 5,
    held_out: int = 1,
    seed: int = 0,
) -> DataFrame:
    """Score every text with a model of the texts whose id is not in the held-out fold.

    Returns the id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigram) and ``score``
    (this model), both as base-10 logarithms.
    """
    spark = docs.sparkSession
    training = _is_training(F.col(doc_id), folds, held_out)
    slim = docs.select(F.col(doc_id), F.col(text).cast("string").alias("text"), training.alias("training"))
    sizes = slim.agg(
        F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size"),
        F.sum(F.col("training").cast("long")).alias("texts"),
    ).first()
    size, texts = int(sizes["size"] or 0), int(sizes["texts"] or 0)
    splits, groups = -(-size // SPLIT_BYTES) or 1, -(-size // COUNT_BYTES) or 1
    # Texts are told apart by id and length; it only matters that both readings deal them alike.
    dealt = slim.withColumn("split", F.pmod(F.xxhash64(F.col(doc_id), F.octet_length("text")), F.lit(splits)).cast("long"))
    asked = dealt.select("text", "training", "split").mapInArrow(
        _asked_words(splits, groups), "part long, split long, words binary, seen binary"
    )
    totals = stored(
        spark,
        asked.groupBy("part").applyInPandas(_total_words, "split long, words binary, total binary, different binary"),
        "word-counts",
    )
    tokens, different = _class_totals(totals)
    all_tokens, vocabulary = int(tokens.sum()) + texts, int(different.sum()) + int(texts > 0)
    model = train(slim.filter("training"), np.append(tokens, texts), states, passes, seed)
    scorer = _scorer(model, tokens, different, texts, all_tokens, vocabulary, ["id", "training"])
    scored = (
        dealt.select(F.col(doc_id).cast("string").alias("id"), "training", "text", "split")
        .groupBy("split")
        .cogroup(totals.filter("split >= 0").select("split", "words", "total").groupBy("split"))
        .applyInPandas(
            scorer,
            "id string, training boolean, n_tokens long, n_known long, base_score double, score double",
        )
    )
    # Ids pass through the workers as text, so that no number is rounded beside a null.
    return scored.select(
        F.col("id").cast(docs.schema[doc_id].dataType).alias(doc_id),
        (~F.col("training")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
