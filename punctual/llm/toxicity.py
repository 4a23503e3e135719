"""Toxicity by a weighted lexicon: folded texts, one Aho-Corasick pass, weights by length, exception phrases.

Folding lowers a text, brings it to its compatibility form, maps look-alike letters and digit substitutions to one plain
letter each (``i``, ``l``, ``1`` and ``|`` all become ``i``) and leaves single spaces between words. Lexicon entries live
in that folded space: a whole word, or a beginning that words share (an inflected stem).

``learn`` makes the lexicon from labelled texts. At most ``fit_rows`` of them are used (those with the smallest hashes of
their id, so reruns agree), and of the texts of a class whose five-word runs have the same smallest hash (three are
asked) only one, so that copies of a text don't make its words toxic. An entry is a word or beginning that is in
significantly more toxic than other texts; its weight is the log ratio of its rates per word, one standard error down.
A beginning stands for the longer entries that share it unless they weigh clearly more (``choose``). Two words, one of
them with an entry, that are in significantly more other texts give an exception phrase; further phrases can be given.
Within a phrase no word counts.

``score`` reads every whole text once. A word counts with its heaviest entry; what the sum exceeds the usual weight of a
harmless text of that length by, divided by the square root of the number of words plus ``LENGTH_SHIFT``, goes through a
logistic curve that was fitted to the same labelled texts.

Null and empty texts hold no word: their score is the curve at 0. Without labelled texts of both classes the lexicon is
empty and every score is the smoothed share of toxic labels. Several labels of one id count as toxic if any is; null
labels and null ids teach nothing. Rows that repeat are scored as often as they occur. Columns named ``score`` or
``predicted`` are replaced, all others are kept.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .words import word_count

# Letters of other scripts, digits and signs that stand in for a plain letter.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "з": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ѵ": "v",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɡ": "g", "ɑ": "a", "ʟ": "i", "ꜱ": "s", "ᴏ": "o", "ⅼ": "i",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e",
    "|": "i", "l": "i",
}
INVISIBLE = "­​‌‍⁠﻿"
_TABLE = {ord(a): b for a, b in LOOK_ALIKES.items()} | dict.fromkeys(map(ord, INVISIBLE))
_GAPS = re.compile(r"[\W_]+")

# At most so many labelled texts teach; at most so many entries and exception phrases are kept.
FIT_ROWS = 20_000
MAX_ENTRIES = 5_000
MAX_PHRASES = 5_000
# The strongest candidates that reach the driver before related beginnings are taken out.
MAX_CANDIDATES = 50_000
# Least likelihood ratio statistic (G) of an entry over the two classes, and of a phrase; least number of texts.
LEAST_G, LEAST_PHRASE_G, LEAST_TEXTS = 22.0, 15.0, 4
# Least weight of an entry; a longer entry stays beside a shorter one if it weighs so much more.
LEAST_WEIGHT, CLEARLY_MORE = 1.0, 0.7
BEGINNINGS = range(3, 13)
LENGTH_SHIFT = 20
# A task hands on its counts of candidates when it holds so many.
HELD_CANDIDATES = 100_000
CURVE_BINS = 2_000
COPY_KEYS = 3


def fold(text: str | None) -> str:
    """The folded words of ``text``, each between single spaces: " this is it "."""
    if not text:
        return " "
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower()
    return _GAPS.sub(" ", f" {text.translate(_TABLE)} ")


@dataclass(frozen=True)
class Lexicon:
    """``entries``: " stem" or " word " with its weight; ``phrases``: " two words ".

    ``usual`` is the weight that harmless texts hold per word; ``curve`` has the intercept and slope of the score.
    """

    entries: dict[str, float]
    phrases: frozenset[str] = frozenset()
    usual: float = 0.0
    curve: tuple[float, float] = (0.0, 1.0)

    def matcher(self) -> Matcher:
        return Matcher(self)


class Matcher:
    """The automaton of a lexicon, built once per worker task."""

    def __init__(self, lexicon: Lexicon):
        self.usual = lexicon.usual
        self.automaton = ahocorasick.Automaton()
        for key in {*lexicon.entries, *lexicon.phrases}:
            self.automaton.add_word(key, (len(key), lexicon.entries.get(key), key in lexicon.phrases))
        if lexicon.entries or lexicon.phrases:
            self.automaton.make_automaton()
        else:
            self.automaton = None

    def hits(self, folded: str) -> dict[int, float]:
        """The weight of each word that counts, by the place of the space before it."""
        best: dict[int, float] = {}
        covered: list[tuple[int, int]] = []
        for end, (size, weight, phrase) in self.automaton.iter(folded) if self.automaton else ():
            start = end - size + 1
            if weight is not None and weight > best.get(start, 0.0):
                best[start] = weight
            if phrase:
                covered.append((start, end))
        for start, end in covered:
            for at in [at for at in best if start <= at < end]:
                del best[at]
        return best

    def measured(self, text: str | None) -> tuple[float, int]:
        """The weight in a text, and its words."""
        folded = fold(text)
        return sum(self.hits(folded).values()), max(folded.count(" ") - 1, 0)

    def excess(self, text: str | None) -> float:
        """The weight beyond the usual, over the square root of the length."""
        weight, n_words = self.measured(text)
        return (weight - self.usual * n_words) / (n_words + LENGTH_SHIFT) ** 0.5


def _copy_keys(folded: str) -> list[int]:
    """The smallest hashes of the five-word runs under ``COPY_KEYS`` hash functions; near copies mostly share them."""
    words = folded.split()
    runs = [" ".join(words[i : i + 5]).encode() for i in range(max(len(words) - 4, 1))]
    return [min(crc32(run, seed) << 31 | crc32(run[::-1], seed) >> 1 for run in runs) for seed in range(COPY_KEYS)]


def _candidates(folded: str) -> Counter:
    found: Counter = Counter()
    for word, times in Counter(folded.split()).items():
        found[f" {word} "] += times
        for size in BEGINNINGS:
            if size > len(word):
                break
            found[f" {word[:size]}"] += times
    return found


_COUNTS = ["toxic", "other", "toxic_words", "other_words"]


def _counted(df: DataFrame, terms: Callable[[], Callable], label: str, totals: list[int]) -> DataFrame:
    """``term`` and its counts: texts (column ``text``) of each class that hold it, and how often they do.

    ``terms()`` is called once per task and gives a function from a text to the counts of its terms. ``totals`` are the
    texts of each class; ``g`` is the likelihood ratio statistic of the two shares of texts.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])

        def flush() -> pa.RecordBatch:
            made = [pa.array([four[i] for four in counts.values()], pa.int64()) for i in range(4)]
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *made], ["term", *_COUNTS])
            counts.clear()
            return batch

        find = terms()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column(label).to_pylist(), strict=True):
                for term, times in find(text).items():
                    four = counts[term]
                    four[1 - toxic] += 1
                    four[3 - toxic] += times
                if len(counts) >= HELD_CANDIDATES:
                    yield flush()
        yield flush()

    made = df.select("text", label).mapInArrow(rows, "term string, " + ", ".join(f"{name} long" for name in _COUNTS))
    summed = made.groupBy("term").agg(*(F.sum(name).alias(name) for name in _COUNTS))
    both = F.col("toxic") + F.col("other")
    share, n = F.lit(totals[0] / sum(totals)), sum(totals)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    cells = [
        part(F.col("toxic"), both * share),
        part(F.col("other"), both * (1 - share)),
        part(F.lit(totals[0]) - F.col("toxic"), (F.lit(n) - both) * share),
        part(F.lit(totals[1]) - F.col("other"), (F.lit(n) - both) * (1 - share)),
    ]
    return summed.withColumn("g", 2 * sum(cells[1:], cells[0])).withColumn("more_toxic", F.col("toxic") > both * share)


def weight_of(toxic: float, other: float, toxic_words: float, other_words: float) -> float:
    """Log ratio of two rates per word, one standard error down; half a word is added to each count."""
    ratio = math.log((toxic + 0.5) / (toxic_words + 1)) - math.log((other + 0.5) / (other_words + 1))
    return ratio - math.sqrt(1 / (toxic + 0.5) + 1 / (other + 0.5))


def choose(found: dict[str, tuple[int, int]], toxic_words: int, other_words: int) -> dict[str, float]:
    """Weighted entries among candidate words and beginnings, given how often each occurs in toxic and other texts.

    Longer ones come first. A shorter one takes the place of the entries that it begins if there are several of them
    or much besides them, and they don't weigh clearly more; otherwise it is left out. What it weighs counts only the
    words that no clearly heavier entry covers.
    """

    def weight(toxic: int, other: int) -> float:
        return weight_of(toxic, max(other, 0), toxic_words, other_words)

    chosen: dict[str, tuple[float, int, int]] = {}
    below: dict[str, set[str]] = defaultdict(set)
    for term in sorted(found, key=lambda term: (-len(term), term)):
        toxic, other = found[term]
        own, inside = weight(toxic, other), below.pop(term, set())
        heavier = {entry for entry in inside if chosen[entry][0] > own + CLEARLY_MORE}
        rest = [n - sum(chosen[entry][i] for entry in inside) for i, n in ((1, toxic), (2, other))]
        covers = len(inside) - len(heavier) >= 2 or rest[0] >= LEAST_TEXTS and weight(*rest) >= LEAST_WEIGHT
        if covers or not inside:
            left = [n - sum(chosen[entry][i] for entry in heavier) for i, n in ((1, toxic), (2, other))]
            if weight(*left) >= LEAST_WEIGHT:
                for entry in inside - heavier:
                    del chosen[entry]
                chosen[term] = (weight(*left), *left)
                inside = heavier | {term}
        stem = term[:-1]
        while len(stem) > 1 and stem not in found:
            stem = stem[:-1]
        if len(stem) > 1:
            below[stem] |= inside
    return {term: value[0] for term, value in chosen.items()}


def fit_curve(points: np.ndarray, toxic: np.ndarray, other: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Intercept and slope of a logistic curve by Newton steps; the slope is held down by ``ridge`` and never negative."""
    both, at = toxic + other, np.zeros(2)
    x = np.stack([np.ones_like(points), points], 1)
    at[0] = np.log((toxic.sum() + 0.5) / (other.sum() + 0.5))
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ at))
        slope = x.T @ (toxic - both * p) - [0, ridge * at[1]]
        bend = (x * (both * p * (1 - p))[:, None]).T @ x + np.diag([1e-9, ridge])
        step = np.clip(np.linalg.solve(bend, slope), -2, 2)
        at = at + step
        if np.abs(step).max() < 1e-10:
            break
    return float(at[0]), float(max(at[1], 0.0))


def fit_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` rows (``text``, ``toxic`` 0 or 1), one of each group of near copies; stored."""
    one = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    one = one.filter("toxic IN (0, 1)")
    # Bounded by the parameter: fit_rows ids and labels.
    picked = one.orderBy(F.xxhash64(key), key).limit(fit_rows).withColumnRenamed(key, "_fit_key")
    texts = docs.select(F.col(key).alias("_fit_key"), F.col(text).alias("text")).join(F.broadcast(picked), "_fit_key")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_copy_keys(fold(value.as_py())) for value in batch.column("text")]
            yield batch.append_column("copies", pa.array(keys, pa.list_(pa.int64())))

    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("toxic", T.IntegerType()), T.StructField("copies", T.ArrayType(T.LongType()))])
    keyed = stored(docs.sparkSession, texts.select("text", "toxic").mapInArrow(rows, schema), "toxicity-fit")
    for at in range(COPY_KEYS):  # one text of each class for each value of each key
        one = F.min_by(F.struct("text", "copies"), F.struct(F.xxhash64("text"), "text")).alias("one")
        keyed = keyed.groupBy(F.col("copies")[at].alias("copy"), "toxic").agg(one).select("toxic", "one.*")
    return stored(docs.sparkSession, keyed.select("text", "toxic"), "toxicity-fit")


def _usual(sample: DataFrame, entries: dict[str, float], phrases: frozenset[str]) -> float:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, sums = Lexicon(entries, phrases).matcher(), [0.0, 0.0]
        for batch in batches:
            for value in batch.column("text"):
                sums = [a + b for a, b in zip(sums, matcher.measured(value.as_py()), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.float64()) for total in sums], ["weight", "words"])

    total = sample.filter("toxic = 0").select("text").mapInArrow(rows, "weight double, words double")
    weight, words = total.agg(F.sum("weight"), F.sum("words")).first()
    return weight / words if words else 0.0


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    text: str = "text",
    label: str = "toxic",
    fit_rows: int = FIT_ROWS,
    phrases: Iterable[str] = (),
) -> Lexicon:
    """A lexicon from ``docs`` (``key``, ``text``) and ``labels`` (``key``, ``label`` of 0 or 1)."""
    sample = fit_sample(docs, labels, key, text, label, fit_rows)
    sizes = Counter({row.toxic: row["count"] for row in sample.groupBy("toxic").count().collect()})
    given = frozenset(fold(phrase) for phrase in phrases if fold(phrase).strip())
    prior = float(np.log((sizes[1] + 0.5) / (sizes[0] + 0.5)))
    if not sizes[0] or not sizes[1]:
        return Lexicon({}, given, 0.0, (prior, 0.0))

    totals = [sizes[1], sizes[0]]
    counted = _counted(sample, lambda: lambda value: _candidates(fold(value)), "toxic", totals)
    strong = counted.filter(F.col("more_toxic") & (F.col("g") >= LEAST_G) & (F.col("toxic") >= LEAST_TEXTS))
    top = strong.orderBy(F.desc("g"), "term").limit(MAX_CANDIDATES).collect()
    words = {row.toxic: row.words for row in sample.groupBy("toxic").agg(F.sum(word_count(F.col("text"))).alias("words")).collect()}
    weights = choose({row.term: (row.toxic_words, row.other_words) for row in top}, words[1], words[0])
    entries = dict(sorted(weights.items(), key=lambda one: (-one[1], one[0]))[:MAX_ENTRIES])

    def neighbours() -> Callable:
        matcher = Lexicon(entries).matcher()

        def pairs(value: str | None) -> Counter:
            folded = fold(value)
            found: Counter = Counter()
            for start in matcher.hits(folded):
                end = folded.index(" ", start + 1)
                before = folded.rfind(" ", 0, start) if start else -1
                after = folded.find(" ", end + 1)
                if before >= 0:
                    found[folded[before : end + 1]] += 1
                if after >= 0:
                    found[folded[start : after + 1]] += 1
            return found

        return pairs

    harmless = _counted(sample, neighbours, "toxic", totals).filter(~F.col("more_toxic") & (F.col("g") >= LEAST_PHRASE_G))
    learnt = frozenset(row.term for row in harmless.orderBy(F.desc("g"), "term").limit(MAX_PHRASES).collect()) | given
    usual = _usual(sample, entries, learnt)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Lexicon(entries, learnt, usual).matcher()
        for batch in batches:
            excess = np.array([matcher.excess(value.as_py()) for value in batch.column("text")], float)
            bins = np.clip(np.rint(excess * 100), -CURVE_BINS, CURVE_BINS).astype(int)
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int64()), batch.column("toxic")], ["bin", "toxic"])

    curve = sample.select("text", "toxic").mapInArrow(binned, "bin long, toxic int").groupBy("bin")
    rows = curve.agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other")).orderBy("bin").collect()
    bins, toxic, other = (np.array([row[i] for row in rows], float) for i in range(3))
    return Lexicon(entries, learnt, usual, fit_curve(bins / 100, toxic, other))


def score(df: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Add ``score`` (double in 0 to 1) and ``predicted`` (int: 1 from ``threshold`` on) to every row."""
    kept = [name for name in df.columns if name not in ("score", "predicted")]
    schema = T.StructType([*(df.schema[name] for name in kept), T.StructField("score", T.DoubleType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        intercept, slope = lexicon.curve
        for batch in batches:
            excess = np.array([matcher.excess(value.as_py()) for value in batch.column(text)], float)
            scores = 1 / (1 + np.exp(-np.clip(intercept + slope * excess, -700, 700)))
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), pa.array(scores, pa.float64())], [*kept, "score"])

    return df.mapInArrow(rows, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
