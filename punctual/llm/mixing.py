"""Mixing sources to target weights by subset-sum budget fitting.

``targets`` turns weights into word budgets per source, with a ceiling on repeats. ``fit`` then spends each budget:

1. Whole rounds: a budget of ``q`` times the source and a rest takes every document ``q`` times.
2. The documents of the source are counted by exact size. The rest takes the same share of each count, rounded down,
   so the mix keeps the source's distribution of sizes.
3. What is still open is filled from the largest size down, but for a last ``DP_WORDS``, which a bounded-knapsack
   dynamic program over the counts fills exactly, or as nearly as the sizes allow from below.
4. Of the documents of one size, the first in a seeded order are taken.

Only counts by size meet in a task: one row per different size of a source. The choice among equal sizes ranks rows in
ranges of a hash (``ranks``), so no source and no size is ever gathered. What is ranked are sizes and keys, not texts.

Results in edge cases: a null text has size 0; a null source is a source like any other; documents without words are
taken as often as whole rounds say, and cost nothing; equal rows are single documents; an empty table gives an empty
table; helper columns start with ``_mix_``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .ranks import ranked_in_groups, unit_interval

# The dynamic program covers budgets up to so many words; larger rests are filled greedily down to it.
DP_WORDS = 16384


def targets(sizes: DataFrame, source: str, weight: Column, ceiling: float, share: float = 1.0) -> DataFrame:
    """Budgets per source for a table of one row per source with a long column ``source_size``.

    ``weight`` is an expression on ``_mix_place``, the place (from 0) of the source by code point, null last. The
    budgets sum to ``share`` of all sizes; no source gets over ``ceiling`` times its size, and what it can't take goes
    to the others by weight. This is filling by level: with sources in the order of the level at which they are full,
    the full ones are a prefix, and one running sum finds its end. One row per source is sorted in a task.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    weighted = (
        sizes.withColumn("_mix_place", F.row_number().over(by_name) - 1)
        .withColumn("_mix_weight", weight.cast("double"))
        .withColumn("_mix_cap", F.lit(float(ceiling)) * F.col("source_size"))
        .withColumn("_mix_full", F.col("_mix_cap") / F.col("_mix_weight"))
    )
    up_to = Window.orderBy("_mix_full", "_mix_place").rowsBetween(Window.unboundedPreceding, -1)
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    open_budget = total - F.coalesce(F.sum("_mix_cap").over(up_to), F.lit(0.0))
    open_weight = F.sum("_mix_weight").over(everything) - F.coalesce(F.sum("_mix_weight").over(up_to), F.lit(0.0))
    # The first source that the level of those before it does not fill sets the level for itself and all after it.
    levelled = weighted.withColumn("_mix_level", open_budget / open_weight)
    level = F.min(F.when(F.col("_mix_level") <= F.col("_mix_full"), F.struct("_mix_full", "_mix_place", "_mix_level")))
    target = F.least(F.col("_mix_cap"), F.coalesce(level.over(everything)["_mix_level"] * F.col("_mix_weight"), F.col("_mix_cap")))
    return levelled.withColumn("target", target).select(source, "source_size", "target")


def knapsack(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each size to take, at most ``counts``, so that the sum is the largest possible up to ``budget``.

    Reachable sums are the bits of one number; a count is split into powers of two, so a size costs a few shifts.
    """
    full = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    for at, (size, count) in enumerate(zip(sizes, counts)):
        count = min(count, budget // size)
        bundle = 1
        while count > 0:
            bundle = min(bundle, count)
            steps.append((at, bundle, reach))
            reach |= (reach << (size * bundle)) & full
            count -= bundle
            bundle *= 2
        if reach >> budget & 1:
            break
    left = reach.bit_length() - 1
    taken = [0] * len(sizes)
    for at, bundle, before in reversed(steps):
        if not before >> left & 1:
            taken[at] += bundle
            left -= sizes[at] * bundle
    return taken


def spend(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each size to take for ``budget`` words; sizes are different and over 0."""
    whole = sum(size * count for size, count in zip(sizes, counts))
    budget = max(0, min(budget, whole))
    if budget == whole:
        return list(counts)
    taken = [count * budget // whole for count in counts]
    left = budget - sum(size * n for size, n in zip(sizes, taken))
    order = sorted(range(len(sizes)), key=lambda at: -sizes[at])
    for at in order:
        more = min(counts[at] - taken[at], max(0, left - DP_WORDS) // sizes[at])
        taken[at] += more
        left -= sizes[at] * more
    for at in order:  # a rest above the program's bound is left only where single sizes exceed it
        if left <= DP_WORDS:
            break
        more = min(counts[at] - taken[at], left // sizes[at])
        taken[at] += more
        left -= sizes[at] * more
    small = [at for at in order if sizes[at] <= left and counts[at] > taken[at]]
    for at, more in zip(small, knapsack([sizes[at] for at in small], [counts[at] - taken[at] for at in small], left)):
        taken[at] += more
    return taken


def _fit_source(histogram: pd.DataFrame) -> pd.DataFrame:
    first = histogram.iloc[0]
    source_size, target = int(first["source_size"]), float(first["target"])
    rounds = int(target // source_size) if source_size else 0
    rest = int(round(target - rounds * source_size))
    histogram = histogram.sort_values("_mix_size", ascending=False)
    real = histogram["_mix_size"] > 0
    extra = pd.Series(0, index=histogram.index)
    extra[real] = spend(histogram["_mix_size"][real].tolist(), histogram["_mix_count"][real].tolist(), rest)
    return pd.DataFrame(
        {
            "_mix_name": histogram["_mix_name"],
            "_mix_size": histogram["_mix_size"],
            "_mix_rounds": rounds,
            "_mix_extra": extra.astype("int64"),
        }
    )


def fit(
    docs: DataFrame, source: str, size: Column, keys: list[str], weight: Column, ceiling: int = 3, seed: int = 0
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies`` (how often the mix takes the document).

    ``size`` counts the words of a document, ``keys`` tell documents apart for the seeded order. Sizes and places in that
    order are stored and ranked without the documents, which then meet one row per source and size: its rounds and the
    place of the last document that is taken once more.
    """
    spark = docs.sparkSession
    base = docs.drop("size", "source_size", "target", "copies")
    sized = base.withColumn("size", size.cast("long"))
    hashed = F.xxhash64(F.lit(seed), *(F.col(key) for key in keys))
    place = {"_mix_at": unit_interval(hashed), "_mix_hash": hashed}
    place |= {f"_mix_key_{at}": F.col(key) for at, key in enumerate(keys)}
    places = [column.alias(name) for name, column in place.items()]
    slim = stored(spark, sized.select(F.col(source).alias("_mix_name"), F.col("size").alias("_mix_size"), *places), "mix-sizes")

    counts = slim.groupBy("_mix_name", "_mix_size").agg(F.count(F.lit(1)).alias("_mix_count"))
    totals = counts.groupBy("_mix_name").agg(F.sum(F.col("_mix_size") * F.col("_mix_count")).alias("source_size"))
    budgets = targets(totals, "_mix_name", weight, ceiling)
    known = budgets.select(F.col("_mix_name").alias("_mix_of"), "source_size", "target")
    of_source = F.col("_mix_name").eqNullSafe(F.col("_mix_of"))
    spent = counts.join(known, of_source).drop("_mix_of").groupBy("_mix_name").applyInPandas(
        _fit_source, f"_mix_name {dict(docs.dtypes)[source]}, _mix_size long, _mix_rounds int, _mix_extra long"
    )
    ranked = ranked_in_groups(slim, ["_mix_name", "_mix_size"], "_mix_at", list(place)[1:], "_mix_rank", "_mix_rows")
    ends = ranked.groupBy(
        F.col("_mix_name").alias("_mix_in"), F.col("_mix_size").alias("_mix_long"), F.struct(*place).alias("_mix_last")
    ).agg(F.min("_mix_rank").alias("_mix_first"), F.count(F.lit(1)).alias("_mix_tied"))
    is_end = (
        F.col("_mix_name").eqNullSafe(F.col("_mix_in"))
        & (F.col("_mix_size") == F.col("_mix_long"))
        & F.col("_mix_extra").between(F.col("_mix_first"), F.col("_mix_first") + F.col("_mix_tied") - 1)
    )
    # Of a stored table Spark knows the size: where it is small it goes to the documents.
    plan = stored(
        spark,
        spent.join(ends, is_end, "left")
        .withColumn("_mix_open", F.col("_mix_extra") - F.col("_mix_first") + 1)
        .join(known, of_source)
        .select("_mix_name", "_mix_size", "_mix_rounds", "_mix_last", "_mix_tied", "_mix_open", "source_size", "target"),
        "mix-plan",
    )

    own, last = F.col("_mix_own"), F.col("_mix_last")
    planned = sized.withColumn("_mix_own", F.struct(*places)).join(
        plan, F.col(source).eqNullSafe(F.col("_mix_name")) & (F.col("size") == F.col("_mix_size"))
    )
    chosen = planned.withColumn("_mix_more", F.coalesce(own <= last, F.lit(False)))
    if not plan.filter("_mix_open < _mix_tied").isEmpty():
        # Of rows equal in all keys at the last place, only some are taken.
        some = F.coalesce((own == last) & (F.col("_mix_open") < F.col("_mix_tied")), F.lit(False))
        number = F.row_number().over(Window.partitionBy(source, "size", "_mix_own").orderBy(F.lit(0)))
        cut = planned.filter(some).withColumn("_mix_more", number <= F.col("_mix_open"))
        chosen = chosen.filter(~some).unionByName(cut)
    copies = F.col("_mix_rounds") + F.col("_mix_more").cast("int")
    return chosen.withColumn("copies", copies).select(*base.columns, "size", "source_size", "target", "copies")


def mix(docs: DataFrame, source: str, size: Column, keys: list[str], weight: Column, ceiling: int = 3, seed: int = 0) -> DataFrame:
    """The mixed corpus: every document as often as ``fit`` takes it, with the columns of ``docs``."""
    fitted = fit(docs, source, size, keys, weight, ceiling, seed)
    times = F.sequence(F.lit(1), F.col("copies"))
    repeated = fitted.filter(F.col("copies") > 0).withColumn("_mix_copy", F.explode(times))
    return repeated.select(*docs.columns)


def cycling_weight(weights: list[int]) -> Column:
    """Weights that repeat along the sources in order."""
    return F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("_mix_place"), F.lit(len(weights))) + 1)
