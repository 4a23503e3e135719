"""Exact quantiles per group by selection, and mergeable sketches of them per day.

**Exact.** No values are sorted, and none are gathered. A first aggregate counts values in cells: the values of a cell
agree in sign, in the power of two and in the 256th of it. A running count over the cells of a group (a bounded number)
tells in which one a wanted rank lies. Where that cell holds more than one value, its own range from least to greatest
value is cut into ``CELLS`` equal cells, and only the rows inside are counted again, until every wanted rank has met
its value; whole numbers are mostly done after the first aggregate, doubles after four at most. So a task holds counts
of at most ``CELLS`` cells per range however many values there are and however they are spread.

NaN counts as a value above all others, as in Spark's sort order; infinite values are values. Both have cells of their
own. NULL is no value.

**Sketches.** One KLL sketch per day and key, stored in a folder per day. A day that comes again replaces its folder, and
any set of days is merged without reading their rows (``sources.files.replace_parts`` and ``read_parts``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

PER_DOUBLING = 256
CELLS = 1 << 16
# Numbers of cells run from -(1100 + 1100) * 256 to the same above zero.
_END = 1 << 40


def _first_cell(value: Column) -> Column:
    """A number that grows with the value; equal for values of one sign in the same 256th of a power of two."""
    size = F.abs(value)
    octave = F.floor(F.log2(size))
    inside = F.floor((size / F.pow(F.lit(2.0), octave) - 1) * PER_DOUBLING)
    endless = F.isnan(value) | (size == float("inf"))
    # Doubles reach down to 2 to the -1074, so what is added here keeps all numbers above 0.
    number = F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * ((octave + 1100) * PER_DOUBLING + inside))
    ends = F.when(F.isnan(value), F.lit(_END + 1)).when(value > 0, F.lit(_END)).otherwise(F.lit(-_END))
    return F.when(endless, ends).otherwise(F.when(~endless, number).cast("long"))


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right`` with its ``names`` out of the way, and the null-safe equality of both sides' names."""
    moved = right.withColumnsRenamed({name: f"_r{at}" for at, name in enumerate(names)})
    same = F.lit(True)
    for at, name in enumerate(names):
        same = same & left[name].eqNullSafe(moved[f"_r{at}"])
    return moved, same


def cell_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Per group and cell: ``_n`` rows, ``_low`` and ``_high`` value, ``_mean``, ``_var`` (population). Stored."""
    rows = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    counted = rows.groupBy(*groups, _first_cell(F.col("_v")).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_v").alias("_low"),
        F.max("_v").alias("_high"),
        F.avg("_v").alias("_mean"),
        F.var_pop("_v").alias("_var"),
    )
    return stored(df.sparkSession, counted, "value-cells")


def _narrowed(open_ranks: DataFrame, cells: DataFrame, names: Sequence[str], kept: Sequence[str]) -> DataFrame:
    """Of every open rank the cell that it lies in: its least and greatest value and the rows before it."""
    before = Window.partitionBy(*names).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counted = cells.select(
        *names, "_n", F.col("_low").alias("_from"), F.col("_high").alias("_to"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_less")
    )
    moved, same = _same(open_ranks, counted, names)
    place = F.col("_rank") - F.col("_before")
    found = open_ranks.join(moved, same & (place >= F.col("_less")) & (place < F.col("_less") + F.col("_n")))
    return found.select(
        *kept, "_which", "_rank", F.col("_from").alias("_low"), F.col("_to").alias("_high"), (F.col("_before") + F.col("_less")).alias("_before")
    )


def select_ranks(df: DataFrame, groups: Sequence[str], value: str, cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """The value (``_value``) at each wanted rank: ``wanted`` has the groups, a label ``_which`` and ``_rank`` from 0."""
    spark, groups = df.sparkSession, list(groups)
    start = wanted.select(*groups, "_which", "_rank", F.lit(0).cast("long").alias("_before"))
    found = stored(spark, _narrowed(start, cells, groups, groups), "ranks")
    while True:
        settled, rest = found.filter("_low = _high"), found.filter("_low < _high")
        if rest.isEmpty():
            return found.select(*groups, "_which", F.col("_low").alias("_value"))
        names = [*groups, "_low"]
        ranges = rest.select(*groups, "_low", "_high").distinct()
        rows = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
        moved, same = _same(rows, ranges, groups)
        inside = rows.join(moved, same & (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))
        share = (F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low"))
        counted = inside.groupBy(*names, F.floor(share * CELLS).alias("_cell")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
        )
        # The range's own least value names it; the values of the cell take its place afterwards.
        cells = counted.withColumnRenamed("_low", "_range").withColumnsRenamed({"_least": "_low", "_most": "_high"})
        opened = rest.withColumnRenamed("_low", "_range")
        narrowed = _narrowed(opened, cells, [*groups, "_range"], groups)
        found = stored(spark, narrowed.unionByName(settled), "ranks")


def summarise(
    df: DataFrame, groups: Sequence[str], value: str, quantiles: Mapping[str, float], moments: bool = False
) -> DataFrame:
    """Linearly interpolated quantiles per group; with ``moments`` also count, mean, std (sample), min and max.

    Column names may be any. Groups without any value have no row. The standard deviation of one value is NULL. Next to infinite values or NaN,
    mean and std are what floating point makes of them (infinite or NaN); a quantile between two equal values is that
    value, also where both are infinite.
    """
    plain = [f"_g{at}" for at in range(len(groups))]
    named = df.select(*[F.col(name).alias(short) for name, short in zip(groups, plain, strict=True)], F.col(value).alias("_value"))
    if not groups:
        # One group of all rows, as a column that the optimizer doesn't see through: joins stay equi-joins.
        plain, named = ["_g0"], named.withColumn("_g0", F.pmod(F.hash("_value"), F.lit(1)))
    cells = cell_counts(named, plain, "_value")
    totals = cells.groupBy(*plain).agg(F.sum("_n").alias("_total"))
    fractions = F.array(*[F.struct(F.lit(at).alias("at"), F.lit(float(q)).alias("q")) for at, q in enumerate(quantiles.values())])
    asked = totals.select(*plain, "_total", F.explode(fractions).alias("_f"))
    place = (F.col("_total") - 1) * F.col("_f.q")
    ends = [(0, F.floor(place)), (1, F.ceil(place))]
    ranks = F.array(*[F.struct((F.col("_f.at") * 2 + up).alias("_which"), rank.cast("long").alias("_rank")) for up, rank in ends])
    values = select_ranks(named, plain, "_value", cells, asked.select(*plain, F.inline(ranks)))
    picked = values.groupBy(*plain).agg(
        *[F.max(F.when(F.col("_which") == which, F.col("_value"))).alias(f"_v{which}") for which in range(2 * len(quantiles))]
    )

    whole = Window.partitionBy(*plain)
    mean = F.sum(F.col("_n") * F.col("_mean")).over(whole) / F.sum("_n").over(whole)
    apart = F.col("_mean") - F.col("_all")
    # A cell of one value has no spread of its own, whatever rounding leaves.
    inner = F.when(F.col("_low") == F.col("_high"), 0.0).otherwise(F.col("_var"))
    summed = cells.withColumn("_all", mean).groupBy(*plain).agg(
        F.sum("_n").alias("_count"),
        F.max("_all").alias("_mean"),
        F.sum(F.col("_n") * (inner + apart * apart)).alias("_spread"),
        F.min("_low").alias("_min"),
        F.max("_high").alias("_max"),
    )
    moved, same = _same(summed, picked, plain)
    joined = summed.join(moved, same)
    results = []
    for at, (name, q) in enumerate(quantiles.items()):
        low, high = F.col(f"_v{2 * at}"), F.col(f"_v{2 * at + 1}")
        part = (F.col("_count") - 1) * F.lit(float(q))
        results.append(F.when(low == high, low).otherwise(low + (high - low) * (part - F.floor(part))).alias(name))
    keys = [F.col(short).alias(name) for name, short in zip(groups, plain[: len(groups)], strict=True)]
    if not moments:
        return joined.select(*keys, *results)
    std = F.sqrt(F.try_divide("_spread", F.col("_count") - 1)).alias("std")
    first = [F.col("_count").alias("count"), F.col("_mean").alias("mean"), std, F.col("_min").alias("min")]
    return joined.select(*keys, *first, *results, F.col("_max").alias("max"))


# ---------------------------------------------------------------- sketches

# Size of a sketch: with 400 the rank of a quantile is off by less than 1 % of the rows in 99 of 100 cases.
SKETCH_SIZE = 400


def daily_sketches(df: DataFrame, day: str, keys: Sequence[str], value: str, size: int = SKETCH_SIZE) -> DataFrame:
    """One sketch (``sketch``, binary) and ``rows`` per day and key, over finite values; others aren't in a sketch."""
    number = F.col(value).cast("double")
    real = df.filter(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < float("inf")))
    return real.groupBy(day, *keys).agg(F.kll_sketch_agg_double(number, size).alias("sketch"), F.count(F.lit(1)).alias("rows"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], quantiles: Mapping[str, float], size: int = SKETCH_SIZE) -> DataFrame:
    """Quantiles per key (empty: of all) from the sketches of any days, with ``rows``. No row of the days is read."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", size).alias("_sketch"), F.sum("rows").alias("rows"))
    found = [F.kll_sketch_get_quantile_double("_sketch", F.lit(float(q))).alias(name) for name, q in quantiles.items()]
    return merged.filter("rows > 0").select(*keys, "rows", *found)


def rank_errors(df: DataFrame, keys: Sequence[str], value: str, estimates: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """How far the rank of each estimate is from its quantile, as a share of the rows: ``(keys, quantile, rows, error)``.

    The error is 0 where the estimate's equal values reach over the wanted rank.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    moved, same = _same(rows, estimates.select(*keys, *quantiles), keys)
    joined = rows.join(moved, same)
    counts = [F.count(F.lit(1)).alias("rows")]
    for name in quantiles:
        counts += [F.count_if(F.col("_v") < F.col(name)).alias(f"_less_{name}"), F.count_if(F.col("_v") <= F.col(name)).alias(f"_upto_{name}")]
    counted = joined.groupBy(*keys).agg(*counts)
    cells = []
    for name, q in quantiles.items():
        wanted = F.lit(float(q)) * F.col("rows")
        off = F.greatest(F.col(f"_less_{name}") - wanted, wanted - F.col(f"_upto_{name}"), F.lit(0.0)) / F.col("rows")
        cells.append(F.struct(F.lit(name).alias("quantile"), off.alias("error")))
    return counted.select(*keys, "rows", F.inline(F.array(*cells)))
