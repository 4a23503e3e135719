"""Table profiles: describe per group, correlations, null counts, medians."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.dimensions import literal_table
from . import quantiles


def _long_form(wide: DataFrame, cells: Sequence[tuple[Sequence[Column], Column]], names: Sequence[str]) -> DataFrame:
    """One wide summary row -> one row per cell."""
    rows = [
        F.struct(*[label.alias(name) for label, name in zip([*labels, value], names)]) for labels, value in cells
    ]
    return wide.select(F.inline(F.array(*rows)))


def describe_groups(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """count, mean, std, min, 25 %, 50 %, 75 %, max per group (``quantiles.summarise`` says how)."""
    return quantiles.summarise(df, groups, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, moments=True)


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlations as rows ``(x, y, corr)``, both orders, diagonal included.

    One pass: every row gives one short row per pair, which each task adds up before the shuffle. (One aggregate with
    an expression per pair would be too long for the JVM to compile.) A column without spread has no correlation.
    """
    pairs = [(x, y) for at, x in enumerate(columns) for y in columns[at:]]
    cells = [
        F.struct(F.lit(at).alias("pair"), F.col(x).cast("double").alias("a"), F.col(y).cast("double").alias("b"))
        for at, (x, y) in enumerate(pairs)
    ]
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    sums = (
        df.select(F.inline(F.array(*cells)))
        .groupBy("pair")
        .agg(
            F.covar_pop("a", "b").alias("together"),
            F.stddev_pop(F.when(both, F.col("a"))).alias("spread_a"),
            F.stddev_pop(F.when(both, F.col("b"))).alias("spread_b"),
        )
    )
    corr = F.try_divide(F.col("together"), F.col("spread_a") * F.col("spread_b"))
    # Rounding errors may step over the limits; NULL stays NULL, which least and greatest would skip.
    corr = F.when(corr.isNotNull(), F.least(F.greatest(corr, F.lit(-1.0)), F.lit(1.0)))
    if digits is not None:
        corr = F.round(corr, digits)
    # Every pair has a row, also where the table has none.
    names = literal_table(df.sparkSession, list(enumerate(pairs)), "pair INT, names STRUCT<x: STRING, y: STRING>")
    named = names.join(sums, "pair", "left").select("names", corr.alias("corr"))
    other = F.struct(F.col("names.y").alias("x"), F.col("names.x").alias("y"))
    return named.select("corr", F.inline(F.array_distinct(F.array("names", other)))).select("x", "y", "corr")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls)`` for every column that has any NULL."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in columns])
    cells = [([F.lit(name)], F.col(f"`{name}`")) for name in columns]
    return _long_form(wide, cells, ["column", "nulls"]).filter("nulls > 0")


def column_medians(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """``(column, median)``; 0 for a column without values.

    The default is exact (``quantiles``). ``accuracy`` switches to a bounded-size sketch for
    measures with practically unlimited distinct values.
    """
    if accuracy is not None:
        wide = df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(c) for c in columns])
        cells = [([F.lit(c)], F.coalesce(F.col(c), F.lit(0.0))) for c in columns]
        return _long_form(wide, cells, ["column", "median"])
    names = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("_value")) for c in columns])
    medians = quantiles.summarise(df.select(F.inline(names)), ["column"], "_value", {"median": 0.5})
    wanted = literal_table(df.sparkSession, [(c,) for c in columns], "column STRING")
    return wanted.join(medians, "column", "left").select("column", F.coalesce("median", F.lit(0.0)).alias("median"))


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, nulls, minimum and maximum as text (NULL for columns with nested values)."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for at, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        aggregates.append(F.count_if(column.isNull()).alias(f"nulls{at}"))
        if field.dataType.typeName() not in ("array", "struct", "map"):
            aggregates += [F.min(column).cast("string").alias(f"min{at}"), F.max(column).cast("string").alias(f"max{at}")]
    wide = df.agg(*aggregates)
    rows = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col("rows"),
            F.col(f"nulls{at}").alias("nulls"),
            *[
                (F.col(f"{part}{at}") if f"{part}{at}" in wide.columns else F.lit(None).cast("string")).alias(part)
                for part in ("min", "max")
            ],
        )
        for at, field in enumerate(df.schema.fields)
    ]
    return wide.select(F.inline(F.array(*rows)))
