"""Column-level reshaping that depends on which columns a table has."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; the others are not an error."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def strip_header_spaces(df: DataFrame) -> DataFrame:
    """Some published files carry a trailing space in a header name."""
    return rename_present(df, {name: name.strip() for name in df.columns if name != name.strip()})


def add_missing(df: DataFrame, columns: Iterable[str], value: float = 0.0) -> DataFrame:
    """Give every absent column a constant value."""
    absent = {name: F.lit(value) for name in columns if name not in df.columns}
    return df.withColumns(absent) if absent else df


def fill_nulls(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Fill nulls by column; entries for absent columns are ignored. The column type is kept."""
    types = dict(df.dtypes)
    wanted = {
        name: F.coalesce(F.col(name), F.lit(value).cast(types[name]))
        for name, value in fills.items()
        if name in types
    }
    return df.withColumns(wanted) if wanted else df


def prefix_struct(df: DataFrame, struct_column: str, prefix: str) -> DataFrame:
    """Replace a struct column by its fields, each named ``prefix`` + field."""
    kind = df.schema[struct_column].dataType
    assert isinstance(kind, StructType)
    fields = [F.col(struct_column)[name].alias(f"{prefix}{name}") for name in kind.fieldNames()]
    kept = [name for name in df.columns if name != struct_column]
    return df.select(*kept, *fields)


def replace_codes(df: DataFrame, column: str, names: Mapping[str, str], new_name: str | None = None) -> DataFrame:
    """Replace codes by names, unknown codes stay; optionally rename the column."""
    replaced = df.replace(dict(names), subset=[column])
    return replaced.withColumnRenamed(column, new_name) if new_name else replaced


def replace_codes_from(df: DataFrame, column: str, table: DataFrame, code: str, name: str) -> DataFrame:
    """The same for a code table too long for literals: one left join, unknown codes stay."""
    lookup = table.select(F.col(code).alias("_code"), F.col(name).alias("_name"))
    joined = df.join(lookup, F.col(column) == F.col("_code"), "left")
    return joined.withColumn(column, F.coalesce("_name", column)).drop("_code", "_name")


def tagged_union(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Stack tables with the same columns, each row tagged with its table's name. Keeps duplicates."""
    stacked = None
    for label, part in parts.items():
        part = part.withColumn(tag, F.lit(label))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked
