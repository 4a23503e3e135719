"""User functions: SQL-callable names for the column expressions, and a door for vectorised Python."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Each body is inlined by the optimizer, so a call costs the same as the expression itself.
SQL_FUNCTIONS = {
    "list_label": (
        "values ARRAY<STRING>",
        "STRING",
        "CASE WHEN values IS NULL OR size(values) = 0 THEN 'None' ELSE array_join(values, ',') END",
    ),
    "hhmm_minutes": ("hhmm INT", "INT", "CAST(floor(hhmm / 100) * 60 + hhmm % 100 AS INT)"),
    "weekend_flag": ("day DATE", "INT", "CASE WHEN weekday(day) >= 5 THEN 1 ELSE 0 END"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the session's SQL functions and return their names."""
    for name, (arguments, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return list(SQL_FUNCTIONS)


def register_vectorised(
    spark: SparkSession, name: str, function: Callable[..., pd.Series], result_type: str
) -> None:
    """Register a pandas function over Arrow batches, for logic that no built-in covers."""
    spark.udf.register(name, F.pandas_udf(function, result_type))
