"""Literal dimensions and code tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Airport number, weather station, time zone.
AIRPORTS = [
    (10397, "KATL", "America/New_York"),
    (11298, "KDFW", "America/Chicago"),
    (11292, "KDEN", "America/Denver"),
    (13930, "KORD", "America/Chicago"),
    (12892, "KLAX", "America/Los_Angeles"),
    (12478, "KJFK", "America/New_York"),
    (11057, "KCLT", "America/New_York"),
    (12889, "KLAS", "America/Los_Angeles"),
    (13204, "KMCO", "America/New_York"),
    (13303, "KMIA", "America/New_York"),
]

# Carrier code and carrier name.
CARRIER_NAMES = {
    "F9": "Frontier Airlines",
    "NK": "Spirit Airlines",
    "DL": "Delta Air Lines",
    "AA": "American Airlines",
    "UA": "United Airlines",
    "WN": "Southwest Airlines",
}


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table from Python rows. Spark knows the size of such a table and broadcasts it only below its threshold."""
    return spark.createDataFrame(list(rows), schema)


def airports(spark: SparkSession) -> DataFrame:
    return literal_table(spark, AIRPORTS, "AirportID INT, ICAO STRING, Timezone STRING")
