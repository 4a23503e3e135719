"""The star-schema test tables, and the stand-in views that the named analyses run on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import times


# Declared column types save reading file footers on the driver before every query.
TABLES = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _late(value: Column) -> Column:
    """Delay causes are given only for legs that arrive 15 minutes late or later."""
    return F.when(F.col("l_quantity") - 25 >= 15, value)


def _whole(value: str) -> Column:
    """Percent as a whole number; adding zero turns -0.0 into 0.0."""
    return F.round(F.col(value) * 100) + F.lit(0.0)


def _calm(value: Column) -> Column:
    return F.when(F.col("p_size") % 10 != 0, value)


def _clouds() -> Column:
    return (
        F.when(F.col("p_type") == "PROMO", F.array().cast("array<string>"))
        .when(F.col("p_type") == "LARGE", F.lit(None).cast("array<string>"))
        .otherwise(F.split("p_name", " "))
    )


def _precipitation() -> Column:
    return F.when(F.col("p_size") % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("p_type"))


def _date() -> Column:
    return F.to_date("l_shipdate")


def _departure() -> Column:
    return ((F.col("l_partkey") % 24) * 100 + F.col("l_suppkey") % 60).cast("int")


def _arrival() -> Column:
    return (((F.col("l_partkey") + 2) % 24) * 100 + F.col("l_suppkey") % 60).cast("int")


def _size(expression: str, kind: str = "int") -> Column:
    return F.expr(expression).cast(kind)


# Leg column -> (dimension it needs, expression). "" stands for the line items alone.
LEG_COLUMNS: dict[str, tuple[str, Callable[[], Column]]] = {
    "leg_id": (
        "",
        lambda: F.expr(
            "l_orderkey * 1000003 + l_partkey * 8191 + l_suppkey * 131 + l_linenumber * 17 + CAST(l_quantity AS BIGINT)"
        ),
    ),
    "leg_date": ("", _date),
    "year": ("", lambda: F.year(_date())),
    "month": ("", lambda: F.month(_date())),
    "day_of_month": ("", lambda: F.dayofmonth(_date())),
    "day_of_week": ("", lambda: times.iso_weekday(_date())),
    "dep_hhmm": ("", _departure),
    "arr_hhmm": ("", _arrival),
    "time_block": ("", lambda: times.hour_block(_departure())),
    "dep_time": ("", lambda: times.hhmm_timestamp(_date(), _departure())),
    "arr_time": ("", lambda: times.hhmm_timestamp(_date(), _arrival())),
    "dep_delay": ("", lambda: F.col("l_quantity") - 20),
    "arr_delay": ("", lambda: F.col("l_quantity") - 25),
    "dep_delay_minutes": ("", lambda: F.greatest(F.col("l_quantity") - 20, F.lit(0.0))),
    "arr_delay_minutes": ("", lambda: F.greatest(F.col("l_quantity") - 25, F.lit(0.0))),
    "arr_del15": ("", lambda: F.when(F.col("l_quantity") - 25 >= 15, 1.0).otherwise(0.0)),
    "elapsed": ("", lambda: (F.col("l_linenumber") * 10 + 60).cast("double")),
    "weather_delay": ("", lambda: _late(_whole("l_discount"))),
    "carrier_delay": ("", lambda: _late(_whole("l_tax"))),
    "nas_delay": ("", lambda: _late(F.col("l_linenumber").cast("double"))),
    "security_delay": ("", lambda: _late((F.col("l_linenumber") % 2).cast("double"))),
    "diverted": ("", lambda: (F.col("l_returnflag") == "R").cast("int")),
    "carrier": ("orders", lambda: F.col("o_orderpriority")),
    "cancelled": ("orders", lambda: (F.col("o_orderstatus") == "P").cast("int")),
    "dep_del15": (
        "orders",
        lambda: F.when(
            F.col("o_orderstatus") != "P", F.when(F.col("l_quantity") - 20 >= 15, 1.0).otherwise(0.0)
        ),
    ),
    "operator": ("customer", lambda: F.col("c_mktsegment")),
    "dest_city": ("customer", lambda: F.col("dest_city")),
    "dest_key": ("customer", lambda: F.col("c_nationkey")),
    "origin_city": ("supplier", lambda: F.col("origin_city")),
    "origin_key": ("supplier", lambda: F.col("s_nationkey")),
    "late_aircraft_delay": ("part", lambda: _late(_size("p_size % 5", "double"))),
    "origin_wind_speed": ("part", lambda: _calm(_size("p_size % 30"))),
    "dest_wind_speed": ("part", lambda: _calm(_size("(p_size * 7) % 30"))),
    "origin_wind_direction": ("part", lambda: _calm(_size("(p_size * 10) % 360"))),
    "dest_wind_direction": ("part", lambda: _calm(_size("(p_size * 70) % 360"))),
    "origin_wind_gusts": ("part", lambda: F.when(F.col("p_size") % 4 == 0, _size("p_size % 30 + 10"))),
    "dest_wind_gusts": ("part", lambda: F.when(F.col("p_size") % 4 == 1, _size("(p_size * 7) % 30 + 10"))),
    "origin_visibility": (
        "part",
        lambda: F.when(F.col("p_size") % 7 != 0, _size("p_size % 12", "double")),
    ),
    "dest_visibility": (
        "part",
        lambda: F.when(F.col("p_size") % 7 != 1, _size("(p_size * 5) % 12", "double")),
    ),
    "origin_temperature": ("part", lambda: _size("p_size % 41 - 10", "double")),
    "dest_temperature": ("part", lambda: _size("(p_size * 3) % 41 - 10", "double")),
    "origin_dew_point": ("part", lambda: _size("p_size % 41 - 13", "double")),
    "dest_dew_point": ("part", lambda: _size("(p_size * 3) % 41 - 13", "double")),
    "origin_clouds": ("part", _clouds),
    "dest_clouds": ("part", lambda: F.reverse(_clouds())),
    "origin_precipitation": (
        "part",
        lambda: F.when(F.col("p_size") % 11 == 0, F.lit(None).cast("array<string>")).otherwise(_precipitation()),
    ),
    "dest_precipitation": (
        "part",
        lambda: F.when(F.col("p_size") % 5 == 0, F.lit(None).cast("array<string>")).otherwise(_precipitation()),
    ),
}


def legs(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Leg view with just the wanted columns and just the joins that these need.

    The dimensions are joined by their primary keys and as left joins, so leaving one out changes no row.
    Suppliers come first, so that a filter on the origin cuts the line items before they meet the orders.
    Customers and nations are joined to the orders, not to the larger line items.
    """
    needed = {LEG_COLUMNS[column][0] for column in columns}
    view = table(spark, folder, "lineitem")
    if "supplier" in needed:
        nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("origin_city"))
        supplier = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
        supplier = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"], "left")
        view = view.join(supplier, F.col("l_suppkey") == supplier["s_suppkey"], "left")
    if needed & {"orders", "customer"}:
        orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        if "customer" in needed:
            nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("dest_city"))
            customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
            customer = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left")
            orders = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
        view = view.join(orders, view["l_orderkey"] == orders["o_orderkey"], "left")
    if "part" in needed:
        part = table(spark, folder, "part").select("p_partkey", "p_name", "p_type", "p_size")
        view = view.join(part, F.col("l_partkey") == part["p_partkey"], "left")
    return view.select(*[LEG_COLUMNS[column][1]().alias(column) for column in columns])


def asof_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Purchases as legs, views as observations, users as stations."""
    events = table(spark, folder, "events")
    left = events.filter("event_type = 'purchase'").select(
        "event_id", F.col("user_id").alias("station"), F.col("ts").alias("leg_time")
    )
    observations = events.filter("event_type = 'view'").select(
        F.col("user_id").alias("station"), F.col("ts").alias("obs_time"), "value"
    )
    return left, observations


def raw_observation_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Report-like text lines derived from the events, for decoding and comparing with the numbers."""
    events = table(spark, folder, "events")
    line = F.expr(
        """
        CASE WHEN event_id % 97 = 96 THEN concat('??', CAST(event_id AS STRING)) ELSE concat(
            'K', lpad(CAST(user_id % 1000 AS STRING), 3, '0'), '\\t', date_format(ts, 'yyyy-MM-dd HH:mm'),
            '\\tK', lpad(CAST(user_id % 1000 AS STRING), 3, '0'), ' ', date_format(ts, 'ddHHmm'), 'Z ',
            CASE WHEN event_id % 13 = 0 THEN 'VRB' ELSE lpad(CAST(event_id % 36 * 10 AS STRING), 3, '0') END,
            lpad(CAST(event_id % 40 AS STRING), 2, '0'),
            CASE WHEN event_id % 4 = 0 THEN concat('G', CAST(event_id % 40 + 10 AS STRING)) ELSE '' END, 'KT ',
            CASE WHEN event_id % 11 = 0 THEN '1/2'
                 WHEN event_id % 11 = 1 THEN '1 1/2'
                 ELSE CAST(event_id % 10 + 1 AS STRING) END, 'SM ',
            element_at(array('', '-RA ', '+TSRA ', 'FG ', '-RA BR ', '', ''), CAST(event_id % 7 + 1 AS INT)),
            element_at(array('FEW020', 'SCT030', 'BKN040', 'OVC050', 'CLR'), CAST(event_id % 5 + 1 AS INT)), ' ',
            CASE WHEN event_id % 41 < 10 THEN concat('M', lpad(CAST(10 - event_id % 41 AS STRING), 2, '0'))
                 ELSE lpad(CAST(event_id % 41 - 10 AS STRING), 2, '0') END, '/',
            CASE WHEN event_id % 41 < 13 THEN concat('M', lpad(CAST(13 - event_id % 41 AS STRING), 2, '0'))
                 ELSE lpad(CAST(event_id % 41 - 13 AS STRING), 2, '0') END,
            ' A2992') END
        """
    )
    return events.select("event_id", line.alias("line"))
