"""The named analyses, bound to the test tables: ``QUERIES[name](spark, folder)``.

Results that hold dates, timestamps or lists give them as text, so that they can be compared between
engines without type conversions in between.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text, times
from ..functions import observations as decode
from ..functions.registry import register_sql_functions
from ..operators import asof, bitmaps, intervals, joins, profile, quantiles, rolling as days, shaping, timeframes
from ..session import scratch_path, stored
from ..sources import files, observations, schemas
from ..sources.tables import LEG_COLUMNS, asof_sides, legs, raw_observation_lines, table
from ..streaming import enrichment, envelopes, late, live, rolling, scoring, sinks
from . import delays, enrich, evaluation, features, lookup, model, weather

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Names for some of the stand-in carriers; the last two stay as they are, like unknown codes.
CARRIER_NAMES = {"1-URGENT": "Urgent Air", "2-HIGH": "High Air", "3-MEDIUM": "Medium Air"}
ONE_ORIGIN = "NATION_7"
REGION_PART = "_1"
# A destination and day with legs in every test folder.
ONE_DEST, ONE_DAY = "NATION_10", "1998-03-17"
PAGE_SIZE = 1000
MAX_AGE_SECONDS = 7 * 86_400


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _list_text(column: str):
    return F.array_join(F.col(column).cast("array<string>"), ",").alias(column)


# ---------------------------------------------------------------- delays


@query
def dest_delay_avg(spark, folder):
    return delays.delay_by_destination(legs(spark, folder, "dest_city", "dep_delay", "arr_delay"))


@query
def dest_delay_top10(spark, folder):
    return delays.worst_destinations(legs(spark, folder, "dest_city", "dep_delay", "arr_delay"))


@query
def carrier_worst_dest_top3(spark, folder):
    view = legs(spark, folder, "carrier", "dest_city", "cancelled", "arr_delay")
    return delays.worst_destinations_per_carrier(view, CARRIER_NAMES)


@query
def carrier_summary(spark, folder):
    return delays.carrier_summary(legs(spark, folder, "carrier", "cancelled", "arr_delay"), CARRIER_NAMES)


@query
def carrier_cause_share(spark, folder):
    view = legs(spark, folder, "carrier", "cancelled", "diverted", "arr_delay", *delays.CAUSES.values())
    return delays.cause_share(view, CARRIER_NAMES)


@query
def carrier_delay_per_leg(spark, folder):
    view = legs(spark, folder, "carrier", "cancelled", "diverted", "carrier_delay")
    return delays.carrier_delay_per_leg(view, CARRIER_NAMES)


@query
def weekday_delay(spark, folder):
    return delays.delay_by_weekday(
        legs(spark, folder, "day_of_week", "cancelled", "diverted", "arr_delay", "arr_del15")
    )


@query
def weather_month_dest(spark, folder):
    view = legs(spark, folder, "month", "dest_city", "leg_date", "weather_delay")
    return delays.weather_delay_by_month(view).withColumn("weeks", _list_text("weeks"))


@query
def weather_time_block(spark, folder):
    return delays.weather_delay_by_block(legs(spark, folder, "time_block", "weather_delay"))


@query
def weather_time_block_domain(spark, folder):
    """The same question with the blocks taken from another table: arrival blocks of all legs."""
    view = legs(spark, folder, "time_block", "weather_delay")
    blocks = legs(spark, folder, "arr_hhmm").select(times.hour_block("arr_hhmm").alias("time_block"))
    return delays.weather_delay_over_domain(view, blocks)


@query
def origin_counts(spark, folder):
    return delays.count_by(legs(spark, folder, "origin_city"), "origin_city")


@query
def region_pair_counts(spark, folder):
    view = legs(spark, folder, "origin_city", "dest_city", "elapsed")
    return delays.pair_counts(delays.touching(view, REGION_PART, "origin_city", "dest_city"))


@query
def region_origin_counts(spark, folder):
    view = delays.touching(legs(spark, folder, "origin_city"), REGION_PART, "origin_city")
    return delays.count_by(view, "origin_city")


@query
def region_origin_delay(spark, folder):
    view = legs(spark, folder, "origin_city", "dest_city", "arr_delay_minutes")
    touching = delays.touching(view, REGION_PART, "origin_city", "dest_city")
    return delays.average_by(touching, "origin_city", "arr_delay_minutes", "avg_arr_delay")


@query
def region_month_counts(spark, folder):
    view = legs(spark, folder, "year", "month", "origin_city", "dest_city")
    touching = delays.touching(view, REGION_PART, "origin_city", "dest_city")
    return delays.count_by(touching, "year", "month", "origin_city")


def _from_one_origin(spark, folder, *columns):
    return legs(spark, folder, "origin_city", *columns).filter(F.col("origin_city") == ONE_ORIGIN)


@query
def monthly_delay_pct(spark, folder):
    return delays.monthly_delay_share(_from_one_origin(spark, folder, "year", "month", "arr_delay_minutes"))


@query
def season_counts(spark, folder):
    return delays.season_counts(_from_one_origin(spark, folder, "year", "month"))


@query
def date_range(spark, folder):
    span = delays.date_range(legs(spark, folder, "leg_date"))
    return span.select(*[times.day_text(c).alias(c) for c in span.columns])


@query
def month_delay_total(spark, folder):
    return delays.total_by_month(_from_one_origin(spark, folder, "month", "dep_delay_minutes"))


@query
def carrier_delay_describe(spark, folder):
    described = delays.describe_by_carrier(_from_one_origin(spark, folder, "carrier", "dep_delay_minutes"))
    return described.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query
def route_baseline(spark, folder):
    keys = ["origin_city", "dest_city", "carrier"]
    view = legs(spark, folder, *keys, "leg_date", "arr_delay")
    result = delays.route_baseline(view, keys)
    return result.select(*keys, times.day_text("leg_date").alias("leg_day"), "day_rows", "prior_avg")


@query
def incremental_rolling_delay(spark, folder):
    """The rolling delay from stored daily totals after four loads: incomplete early months, the others, the early ones
    corrected, and the others once more."""
    path, keys = scratch_path(spark, "daily-totals"), ["origin_city"]
    view = legs(spark, folder, *keys, "leg_date", "arr_delay", "leg_id").withColumn("month", F.trunc("leg_date", "month"))
    early = F.col("leg_date") < "1994-01-01"
    for part in (view.filter(early & (F.col("leg_id") % 3 == 0)), view.filter(~early), view.filter(early), view.filter(~early)):
        files.replace_parts(days.daily_totals(part, [*keys, "month"], "leg_date", "arr_delay"), "month", path)
    result = days.rolling_from_totals(files.read_parts(spark, path).drop("month"), keys, "leg_date")
    return result.select("origin_city", times.day_text("leg_date").alias("leg_day"), "day_rows", "rolling_avg")


@query
def rolling_delay(spark, folder):
    result = delays.rolling_delay(legs(spark, folder, "origin_city", "leg_date", "arr_delay"), ["origin_city"])
    return result.select("origin_city", times.day_text("leg_date").alias("leg_day"), "day_rows", "rolling_avg")


@query
def delay_distribution(spark, folder):
    return delays.delay_distribution(legs(spark, folder, "carrier", "arr_delay"))


# ---------------------------------------------------------------- weather


def _combination(spark, folder, role):
    view = legs(spark, folder, "weather_delay", *[f"{role}_{field}" for field in weather.COMBINATION])
    result = weather.delay_by_combination(view, role)
    lists = (f"{role}_precipitation", f"{role}_clouds")
    return result.withColumns({c: text.list_label(c, null_label=None) for c in lists})


@query
def weather_combo_origin(spark, folder):
    return _combination(spark, folder, "origin")


@query
def weather_combo_dest(spark, folder):
    return _combination(spark, folder, "dest")


@query
def wind_bucket_mph(spark, folder):
    return weather.delay_by_wind_mph(legs(spark, folder, "origin_wind_speed", "weather_delay"))


@query
def visibility_bucket(spark, folder):
    return weather.share_by_visibility(legs(spark, folder, "origin_visibility", "weather_delay"))


@query
def cloud_delay_dest(spark, folder):
    return weather.delay_by_cloud(legs(spark, folder, "dest_clouds", "weather_delay"))


@query
def cloud_delay_origin(spark, folder):
    return weather.delay_share_by_cloud(legs(spark, folder, "origin_clouds", "arr_del15", "weather_delay"))


@query
def wind_bucket_origin_kt(spark, folder):
    view = legs(spark, folder, "origin_wind_speed", "weather_delay")
    return weather.share_by_wind_knots(view, "origin_wind_speed")


@query
def wind_bucket_dest_kt(spark, folder):
    return weather.share_by_wind_knots(legs(spark, folder, "dest_wind_speed", "weather_delay"), "dest_wind_speed")


@query
def dest_wind_delay(spark, folder):
    return weather.destination_wind(legs(spark, folder, "dest_city", "dest_wind_speed", "arr_del15"))


@query
def precip_delay(spark, folder):
    view = legs(spark, folder, "origin_precipitation", "arr_del15", "arr_delay")
    return weather.delay_by_precipitation(view, "origin_precipitation")


@query
def dest_precip_frequency(spark, folder):
    return weather.precipitation_frequency(legs(spark, folder, "dest_city", "dest_precipitation", "arr_del15"))


# ---------------------------------------------------------------- profiles

MEASURES = (
    "dep_hhmm",
    "arr_hhmm",
    "dep_delay",
    "dep_delay_minutes",
    "arr_delay",
    "arr_delay_minutes",
    "elapsed",
    "carrier_delay",
    "weather_delay",
    "nas_delay",
    "security_delay",
    "late_aircraft_delay",
)
FEATURE_NUMBERS = features.STAND_IN.numbers


@query
def delay_corr_matrix(spark, folder):
    return profile.correlation_matrix(_from_one_origin(spark, folder, *MEASURES), MEASURES, digits=6)


@query
def null_profile(spark, folder):
    return profile.null_profile(legs(spark, folder, *LEG_COLUMNS))


@query
def column_medians(spark, folder):
    return profile.column_medians(legs(spark, folder, *FEATURE_NUMBERS), FEATURE_NUMBERS)


@query
def table_profile(spark, folder):
    return profile.profile_table(legs(spark, folder, *LEG_COLUMNS))


QUARTILES = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
RANK_BOUND = 0.02


@query
def exact_route_quantiles(spark, folder):
    """Quartiles of a measure with as many values as rows, per destination and of all legs."""
    view = legs(spark, folder, "dest_city", "leg_id").withColumn("share", F.col("leg_id") / 1000003.0)
    parts = {"each": quantiles.summarise(view, ["dest_city"], "share", QUARTILES), "all": quantiles.summarise(view, [], "share", QUARTILES)}
    return parts["each"].unionByName(parts["all"].withColumn("dest_city", F.lit("all"))).select(
        "dest_city", *[F.round(name, 6).alias(name) for name in QUARTILES]
    )


@query
def sketch_rank_error(spark, folder):
    """Quantiles per carrier from stored sketches per month: whether their rank is within the bound of the exact one.

    The early months are stored twice, the first time without most of their legs, as a corrected load would.
    """
    view = legs(spark, folder, "carrier", "leg_date", "leg_id").select(
        "carrier", F.trunc("leg_date", "month").alias("month"), F.sqrt(F.col("leg_id") % 999_983 + 0.5).alias("share"), "leg_id"
    )
    path, early = scratch_path(spark, "sketches"), F.col("month") < "1994-01-01"
    for part in (view.filter(early & (F.col("leg_id") % 5 == 0)), view.filter(~early), view.filter(early)):
        files.replace_parts(quantiles.daily_sketches(part, "month", ["carrier"], "share"), "month", path)
    found = quantiles.merged_quantiles(files.read_parts(spark, path), ["carrier"], QUARTILES)
    errors = quantiles.rank_errors(view, ["carrier"], "share", found, QUARTILES)
    return errors.select("carrier", "quantile", "rows", (F.col("error") <= RANK_BOUND).alias("within_bound"))


# ---------------------------------------------------------------- stations, observations, roles


@query
def station_timeframes(spark, folder):
    view = legs(spark, folder, "origin_city", "dest_city", "dep_time")
    frames = timeframes.station_timeframes(view, {"Origin": "origin_city", "Destination": "dest_city"}, "dep_time")
    return frames.select(
        "station",
        "role",
        times.second_text("window.start").alias("window_start"),
        times.second_text("window.end").alias("window_end"),
        times.second_text("start_date").alias("start_date"),
        times.second_text("end_date").alias("end_date"),
        "records",
    ).orderBy("station", "window_start", "role")


@query
def observation_requests(spark, folder):
    """Frames of departures in UTC; the stand-in time zone of a nation is a fixed number of hours west."""
    view = legs(spark, folder, "origin_city", "dest_city", "origin_key", "dep_time")
    utc = view.withColumn("dep_utc", times.local_to_utc("dep_time", _zone("origin_key")))
    frames = timeframes.station_timeframes(utc, {"Origin": "origin_city", "Destination": "dest_city"}, "dep_utc")
    return timeframes.observation_requests(frames)


def _zone(nation_key):
    return F.format_string("-%02d:00", (F.col(nation_key) % 4 + 5).cast("int"))


@query
def legs_in_timeframes(spark, folder):
    """How many departures from a station the responses of each archive request cover; responses overlap.

    A response reaches from a day before the first departure of its timeframe to a day after the last. Every nation
    also has one response over fifty years.
    """
    # Read by the timeframes and by the count, so the joins behind it are done once.
    view = stored(spark, legs(spark, folder, "origin_city", "dest_city", "dep_time", "arr_delay"), "frame-legs")
    frames = timeframes.station_timeframes(view, {"Origin": "origin_city", "Destination": "dest_city"}, "dep_time")
    responses = frames.select(
        "station",
        "role",
        times.second_text("window.start").alias("window_start"),
        times.shift_days("start_date", -1).alias("first"),
        times.shift_days("end_date", 1).alias("last"),
    )
    forever = table(spark, folder, "nation").select(
        F.col("n_name").alias("station"),
        F.lit("all").alias("role"),
        F.lit("").alias("window_start"),
        F.expr("TIMESTAMP_NTZ'1960-01-01 00:00:00'").alias("first"),
        F.expr("TIMESTAMP_NTZ'2010-01-01 00:00:00'").alias("last"),
    )
    # Of a stored table Spark knows the size: few responses go to the legs, not the legs, once per width, to the responses.
    known = stored(spark, responses.unionByName(forever), "responses")
    covered = intervals.join_containing(
        view.select("origin_city", "dep_time", "arr_delay"), known, {"origin_city": "station"},
        "dep_time", "first", "last", {"role": "role", "window_start": "window_start"},
    )
    return covered.groupBy(F.col("origin_city").alias("station"), "role", "window_start").agg(
        F.count(F.lit(1)).alias("num_legs"),
        F.sum("arr_delay").alias("arr_delay_total"),
        times.second_text(F.min("dep_time")).alias("first_departure"),
        times.second_text(F.max("dep_time")).alias("last_departure"),
    )


# The columns of a published leg that the test tables can fill; the others are empty in the file.
CSV_LEG = {
    "OriginAirportSeqID": "l_orderkey",
    "Flight_Number_Operating_Airline": "l_linenumber",
    "OriginAirportID": "10000 + s_nationkey",
    "DestAirportID": "CASE WHEN l_linenumber = 7 THEN 1 ELSE 10000 + c_nationkey END",
    "FlightDate": "date_add(DATE'2024-01-01', CAST(l_orderkey % 30 AS INT))",
    "Year": "2024",
    "Month": "1",
    "DayofMonth": "CAST(l_orderkey % 30 AS INT) + 1",
    "CRSDepTime": "CAST(l_partkey % 24 * 100 + l_suppkey % 60 AS INT)",
    "CRSArrTime": "CAST((l_partkey + 2) % 24 * 100 + l_suppkey % 60 AS INT)",
    "ArrDelay": "l_quantity - 25",
}


@query
def enrich_legs(spark, folder):
    """The whole enrichment job: CSV legs and raw report text to files, read, joined in both roles, stored, read back.

    Columns of the CSV file stand in reverse order, one with a blank after its name. Nations are the airports; a
    seventh leg of an order goes to an unknown airport and is left out.
    """
    legs_path, raw_path, seen, out = (scratch_path(spark, name) for name in ("csv-legs", "raw-text", "observations", "enriched-legs"))
    source = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    cells = [
        (F.expr(CSV_LEG[field.name]) if field.name in CSV_LEG else F.lit(None)).cast(field.dataType).alias(
            f"{field.name} " if field.name == "ArrDelay" else field.name
        )
        for field in reversed(schemas.LEG.fields)
    ]
    source.select(*cells).write.option("header", True).csv(legs_path)
    raw_observation_lines(spark, folder).select("line").write.text(raw_path)
    airports = table(spark, folder, "nation").select(
        (F.col("n_nationkey") + 10000).alias("AirportID"),
        F.format_string("K%03d", "n_nationkey").alias("ICAO"),
        _zone("n_nationkey").alias("Timezone"),
    )
    enriched = enrich.run(spark, legs_path, raw_path, seen, out, airports, dest_at_arrival=True)
    return enriched.select(
        F.col("OriginAirportSeqID").alias("order_key"),
        F.col("Flight_Number_Operating_Airline").alias("line"),
        F.col("OriginICAO").alias("origin"),
        F.col("DestICAO").alias("dest"),
        times.second_text("CRSDepTimestamp").alias("departure"),
        times.second_text("CRSArrTimestamp").alias("arrival"),
        F.col("ArrDelay").alias("arr_delay"),
        *[
            (F.array_join(f"{role}{name}", ",") if name in ("Precipitation", "Clouds") else F.col(f"{role}{name}")).alias(
                f"{role.lower()}_{_snake(name)}"
            )
            for role in ("Origin", "Dest")
            for name in decode.WEATHER_FIELDS
        ],
    )


@query
def sched_timestamps(spark, folder):
    view = table(spark, folder, "lineitem").select(
        F.to_date("l_shipdate").alias("leg_date"),
        F.expr("CAST(l_partkey % 26 * 100 + l_suppkey % 70 AS INT)").alias("hhmm"),
        "l_orderkey",
        "l_linenumber",
    )
    return view.select(
        "l_orderkey",
        "l_linenumber",
        "hhmm",
        times.second_text(times.hhmm_timestamp("leg_date", "hhmm")).alias("scheduled"),
        times.second_text(times.hhmm_timestamp("leg_date", "hhmm", roll_2400=True)).alias("scheduled_rolled"),
    )


def _asof(spark, folder, direction, **options):
    left, seen = asof_sides(spark, folder)
    joined = asof.join_asof(
        left, seen, [asof.Role("station", "leg_time")], "station", "obs_time", {"value": "obs_value"},
        matched_time="obs_time", direction=direction, **options,
    )
    return joined.select(
        "event_id",
        "station",
        F.date_format("leg_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("leg_time"),
        F.date_format("obs_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("obs_time"),
        "obs_value",
    )


@query
def asof_weather(spark, folder):
    return _asof(spark, folder, "backward")


@query
def asof_weather_within_day(spark, folder):
    return _asof(spark, folder, "backward", tolerance_seconds=86_400)


@query
def nearest_observation(spark, folder):
    return _asof(spark, folder, "nearest")


@query
def asof_two_roles(spark, folder):
    """Both roles of a leg in one join: the buyer itself and the next user number."""
    left, seen = asof_sides(spark, folder)
    left = left.withColumn("other_station", F.col("station") + 1)
    roles = [asof.Role("station", "leg_time", "origin_"), asof.Role("other_station", "leg_time", "dest_")]
    joined = asof.join_asof(left, seen, roles, "station", "obs_time", {"value": "value"})
    return joined.select("event_id", "station", "other_station", "origin_value", "dest_value")


@query
def decode_observations(spark, folder):
    raw = observations.parse_raw_lines(raw_observation_lines(spark, folder), "line")
    decoded = observations.accepted(observations.decode_observations(raw))
    fields = {name: F.col(f"weather.{name}") for name in decode.WEATHER_FIELDS}
    for name in ("Precipitation", "Clouds"):
        fields[name] = F.array_join(fields[name], ",")
    return decoded.select(
        "event_id",
        "station",
        times.second_text("obs_time").alias("obs_time"),
        *[column.alias(_snake(name)) for name, column in fields.items()],
    )


def _snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() and i else c.lower() for i, c in enumerate(name))


@query
def observation_rejects(spark, folder):
    raw = observations.parse_raw_lines(raw_observation_lines(spark, folder), "line")
    return observations.rejected(observations.decode_observations(raw)).select("event_id", "line", "reason")


@query
def role_dim_join(spark, folder):
    """The nation table in two roles, counted per pair."""
    nation = table(spark, folder, "nation")
    view = legs(spark, folder, "origin_key", "dest_key", "arr_delay")
    view = joins.join_role(view, nation, "origin_key", "n_nationkey", {"n_name": "origin", "n_regionkey": "origin_region"})
    view = joins.join_role(view, nation, "dest_key", "n_nationkey", {"n_name": "dest", "n_regionkey": "dest_region"})
    return view.groupBy("origin", "dest", "origin_region", "dest_region").agg(
        F.count(F.lit(1)).alias("num_legs"), F.sum("arr_delay").alias("arr_delay_total")
    )


# ---------------------------------------------------------------- lookups


@query
def dest_catalog(spark, folder):
    return lookup.destinations(legs(spark, folder, "dest_city"))


@query
def dates_by_dest(spark, folder):
    result = lookup.dates_by_destination(legs(spark, folder, "dest_city", "leg_date"))
    return result.withColumn("dates", _list_text("dates"))


@query
def dates_by_dest_bitmaps(spark, folder):
    """Dates per destination from stored bitmaps of a month each, merged."""
    path = scratch_path(spark, "day-bitmaps")
    view = legs(spark, folder, "dest_city", "leg_date").withColumn("month", F.trunc("leg_date", "month"))
    files.replace_parts(bitmaps.day_bitmaps(view, ["dest_city", "month"], "leg_date"), "month", path)
    result = bitmaps.day_lists(files.read_parts(spark, path), ["dest_city"])
    return result.withColumn("dates", _list_text("dates"))


@query
def legs_by_dest_date(spark, folder):
    view = legs(spark, folder, "dest_city", "leg_date", "leg_id", "dep_hhmm", "arr_hhmm")
    paged = lookup.legs_by_destination_date(view, page_size=PAGE_SIZE)
    record = "concat(r.leg_id, ':', r.departure_minute, ':', r.arrival_minute)"
    return paged.withColumn("legs", F.expr(f"array_join(transform(legs, r -> {record}), ',')"))


@query
def legs_of_one_day(spark, folder):
    view = legs(spark, folder, "dest_city", "leg_date", "leg_id", "dep_hhmm", "arr_hhmm")
    found = lookup.legs_of(view, ONE_DEST, ONE_DAY)
    return found.select("leg_id", times.minutes_of_day("dep_hhmm").alias("departure_minute"))


# ---------------------------------------------------------------- streams


def _finish(stream_query) -> None:
    stream_query.awaitTermination()
    if stream_query.exception():
        raise stream_query.exception()


# Streams read their files in several micro-batches.
STREAM_FILES, FILES_PER_BATCH = 8, 2


def _event_stream(spark, folder):
    """The events as a stream of files, each with rows from the whole span of time, and a lateness that suits it."""
    events = table(spark, folder, "events")
    path = scratch_path(spark, "event-files")
    events.repartition(STREAM_FILES, F.xxhash64("event_id")).write.parquet(path)
    return sinks.file_stream(spark, path, events.schema, files_per_batch=FILES_PER_BATCH), rolling.whole_span(events, "ts")


@query
def replay_envelopes(spark, folder):
    counts = envelopes.slot_counts(table(spark, folder, "events"), "ts")
    return counts.select(times.second_text("window_start").alias("window_start"), "num_records")


@query
def stream_flatten(spark, folder):
    """Events published as envelope lines, read back as a stream of rows."""
    events = table(spark, folder, "events")
    lines, out = scratch_path(spark, "envelopes"), scratch_path(spark, "flattened")
    envelopes.publish(events, "ts", lines, files=STREAM_FILES)
    stream = spark.readStream.option("maxFilesPerTrigger", FILES_PER_BATCH).text(lines)
    rows = envelopes.read_envelopes(stream, events.schema)
    _finish(sinks.append_parquet(rows, out, scratch_path(spark, "flattened-state")))
    flat = spark.read.schema(events.schema).parquet(out)
    return flat.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def stream_rolling(spark, folder):
    """Counts and sums per event type over 15 minutes, 1 hour, 1 day, and hours sliding by 15 minutes.

    One stream keeps the 15-minute windows; the wider ones are rolled up from what it wrote.
    """
    stream, lateness = _event_stream(spark, folder)
    stream = rolling.event_time(stream, "ts", lateness)
    metrics = {"num_events": F.count(F.lit(1)), "total": F.sum(F.col("value").cast("decimal(18,2)"))}
    narrow = rolling.windowed_metrics(stream, "ts", ["event_type"], metrics, rolling.WIDTHS[0])
    out = scratch_path(spark, "rolling")
    _finish(sinks.per_batch_folders(narrow, out, scratch_path(spark, "rolling-state")))
    fine = sinks.latest_state(spark.read.parquet(out), ["event_type", "window_start"])
    parts = {rolling.WIDTHS[0]: fine}
    for width, slide in (*[(wide, None) for wide in rolling.WIDTHS[1:]], ("1 hour", rolling.WIDTHS[0])):
        name = f"{width} / {slide}" if slide else width
        parts[name] = rolling.roll_up(fine, ["event_type"], list(metrics), width, slide)
    return shaping.tagged_union(parts, "width").select(
        "event_type",
        "width",
        times.second_text("window_start").alias("window_start"),
        "num_events",
        F.col("total").cast("double").alias("total"),
    )


@query
def stream_distinct(spark, folder):
    """Event types per hour and user, each reported once, with the state bounded by a watermark."""
    stream, lateness = _event_stream(spark, folder)
    hourly = rolling.event_time(stream.withColumn("ts", F.date_trunc("hour", "ts")), "ts", lateness)
    keys = ["user_id", "event_type", "ts"]
    out = scratch_path(spark, "distinct")
    rows = rolling.without_duplicates(hourly.select(*keys), keys)
    _finish(sinks.append_parquet(rows, out, scratch_path(spark, "distinct-state")))
    return spark.read.parquet(out).select("user_id", "event_type", times.second_text("ts").alias("hour"))


@query
def stream_enrich(spark, folder):
    """A stream of legs with the latest observation of the last week attached."""
    stream, _ = _event_stream(spark, folder)
    arriving = stream.filter("event_type = 'purchase'").select(
        "event_id", F.col("user_id").alias("station"), F.col("ts").alias("leg_time")
    )
    _, seen = asof_sides(spark, folder)
    out = scratch_path(spark, "enriched")
    _finish(
        enrichment.enrich_stream(
            arriving, seen, [asof.Role("station", "leg_time")], "station", "obs_time", {"value": "obs_value"},
            out, scratch_path(spark, "enriched-state"), MAX_AGE_SECONDS,
        )
    )
    return spark.read.parquet(out).select("event_id", "station", "obs_value")


LIVE_LATENESS = "2 days"


@query
def stream_live_enrich(spark, folder):
    """Legs and observations as two streams; observations of a day come a batch after its legs at each week's end.

    Legs are given out once the watermark of both streams has passed them, two days behind the slower one.
    """
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    sides = {"purchase": (scratch_path(spark, "live-legs"), 1), "view": (scratch_path(spark, "live-observations"), 0)}
    for kind, (path, lag) in sides.items():
        week = F.least(F.floor((F.dayofmonth("ts") - lag) / 8), F.lit(3))
        for number in range(4):
            part = events.filter((F.col("event_type") == kind) & (week == number))
            part.repartition(FILES_PER_BATCH, "event_id").write.mode("append").parquet(path)
    legs_in, seen_in = (sinks.file_stream(spark, path, events.schema, files_per_batch=FILES_PER_BATCH) for path, _ in sides.values())
    joined = live.join_live(
        legs_in.select("event_id", F.col("user_id").alias("station"), F.col("ts").alias("leg_time")),
        seen_in.select(F.col("user_id").alias("station"), F.col("ts").alias("obs_time"), "value"),
        "station", "leg_time", "obs_time", {"value": "obs_value"}, LIVE_LATENESS, MAX_AGE_SECONDS, "obs_time",
    )
    out = scratch_path(spark, "live")
    _finish(live.start(joined, out, scratch_path(spark, "live-state")))
    given = spark.read.schema(joined.schema).parquet(out)
    return given.select("event_id", "station", F.date_format("obs_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("obs_time"), "obs_value")


LATE_EVERY = 50


def _weekly_stream(events, path):
    """Events in four weekly parts, and after them every fiftieth of all weeks."""
    week, delayed = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3)), F.col("event_id") % LATE_EVERY == 0
    for part in [*[events.filter((week == number) & ~delayed) for number in range(4)], events.filter(delayed)]:
        part.repartition(FILES_PER_BATCH, "event_id").write.mode("append").parquet(path)
    return sinks.file_stream(events.sparkSession, path, events.schema, files_per_batch=FILES_PER_BATCH)


@query
def stream_late_kept(spark, folder):
    """The same stream with its late rows kept: the closed windows, what came too late, and both merged."""
    events = table(spark, folder, "events")
    out, closed = scratch_path(spark, "split"), scratch_path(spark, "windows")
    width, metrics = rolling.WIDTHS[0], {"num_events": F.count(F.lit(1))}
    stream = _weekly_stream(events, scratch_path(spark, "late-files"))
    _finish(late.split_late(stream, "ts", width, 86_400, out, scratch_path(spark, "split-state")))
    parts = {name: rolling.windowed_metrics(late.read_part(spark, out, name, events.schema), "ts", ["event_type"], metrics, width).drop("window_end") for name in ("on_time", "late")}
    late.store_windows(parts["on_time"], closed)
    late.merge_late(spark, closed, parts["late"], ["event_type"], list(metrics))
    found = shaping.tagged_union({"late": parts["late"], "merged": late.windows(spark, closed)}, "part")
    return found.select("part", "event_type", times.second_text("window_start").alias("window_start"), "num_events")


@query
def stream_late_rows(spark, folder):
    """Counts per event type and 15 minutes with a day's lateness: four weeks in order, then what came too late.

    Every fiftieth event arrives after all others. Those whose window was closed by then are left out.
    """
    events = table(spark, folder, "events")
    path, out = scratch_path(spark, "late-files"), scratch_path(spark, "late")
    stream = _weekly_stream(events, path)
    counts = rolling.windowed_metrics(
        rolling.event_time(stream, "ts", "1 day"), "ts", ["event_type"], {"num_events": F.count(F.lit(1))}, rolling.WIDTHS[0]
    )
    _finish(sinks.per_batch_folders(counts, out, scratch_path(spark, "late-state")))
    state = sinks.latest_state(spark.read.parquet(out), ["event_type", "window_start"])
    return state.select("event_type", times.second_text("window_start").alias("window_start"), "num_events")


@query
def stream_mean_scores(spark, folder):
    """Mean predicted probability of delay per station and day, on a stream of scored rows."""
    stream, lateness = _event_stream(spark, folder)
    minute = (F.hour("ts") * 60 + F.minute("ts")).alias("dep_minute_of_day")
    scored = _rule(stream.select(F.col("user_id").alias("station"), "ts", minute))
    means = rolling.windowed_metrics(
        rolling.event_time(scored, "ts", lateness), "ts", ["station"],
        {"num_legs": F.count(F.lit(1)), "total": F.sum(F.col("delay_probability").cast("decimal(18,3)"))}, rolling.WIDTHS[2],
    )
    out = scratch_path(spark, "mean-scores")
    _finish(sinks.per_batch_folders(means, out, scratch_path(spark, "mean-scores-state")))
    state = sinks.latest_state(spark.read.parquet(out), ["station", "window_start"])
    return state.select(
        "station",
        times.day_text("window_start").alias("day"),
        "num_legs",
        F.round(F.col("total").cast("double") / F.col("num_legs"), 6).alias("mean_probability"),
    )


# ---------------------------------------------------------------- small building blocks


@query
def shaped_legs(spark, folder):
    """Names mended, a struct spread out, an absent column added, SQL functions and text times."""
    register_sql_functions(spark)
    raw = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").alias("line "),
        F.struct(F.col("l_tax").alias("Tax"), F.col("l_discount").alias("Discount")).alias("rates"),
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(" 0"), F.col("l_suppkey") % 10, F.lit(":52")).alias("at"),
        F.expr("CAST(l_partkey % 24 * 100 + l_suppkey % 60 AS INT)").alias("hhmm"),
        F.when(F.col("l_linenumber") == 1, F.array()).otherwise(F.array("l_returnflag", "l_linestatus")).alias("flags"),
    )
    named = shaping.rename_present(shaping.strip_header_spaces(raw), {"line": "leg_line", "absent": "nothing"})
    spread = shaping.prefix_struct(shaping.add_missing(named, ["bonus", "hhmm"], 7.0), "rates", "Leg")
    return spread.select(
        "l_orderkey",
        "leg_line",
        "LegTax",
        "LegDiscount",
        F.col("bonus").cast("double").alias("bonus"),
        times.second_text(times.parse_text_timestamp("at")).alias("at"),
        F.expr("hhmm_minutes(hhmm)").alias("minutes"),
        F.expr("list_label(flags)").alias("flags"),
        F.expr("weekend_flag(to_date(at))").alias("weekend"),
    )


@query
def stored_splits(spark, folder):
    """The split as a stored tag: labelled legs per split and label, read back from its folders."""
    path = scratch_path(spark, "splits")
    view = legs(spark, folder, KEY, "dep_del15").select(KEY, F.col("dep_del15").cast("int").alias("label"))
    model.write_splits(features.labelled(view), KEY, path)
    return spark.read.parquet(path).groupBy("split", "label").agg(F.count(F.lit(1)).alias("rows"))


@query
def archived_raw(spark, folder):
    """Raw lines appended under two load dates, counted per date."""
    path = scratch_path(spark, "raw-archive")
    lines = raw_observation_lines(spark, folder)
    for day, part in (("2024-02-01", lines.filter("event_id % 2 = 0")), ("2024-02-02", lines.filter("event_id % 2 = 1"))):
        observations.archive_raw(part, path, day)
    archive = spark.read.parquet(path)
    return archive.groupBy(times.day_text("load_date").alias("load_day")).agg(
        F.count(F.lit(1)).alias("lines"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")
    )


def rows_before_earlier(placed, run_rows=1_000_000):
    """Of rows with ``ts``, ``file`` and ``place`` (from 0 within the file), how many come right after a later ``ts``.

    Rows are compared inside runs of ``run_rows`` places, and the last row of each run with the first one of the next.
    """
    runs = placed.withColumn("run", F.floor(F.col("place") / run_rows))
    previous = F.lag("ts").over(Window.partitionBy("file", "run").orderBy("place"))
    per_run = runs.withColumn("wrong", (F.col("ts") < previous).cast("int")).groupBy("file", "run").agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("wrong"), F.lit(0)).alias("wrong"),
        F.min_by("ts", "place").alias("first"),
        F.max_by("ts", "place").alias("last"),
    )
    last = F.lag("last").over(Window.partitionBy("file").orderBy("run"))
    at_border = F.coalesce((F.col("first") < last).cast("int"), F.lit(0))
    return per_run.withColumn("wrong", F.col("wrong") + at_border).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("wrong"), F.lit(0)).alias("wrong")
    )


@query
def time_sorted_rows(spark, folder):
    """Rows written in time order, then, per file, how many rows stand before an earlier one."""
    path = scratch_path(spark, "time-sorted")
    files.write_sorted_by_time(table(spark, folder, "events"), path, "ts")
    placed = files.read_parquet(spark, path, ["ts"]).select(
        "ts", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")
    )
    return rows_before_earlier(placed)


@query
def filled_from_file(spark, folder):
    """Medians stored as a small file, read back, and put in for missing numbers: the sums that result."""
    path = scratch_path(spark, "fills")
    columns = ["origin_wind_speed", "origin_visibility", "dest_wind_speed"]
    view = legs(spark, folder, *columns).select(*[F.col(name).cast("double").alias(name) for name in columns])
    medians = profile.column_medians(view, columns).collect()
    files.write_fill_values(spark, {row["column"]: row["median"] for row in medians}, path)
    filled = shaping.fill_nulls(view, files.read_fill_values(spark, path, columns))
    return filled.agg(*[F.sum(name).alias(name) for name in columns])


@query
def scan_slice(spark, folder):
    """The first thousand rows of two columns: how many there are, and which columns were read."""
    part = files.peek(files.read_parquet(spark, f"{folder}/events.parquet"), ["event_id", "ts"], 1000)
    return part.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(",".join(part.columns)))


@query
def complete_leg_counts(spark, folder):
    """Legs without any missing model input, per carrier."""
    whole = features.complete_rows(legs(spark, folder, *SPEC.inputs), SPEC)
    return whole.groupBy("carrier").agg(F.count(F.lit(1)).alias("num_legs"))


@query
def hash_sample(spark, folder):
    """A tenth of the legs by a hash of their key, the same in any run."""
    view = legs(spark, folder, KEY, "arr_delay")
    return view.filter(model.split_column(KEY, 10, seed=7) == "train").select(KEY, "arr_delay")


@query
def scaled_numbers(spark, folder):
    """Two measures, standardised as a pipeline stage does it."""
    view = legs(spark, folder, KEY, "dep_delay", "elapsed")
    scaled = model.standardised(view, ["dep_delay", "elapsed"])
    return scaled.select(KEY, *[F.round(name, 6).alias(name) for name in ("dep_delay", "elapsed")])


# ---------------------------------------------------------------- features and models

SPEC = features.STAND_IN
KEY = "leg_id"


@query
def feature_table(spark, folder):
    view, numbers = (legs(spark, folder, *columns) for columns in (SPEC.inputs, SPEC.number_inputs))
    training = model.split_column(KEY) == "train"
    return features.with_missing_filled(view, SPEC, numbers, training).withColumn("leg_day", times.day_text("leg_day"))


FLAG_WORDS = {"origin_precipitation": ["PROMO", "LARGE"], "dest_precipitation": ["PROMO", "ECONOMY"]}


@query
def word_flag_features(spark, folder):
    view = legs(spark, folder, KEY, *FLAG_WORDS)
    flagged = features.with_word_flags(view, FLAG_WORDS)
    return flagged.drop(*FLAG_WORDS)


SLOTS = 64


@query
def hashed_features(spark, folder):
    """Categories and list words of every leg as a sparse vector of fixed width, read back as ``slot:count``."""
    raw = features.raw_features(legs(spark, folder, *SPEC.inputs), SPEC)
    coded = model.slot_encoder(SLOTS).transform(features.hashed_slots(raw, SPEC, SLOTS))
    cells = F.transform(vector_to_array("hashed"), lambda n, at: F.when(n > 0, F.concat_ws(":", at, n.cast("int"))))
    return coded.select(KEY, F.array_join(cells, ",").alias("slots"))


@query
def split_sample(spark, folder):
    tagged = model.tag_split(legs(spark, folder, KEY), KEY)
    return tagged.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def _rule_scored(spark, folder):
    """All labelled legs, called late from noon on."""
    view = legs(spark, folder, "carrier", "leg_date", "dep_hhmm", "dep_del15").select(
        "carrier",
        F.col("leg_date").alias("leg_day"),
        times.hhmm_hour("dep_hhmm").alias("dep_hour"),
        F.col("dep_del15").cast("int").alias("label"),
    )
    return model.rule_scores(features.labelled(view), F.col("dep_hour") >= 12)


@query
def rule_metrics(spark, folder):
    return model.metrics_table(_rule_scored(spark, folder))


@query
def rule_confusion(spark, folder):
    return model.confusion(_rule_scored(spark, folder))


@query
def rule_segment_error(spark, folder):
    return model.error_by_segment(_rule_scored(spark, folder), "carrier", "dep_hour")


@query
def rule_performance_over_time(spark, folder):
    return model.performance_over_time(_rule_scored(spark, folder)).withColumn("week", times.second_text("week"))


@query
def rule_rolling_ranges(spark, folder):
    """Metrics of every range of six months that starts in any month with data or up to five months before."""
    return model.metrics_by_range(_rule_scored(spark, folder), months=6)


def _rule(df):
    """Late from noon on, more probably so the later."""
    ruled = model.rule_scores(df, F.col("dep_minute_of_day") >= 720)
    return ruled.withColumn("delay_probability", F.round(F.col("dep_minute_of_day") / 1440, 3))


def _rule_features(spark, folder):
    view = legs(spark, folder, KEY, "origin_city", "dest_city", "leg_date", "dep_hhmm", "dep_del15")
    return view.select(
        KEY,
        "origin_city",
        "dest_city",
        F.col("leg_date").alias("leg_day"),
        times.minutes_of_day("dep_hhmm").alias("dep_minute_of_day"),
        F.col("dep_del15").cast("int").alias("label"),
    )


@query
def rule_curve_metrics(spark, folder):
    return model.curve_table(_rule(features.labelled(_rule_features(spark, folder)))).select(
        F.round("roc_auc", 9).alias("roc_auc"), F.round("pr_auc", 9).alias("pr_auc")
    )


@query
def rule_score_date(spark, folder):
    return model.score_date(None, _rule_features(spark, folder), ONE_DAY, ["origin_city", "dest_city", KEY], _rule)


LOOKUP_BUCKETS = 8


@query
def bucketed_score_ids(spark, folder):
    """The same scores from a stored table in buckets of the id, and those of the greatest id looked up alone."""
    path = scratch_path(spark, "legs-by-id")
    name = f"legs_by_id_{path.rsplit('-', 1)[-1]}"
    view = legs(spark, folder, KEY, "leg_date").filter(F.col("leg_date") == F.lit(ONE_DAY).cast("date"))
    by_key = files.write_for_lookup(_rule_features(spark, folder), name, path, KEY, LOOKUP_BUCKETS)
    greatest = view.agg(F.max(KEY)).first()[0]
    one = model.score_ids(None, lookup.by_id(by_key, greatest, KEY), view, KEY, _rule)
    parts = {"all": model.score_ids(None, by_key, view, KEY, _rule), "greatest": one}
    return shaping.tagged_union(parts, "asked")


@query
def rule_score_ids(spark, folder):
    """Scores for the legs of one order date, asked for by id."""
    ids = legs(spark, folder, KEY, "leg_date").filter(F.col("leg_date") == F.lit(ONE_DAY).cast("date"))
    return model.score_ids(None, _rule_features(spark, folder), ids, KEY, _rule)


@query
def rule_permutation_importance(spark, folder):
    """Accuracy of the noon rule with one column permuted; it looks at the minute alone."""
    view = _rule_features(spark, folder).drop("leg_day")
    return evaluation.permutation_importance(view, KEY, ["dep_minute_of_day", "origin_city", "dest_city"], _rule, seed=7)


@query
def rule_segments(spark, folder):
    """Error of the noon rule over all combinations of carrier, destination and hour with thirty legs or more."""
    view = legs(spark, folder, "carrier", "dest_city", "dep_hhmm", "dep_del15").select(
        "carrier", "dest_city", times.hhmm_hour("dep_hhmm").cast("int").alias("dep_hour"), F.col("dep_del15").cast("int").alias("label")
    )
    scored = model.rule_scores(features.labelled(view), F.col("dep_hour") >= 12)
    found = evaluation.segments(scored, ["carrier", "dest_city", "dep_hour"], min_rows=30)
    return found.withColumns({name: F.round(name, 9) for name in ("error_rate", "lift")})


@query
def rule_typed_rows(spark, folder):
    """Legs typed as text, scored by the noon rule: the path of a single typed row, over a whole table."""
    typed = {
        "CRSDepTimestamp": "concat(date_format(l_shipdate, 'yyyy-MM-dd'), ' ', lpad(CAST(l_partkey % 25 AS STRING), 2, '0'), ':', lpad(CAST(l_suppkey % 60 AS STRING), 2, '0'))",
        "FlightDate": "date_format(l_shipdate, 'yyyy-MM-dd')",
        "OriginPrecipitation": "CASE l_linenumber % 3 WHEN 0 THEN '[]' WHEN 1 THEN 'rain' END",
        "Marketing_Airline_Network": "l_returnflag",
        "Operating_Airline": "l_linestatus",
        "CRSArrTime": "CAST(l_partkey % 24 * 100 + l_suppkey % 60 AS INT)",
    }
    spec = dataclasses.replace(features.PUBLISHED, passed_on=("leg_id",))
    source = table(spark, folder, "lineitem")
    rows = source.select(
        LEG_COLUMNS["leg_id"][1]().alias("leg_id"),
        *[(F.expr(typed[field.name]) if field.name in typed else F.lit(None)).cast(field.dataType).alias(field.name) for field in schemas.SCORING_ROW],
    )
    fills = {name: 0.0 for name in spec.number_columns}
    scored = model.score_typed_rows(None, rows, spec, fills, _rule)
    return scored.select("leg_id", "prediction", "delay_probability", F.col("Marketing_Airline_Network").alias("network"))


@query
def stable_ids(spark, folder):
    """Ids from the content of a row, the same in any engine."""
    view = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return lookup.with_digest_id(view, view.columns, "leg_digest").select("l_orderkey", "l_linenumber", "leg_digest")


@query
def class_weights(spark, folder):
    labels = legs(spark, folder, "dep_del15").select(F.col("dep_del15").cast("int").alias("label"))
    return model.class_weights(features.labelled(labels))


@query
def seeded_sample(spark, folder):
    sampled = model.seeded_sample(_from_one_origin(spark, folder, *MEASURES), 0.1)
    return sampled.select(*delays.CAUSES.values(), "dep_delay_minutes")


# By session and folder; ``clear_trained`` lets go of the models.
_TRAINED: dict[tuple, tuple] = {}


def clear_trained() -> None:
    _TRAINED.clear()


def _prepared(spark, folder):
    """Training and test features, with the fills of the training rows."""
    raw = features.labelled(features.raw_features(legs(spark, folder, *SPEC.inputs), SPEC))
    numbers = features.number_features(legs(spark, folder, *SPEC.number_inputs), SPEC)
    fills = features.fit_fills(model.train_test(numbers, KEY)[0], SPEC)
    training, test = (shaping.fill_nulls(part, fills) for part in model.train_test(raw, KEY))
    # Every stage of a fit reads its rows again: the joins and the feature build are done once. The test rows are read
    # by later queries too, after what this one stored may be gone.
    return stored(spark, training, "features"), test, fills


def _trained(spark, folder):
    """One boosted-tree model per session and folder; the model itself is small."""
    key = (spark, folder)
    if key not in _TRAINED:
        training, test, fills = _prepared(spark, folder)
        _TRAINED[key] = (model.fit(SPEC, training, model.boosted_trees()), test, fills)
    return _TRAINED[key]


def _scored(spark, folder):
    trained, test, _ = _trained(spark, folder)
    return model.score(trained, test)


def _probabilities(spark, folder):
    """Labels, predictions and probabilities of the test rows, scored once."""
    return stored(spark, _scored(spark, folder).select("label", "prediction", "delay_probability"), "probabilities")


@query
def train_score_metrics(spark, folder):
    return model.metrics_table(_scored(spark, folder))


@query
def curve_metrics(spark, folder):
    return model.all_metrics(_probabilities(spark, folder)).orderBy("metric")


@query
def score_date(spark, folder):
    trained, _, fills = _trained(spark, folder)
    view = features.build_features(legs(spark, folder, *SPEC.inputs), SPEC, fills)
    return model.score_date(trained, view, ONE_DAY, ["origin_city", "dest_city", "leg_id"])


@query
def score_ids(spark, folder):
    """Scores for the legs of one order date, asked for by id."""
    trained, _, fills = _trained(spark, folder)
    view = features.build_features(legs(spark, folder, *SPEC.inputs), SPEC, fills)
    ids = legs(spark, folder, KEY, "leg_date").filter("leg_date = DATE'1999-03-01'")
    return model.score_ids(trained, view, ids, KEY)


@query
def confusion(spark, folder):
    return model.confusion(_scored(spark, folder))


@query
def segment_error(spark, folder):
    return model.error_by_segment(_scored(spark, folder), "carrier", "DepHour")


@query
def performance_over_time(spark, folder):
    return model.performance_over_time(_scored(spark, folder)).withColumn("week", times.second_text("week"))


@query
def feature_importance(spark, folder):
    trained, test, _ = _trained(spark, folder)
    return model.feature_importance(spark, trained, test)


@query
def weighted_metrics(spark, folder):
    training, test, _ = _prepared(spark, folder)
    weighted = model.with_class_weight(training)
    trees = model.boosted_trees(depth=5, iterations=50, weightCol="weight")
    return model.metrics_table(model.score(model.fit(SPEC, weighted, trees, scale_numbers=True), test))


@query
def forest_metrics(spark, folder):
    training, test, _ = _prepared(spark, folder)
    forest = model.fit(SPEC, training, model.packed_forest())
    return model.metrics_table(model.score(forest, test))


@query
def grid_search(spark, folder):
    training, _, _ = _prepared(spark, folder)
    found = model.grid_search(SPEC, files.keep(training), model.REDUCED_GRID, folds=2)
    training.unpersist()
    return model.grid_results(spark, found)


@query
def half_year_models(spark, folder):
    view = features.labelled(features.raw_features(legs(spark, folder, *SPEC.inputs), SPEC))
    forest = model.random_forest(trees=100, depth=10, seed=42)
    return model.compare_ranges(view, SPEC, KEY, forest, scratch_path(spark, "half-years"))


@query
def stream_score(spark, folder):
    """The saved model on a stream of features, read back and counted per label and prediction."""
    trained, test, _ = _trained(spark, folder)
    rows, saved, out = (scratch_path(spark, name) for name in ("features", "model", "scored"))
    test.write.parquet(rows)
    model.save(trained, saved)
    stream = sinks.file_stream(spark, rows, test.schema, files_per_batch=64)
    _finish(scoring.score_to_parquet(model.load(saved), stream, out, scratch_path(spark, "scored-state")))
    return model.confusion(spark.read.parquet(out))
