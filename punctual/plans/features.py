"""The model's feature table. Training, batch scoring and stream scoring share this one transform."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, times
from ..operators import profile, shaping


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns of a leg table feed the model.

    Only columns known before departure are named, so nothing about the outcome can slip in: columns
    are picked, not dropped.
    """

    date: str
    dep_hhmm: str
    arr_hhmm: str
    label: str
    categories: tuple[str, ...]
    lists: tuple[str, ...]
    numbers: tuple[str, ...]
    passed_on: tuple[str, ...] = ()

    @property
    def category_columns(self) -> list[str]:
        return [*self.categories, *self.lists]

    @property
    def number_columns(self) -> list[str]:
        return [*self.numbers, *TIME_FEATURES]

    @property
    def inputs(self) -> list[str]:
        """Columns to read from the leg table."""
        plain = [self.date, self.dep_hhmm, self.arr_hhmm, self.label]
        return list(dict.fromkeys([*plain, *self.category_columns, *self.numbers, *self.passed_on]))


    @property
    def number_inputs(self) -> list[str]:
        """Columns that the number features alone need."""
        plain = [self.date, self.dep_hhmm, self.arr_hhmm, self.label]
        return list(dict.fromkeys([*plain, *self.numbers, *self.passed_on]))


TIME_FEATURES = ("DepHour", "ArrHour", "DepMinute", "ArrMinute", "is_weekend")

# The published data set's column names.
PUBLISHED = FeatureSpec(
    date="FlightDate",
    dep_hhmm="CRSDepTime",
    arr_hhmm="CRSArrTime",
    label="DepDel15",
    categories=("Marketing_Airline_Network", "Operating_Airline", "Origin", "Dest"),
    lists=("OriginPrecipitation", "OriginClouds", "DestPrecipitation", "DestClouds"),
    numbers=(
        "Year",
        "Month",
        "DayofMonth",
        "DayOfWeek",
        "OriginWindDirection",
        "OriginWindSpeed",
        "OriginVisibility",
        "DestWindDirection",
        "DestWindSpeed",
        "DestVisibility",
    ),
)

STAND_IN = FeatureSpec(
    date="leg_date",
    dep_hhmm="dep_hhmm",
    arr_hhmm="arr_hhmm",
    label="dep_del15",
    categories=("carrier", "operator", "origin_city", "dest_city"),
    lists=("origin_precipitation", "origin_clouds", "dest_precipitation", "dest_clouds"),
    numbers=(
        "year",
        "month",
        "day_of_month",
        "day_of_week",
        "origin_wind_direction",
        "origin_wind_speed",
        "origin_visibility",
        "dest_wind_direction",
        "dest_wind_speed",
        "dest_visibility",
    ),
    passed_on=("leg_id",),
)


def number_features(legs: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The number features before filling, with the label (NULL where unknown or where the table has none)."""
    legs = shaping.add_missing(shaping.strip_header_spaces(legs), spec.numbers)
    return legs.select(*spec.passed_on, *_numbers(spec), _label(legs, spec))


def _numbers(spec: FeatureSpec) -> list[Column]:
    derived = {
        "DepHour": times.hhmm_hour(spec.dep_hhmm),
        "ArrHour": times.hhmm_hour(spec.arr_hhmm),
        "DepMinute": times.hhmm_minute(spec.dep_hhmm),
        "ArrMinute": times.hhmm_minute(spec.arr_hhmm),
        "is_weekend": times.weekend_flag(F.to_date(spec.date)),
    }
    plain = {name: F.col(name) for name in spec.numbers}
    return [column.cast("double").alias(name) for name, column in {**plain, **derived}.items()]


def _label(legs: DataFrame, spec: FeatureSpec) -> Column:
    label = F.col(spec.label) if spec.label in legs.columns else F.lit(None)
    return label.cast("int").alias("label")


def raw_features(legs: DataFrame, spec: FeatureSpec) -> DataFrame:
    """All features before filling; lists and missing categories as text."""
    legs = shaping.add_missing(shaping.strip_header_spaces(legs), spec.numbers)
    types = dict(legs.dtypes)
    as_text = [
        (text.list_label(c) if types[c].startswith("array") else F.coalesce(F.col(c), F.lit("None"))).alias(c)
        for c in spec.category_columns
    ]
    return legs.select(
        *spec.passed_on,
        F.to_date(spec.date).alias("leg_day"),
        *as_text,
        *_numbers(spec),
        times.minutes_of_day(spec.dep_hhmm).alias("dep_minute_of_day"),
        _label(legs, spec),
    )


def fit_fills(features: DataFrame, spec: FeatureSpec) -> dict[str, float]:
    """Median per number column, from labelled training rows only. One value per feature column."""
    medians = profile.column_medians(features.filter("label IS NOT NULL"), spec.number_columns)
    return {row["column"]: row["median"] for row in medians.collect()}


def build_features(legs: DataFrame, spec: FeatureSpec, fills: Mapping[str, float]) -> DataFrame:
    """Feature table with every number filled; rows keep a NULL label if they have none."""
    return shaping.fill_nulls(raw_features(legs, spec), fills)


def with_missing_filled(
    legs: DataFrame, spec: FeatureSpec, numbers: DataFrame | None = None, training: Column | None = None
) -> DataFrame:
    """Feature table filled with its own medians in one query: they enter as a scalar subquery.

    ``numbers`` may be a narrower view of the same legs (``number_inputs``) for the medians to read, when
    the other columns come from joins that the medians can do without. ``training`` picks the labelled rows that
    medians come from; without it all labelled rows are training rows.
    """
    raw = raw_features(legs, spec)
    known = number_features(legs if numbers is None else numbers, spec).filter("label IS NOT NULL")
    known = known if training is None else known.filter(training)
    medians = profile.column_medians(known, spec.number_columns)
    fills = medians.groupBy().agg(
        F.struct(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in spec.number_columns])
    )
    one_row = fills.scalar()
    return raw.withColumns({c: F.coalesce(F.col(c), one_row[c]) for c in spec.number_columns})


def with_word_flags(df: DataFrame, words: Mapping[str, Sequence[str]]) -> DataFrame:
    """One 0/1 column ``column_word`` per word of a list column.

    An index over list *texts* has a slot for every combination that occurs; this has one per word, a number that the
    word table fixes. NULL lists have no word.
    """
    flags = {
        f"{column}_{word.replace(' ', '_')}": F.coalesce(F.array_contains(column, word).cast("double"), F.lit(0.0))
        for column, listed in words.items()
        for word in listed
    }
    return df.withColumns(flags)


HASHED_WIDTH = 1024


def hashed_slots(features: DataFrame, spec: FeatureSpec, width: int = HASHED_WIDTH, name: str = "slots") -> DataFrame:
    """Add the slots (from 0, below ``width``) of a row's categories and list words, by a hash of ``column=value``.

    The width is a parameter, so no list of labels is gathered anywhere, and words that training hasn't seen have a slot
    as well. Two words may share one; a row has as many slots as it has categories and words, repeats included.
    """
    def named(column: str, words: Column) -> Column:
        return F.transform(words, lambda word: F.concat(F.lit(f"{column}="), word))

    texts = {c: F.coalesce(F.col(c), F.lit("None")) for c in spec.category_columns}
    tokens = [named(c, F.array(texts[c])) for c in spec.categories]
    tokens += [named(c, F.split(texts[c], ",")) for c in spec.lists]
    number = F.transform(
        F.concat(*tokens), lambda token: F.conv(F.substring(F.md5(F.encode(token, "UTF-8")), 1, 7), 16, 10).cast("long") % width
    )
    return features.withColumn(name, F.transform(number, lambda slot: slot.cast("string")))


def complete_rows(legs: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The stricter variant: rows with any missing input are left out instead of filled."""
    return legs.dropna(subset=[c for c in spec.inputs if c in legs.columns])


def labelled(features: DataFrame) -> DataFrame:
    return features.filter(F.col("label").isNotNull())


def scoring_row_to_leg(rows: DataFrame) -> DataFrame:
    """Hand-typed legs (text timestamp and lists as text) -> the published column names."""
    departure = times.parse_text_timestamp("CRSDepTimestamp")
    return rows.withColumns(
        {
            "Year": F.year(departure),
            "Month": F.month(departure),
            "DayofMonth": F.dayofmonth(departure),
            "DayOfWeek": times.iso_weekday(departure.cast("date")),
            "CRSDepTime": F.concat(
                F.lpad(F.hour(departure).cast("string"), 2, "0"), F.lpad(F.minute(departure).cast("string"), 2, "0")
            ).try_cast("int"),
            **{
                c: F.when(F.trim(c).isin("[]", ""), F.lit(None).cast("string")).otherwise(F.col(c))
                for c in ("OriginPrecipitation", "DestPrecipitation")
            },
        }
    )
