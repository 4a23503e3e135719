"""The batch job end to end on hand-made files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from punctual.plans import enrich, features, lookup, model
from punctual.sources import files, observations, schemas


def leg(**changes):
    base = {
        "OriginAirportID": 11057, "DestAirportID": 10397, "Year": 2024, "Month": 1, "DayofMonth": 6, "DayOfWeek": 6,
        "FlightDate": "2024-01-06", "Marketing_Airline_Network": "AA", "Operating_Airline": "OH", "Origin": "CLT",
        "OriginCityName": "Charlotte, NC", "Dest": "ATL", "DestCityName": "Atlanta, GA", "CRSDepTime": 930,
        "CRSArrTime": 1045, "DepDel15": 0.0, "ArrDelay": -3.0, "Cancelled": 0.0, "Diverted": 0.0,
    }
    return {**base, **changes}


LEGS = [
    leg(),
    leg(CRSDepTime=5, DestAirportID=11298, Dest="DFW", DepDel15=1.0),
    leg(CRSDepTime=2400),
    leg(OriginAirportID=1),
    leg(FlightDate="2024-02-01", Month=2, CRSDepTime=1200, DepDel15=None, Cancelled=1.0),
]
LINES = [
    # 09:30 in Charlotte is 14:30 UTC.
    "KCLT\t2024-01-06 13:52\tKCLT 061352Z 24015G25KT 10SM -RA FEW045 18/07 A3001",
    "KCLT\t2024-01-06 14:52\tKCLT 061452Z 10001KT 1SM FG OVC001 01/00 A3001",
    "KCLT\t2024-01-06 04:52\tKCLT 060452Z 00000KT 5SM CLR 00/M01 A3001",
    "KATL\t2024-01-06 14:30\tKATL 061430Z 09009KT 3SM BR BKN010 05/05 A3001",
    "KCLT\tbroken line",
]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("enrich")
    names = [*schemas.LEG.fieldNames()]
    header = [f"{n} " if n == "Operating_Airline" else n for n in names]
    lines = [",".join(header)]
    for row in LEGS:
        cells = [row.get(n) for n in names]
        lines.append(",".join("" if c is None else f'"{c}"' if "," in str(c) else str(c) for c in cells))
    (folder / "legs.csv").write_text("\n".join(lines) + "\n")
    (folder / "raw.txt").write_text("\n".join(["station\tvalid\tmetar", *LINES]) + "\n")
    out = str(folder / "out")
    seen = str(folder / "observations")
    return enrich.run(spark, str(folder / "legs.csv"), str(folder / "raw.txt"), seen, out), folder


def test_shape(written):
    table, folder = written
    assert set(table.columns) == set(schemas.ENRICHED_LEG.fieldNames())
    assert len(table.columns) == 68
    assert table.count() == 4
    kinds = {field.name: field.dataType for field in schemas.ENRICHED_LEG}
    assert all(kinds[field.name] == field.dataType for field in table.schema if field.name not in ("Year", "Month"))
    assert (folder / "out" / "Year=2024" / "Month=2").is_dir()


def test_rejects_are_stored_beside_the_usable_lines(spark, written):
    _, folder = written
    stored = spark.read.parquet(str(folder / "observations"))
    assert {r["status"]: r["count"] for r in stored.groupBy("status").count().collect()} == {"accepted": 4, "no time": 1}


def test_weather_is_the_latest_before_departure_in_utc(written):
    table, _ = written
    row = table.filter("CRSDepTime = 930").first()
    assert row["CRSDepTimestamp"] == dt.datetime(2024, 1, 6, 9, 30)
    assert (row["OriginWindSpeed"], row["OriginWindGusts"], row["OriginPrecipitation"]) == (15, 25, ["rain"])
    assert (row["DestVisibility"], row["DestPrecipitation"], row["DestClouds"]) == (3.0, ["mist"], ["broken"])
    early = table.filter("CRSDepTime = 5").first()
    assert (early["OriginTemperature"], early["OriginClouds"]) == (0.0, ["clear"])
    assert early["DestICAO"] == "KDFW" and early["DestWindSpeed"] is None


def test_no_time_or_old_observation_gives_no_weather(written):
    table, _ = written
    assert table.filter("CRSDepTime = 2400").first()["OriginWindSpeed"] is None
    assert table.filter("Month = 2").first()["OriginWindSpeed"] is None


def test_partition_filter_reaches_the_scan(written):
    table, _ = written
    plan = table.filter("Month = 1").select("Dest")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(Month" in plan


def test_weather_at_arrival_is_an_option(spark, written):
    _, folder = written
    legs = files.read_legs_csv(spark, str(folder / "legs.csv")).filter("CRSDepTime = 930")
    raw = observations.read_raw_observations(spark, str(folder / "raw.txt"))
    from punctual.sources.dimensions import airports

    joined = enrich.enrich(legs, airports(spark), observations.decode_observations(raw), dest_at_arrival=True)
    assert joined.filter("DestAirportID = 10397").first()["DestVisibility"] == 3.0


def csv_of(folder, names, rows):
    path = folder / "in.csv"
    path.write_text("\n".join([",".join(names), *[",".join("" if r.get(n.strip()) is None else f'"{r[n.strip()]}"' for n in names) for r in rows]]) + "\n")
    return str(path)


def test_csv_is_read_by_header_names(spark, tmp_path):
    names = [*reversed(schemas.LEG.fieldNames()), "Extra"]
    names[3] = f" {names[3]} "
    legs = files.read_legs_csv(spark, csv_of(tmp_path, names, [leg(Extra="x")]))
    row = legs.first()
    assert legs.columns == [*schemas.LEG.fieldNames(), "malformed"]
    assert (row["Year"], row["Month"], row["Dest"], row["malformed"]) == (2024, 1, "ATL", None)


def test_csv_without_a_column_is_an_error(spark, tmp_path):
    names = [name for name in schemas.LEG.fieldNames() if name != "Dest"]
    with pytest.raises(ValueError, match="no column Dest"):
        files.read_legs_csv(spark, csv_of(tmp_path, names, [leg()]))


def test_malformed_lines_are_counted(spark, tmp_path):
    legs = files.read_legs_csv(spark, csv_of(tmp_path, schemas.LEG.fieldNames(), [leg(), leg(Year="many"), leg()]))
    assert {r["is_malformed"]: r["lines"] for r in files.count_malformed(legs).collect()} == {False: 2, True: 1}


def test_overnight_arrival_is_on_the_next_day(spark):
    legs = spark.createDataFrame(
        [(11057, 10397, "2024-01-06", 2300, 130), (12892, 10397, "2024-01-06", 2300, 630), (10397, 12892, "2024-01-06", 900, 1030)],
        "OriginAirportID INT, DestAirportID INT, FlightDate STRING, CRSDepTime INT, CRSArrTime INT",
    ).withColumn("FlightDate", F.to_date("FlightDate"))
    from punctual.sources.dimensions import airports

    timed = enrich.with_schedule_times(enrich.with_airports(legs, airports(spark)))
    assert sorted(row["CRSArrTimestamp"].isoformat() for row in timed.collect()) == [
        "2024-01-06T10:30:00", "2024-01-07T01:30:00", "2024-01-07T06:30:00"
    ]


def test_unknown_airports_are_counted(spark, written):
    _, folder = written
    from punctual.sources.dimensions import airports

    legs = files.read_legs_csv(spark, str(folder / "legs.csv"))
    found = enrich.unknown_airports(legs, airports(spark)).collect()
    assert [(r["role"], r["AirportID"], r["legs"]) for r in found] == [("Origin", 1, 1)]


def test_inferred_csv_strips_header_spaces(spark, written):
    _, folder = written
    assert "Operating_Airline" in files.read_csv_inferred(spark, str(folder / "legs.csv")).columns


def test_features_of_the_published_layout(spark, written):
    table, _ = written
    spec = features.PUBLISHED
    fills = features.fit_fills(features.raw_features(table, spec), spec)
    built = features.build_features(table, spec, fills).filter("label IS NOT NULL").orderBy("DepHour")
    assert built.filter(" OR ".join(f"{c} IS NULL" for c in spec.number_columns)).count() == 0
    row = built.filter("DepHour = 9").first()
    assert (row["OriginPrecipitation"], row["OriginClouds"], row["DepMinute"], row["is_weekend"]) == ("rain", "few", 30.0, 1.0)
    assert built.filter("DepHour = 0").first()["DestClouds"] == "None"
    leaky = {"DepDelay", "ArrDelay", "ArrDel15", "Cancelled", "TaxiOut", "WeatherDelay"}
    assert not leaky & set(built.columns)


def test_one_query_fill_equals_two_step_fill(spark, written, rows):
    table, _ = written
    spec = features.PUBLISHED
    fills = features.fit_fills(features.raw_features(table, spec), spec)
    assert rows(features.build_features(table, spec, fills)) == rows(features.with_missing_filled(table, spec))


def test_complete_rows(written):
    table, _ = written
    assert features.complete_rows(table, features.PUBLISHED).count() == 1


def test_hand_typed_leg(spark):
    row = [None] * len(schemas.SCORING_ROW)
    typed = dict(zip(schemas.SCORING_ROW.fieldNames(), row))
    typed.update(FlightDate="2024-08-01", Origin="CLT", Dest="MIA", CRSDepTimestamp="2024-08-01 09:30:00",
                 OriginPrecipitation="[]", OriginClouds="FEW", CRSArrTime=1130, OriginVisibility=10.0)
    df = spark.createDataFrame([tuple(typed.values())], schemas.SCORING_ROW)
    built = features.build_features(features.scoring_row_to_leg(df), features.PUBLISHED, {"OriginWindSpeed": 5.0})
    got = built.first()
    assert (got["DepHour"], got["DepMinute"], got["ArrHour"], got["DayOfWeek"]) == (9.0, 30.0, 11.0, 4.0)
    assert (got["OriginPrecipitation"], got["OriginClouds"], got["OriginWindSpeed"]) == ("None", "FEW", 5.0)
    assert got["label"] is None
    table = spark.range(200).selectExpr(
        "'AA' AS Marketing_Airline_Network", "'OH' AS Operating_Airline", "'CLT' AS Origin", "'MIA' AS Dest",
        "CAST(id % 24 * 100 AS INT) AS CRSDepTime", "CAST(id % 24 * 100 AS INT) AS CRSArrTime",
        "DATE'2024-01-01' AS FlightDate", "CAST(id % 24 > 12 AS DOUBLE) AS DepDel15",
        *[f"array('x') AS {c}" for c in features.PUBLISHED.lists],
    )
    fitted = model.fit(
        features.PUBLISHED, features.build_features(table, features.PUBLISHED, {}), model.boosted_trees(2, 2)
    )
    scored = model.score_typed_rows(fitted, df, features.PUBLISHED, {c: 0.0 for c in features.PUBLISHED.numbers})
    assert [r["prediction"] for r in scored.collect()] == [0]


def test_fill_values_round_trip(spark, tmp_path):
    fills = {"Year": 2024.0, "OriginWindSpeed": 5.5}
    files.write_fill_values(spark, fills, str(tmp_path / "fills"))
    assert files.read_fill_values(spark, str(tmp_path / "fills"), list(fills)) == fills
    with pytest.raises(ValueError, match="Month"):
        files.read_fill_values(spark, str(tmp_path / "fills"), ["Year", "Month"])


def test_projected_scan_and_time_order(spark, written, tmp_path):
    table, folder = written
    narrow = files.read_parquet(spark, str(folder / "out"), ["Origin", "Dest"])
    assert files.peek(narrow, ["Dest"], 2).count() == 2
    files.write_sorted_by_time(table, str(tmp_path / "sorted"), "CRSDepTimestamp")
    names = sorted((tmp_path / "sorted").glob("part-*.parquet"))
    stored = [r["CRSDepTimestamp"] for name in names for r in spark.read.parquet(str(name)).collect()]
    known = [time for time in stored if time is not None]
    assert len(stored) == 4 and known == sorted(known)


def test_content_hash_ids(spark, written):
    table, _ = written
    keys = ["OriginAirportID", "DestAirportID", "CRSDepTime", "FlightDate"]
    a = lookup.with_key_hash(table, keys)
    b = lookup.with_key_hash(table.repartition(7), keys)
    assert a.select("leg_id").exceptAll(b.select("leg_id")).count() == 0
    assert lookup.by_ids(a, a.limit(1)).count() == 1
    assert lookup.legs_of(table, "Atlanta, GA", "2024-01-06", "DestCityName", "FlightDate").count() == 3


def test_roles_as_rows(written):
    table, _ = written
    assert enrich.split_roles(table).groupBy("role").agg(F.count("station").alias("n")).filter("n = 4").count() == 2
