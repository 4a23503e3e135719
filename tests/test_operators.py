import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from punctual.operators import joins, lists, profile, quantiles, ranking, rolling, shaping, timeframes
from punctual.sources import dimensions


def test_top_k_ties_and_plan(spark):
    data = [("a", f"d{i}", float(i // 2)) for i in range(8)] + [("b", "x", None), ("b", "y", 1.0)]
    df = spark.createDataFrame(data, "g STRING, name STRING, m DOUBLE")
    top = ranking.top_k_per_group(df, ["g"], "m", 3, ["name"])
    assert sorted((r["g"], r["rank"], r["name"]) for r in top.collect()) == [
        ("a", 1, "d6"), ("a", 2, "d7"), ("a", 3, "d4"), ("b", 1, "y"), ("b", 2, "x")
    ]
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()


def test_role_join_keeps_known_keys_only(spark):
    legs = spark.createDataFrame([(1, 10397, 11298), (2, 10397, 99), (3, None, 11298)], "id INT, o INT, d INT")
    dim = dimensions.airports(spark)
    for role in ("o", "d"):
        legs = joins.join_role(legs, dim, role, "AirportID", {"ICAO": f"{role}_icao"})
    assert [tuple(r) for r in legs.select("id", "o_icao", "d_icao").collect()] == [(1, "KATL", "KDFW")]


def test_literal_table_has_no_limit_and_no_hint(spark):
    table = dimensions.literal_table(spark, [(i,) for i in range(10_001)], "i INT")
    assert table.count() == 10_001
    assert "ResolvedHint" not in table._jdf.queryExecution().logical().toString()


def test_densify(spark, rows):
    domain = spark.createDataFrame([("a",), ("b",), ("a",)], "k STRING")
    summary = spark.createDataFrame([("a", 2)], "k STRING, n INT")
    assert rows(joins.densify(domain, summary, ["k"], {"n": 0})) == [("a", 2), ("b", 0)]


def test_replacement(spark, rows):
    df = spark.createDataFrame([("AA",), ("ZZ",), (None,)], "c STRING")
    assert rows(shaping.replace_codes(df, "c", dimensions.CARRIER_NAMES, "airline")) == [
        ("American Airlines",), ("ZZ",), (None,)
    ]
    table = spark.createDataFrame([("AA", "American Airlines")], "code STRING, name STRING")
    assert rows(shaping.replace_codes_from(df, "c", table, "code", "name")) == [("American Airlines",), ("ZZ",), (None,)]


def test_shaping(spark, rows):
    df = spark.createDataFrame([(1, None, ("x", 2.0))], "`Name ` INT, v DOUBLE, s STRUCT<A: STRING, B: DOUBLE>")
    df = shaping.strip_header_spaces(df)
    assert df.columns == ["Name", "v", "s"]
    df = shaping.prefix_struct(df, "s", "Origin")
    df = shaping.add_missing(df, ["v", "w"])
    df = shaping.fill_nulls(df, {"v": 7, "absent": 1})
    assert df.columns == ["Name", "v", "OriginA", "OriginB", "w"]
    assert rows(df) == [(1, 7.0, "x", 2.0, 0.0)]
    assert shaping.rename_present(df, {"nope": "n", "w": "z"}).columns[-1] == "z"


def test_describe_and_quantiles_like_pandas(spark):
    draw = random.Random(4)
    data = [(draw.choice("aaaab"), float(draw.randrange(-20, 60))) for _ in range(501)] + [("a", None), ("c", 3.0)]
    df = spark.createDataFrame(data, "k STRING, v DOUBLE")
    got = {r["k"]: r for r in profile.describe_groups(df, ["k"], "v").collect()}
    frame = pd.DataFrame(data, columns=["k", "v"]).groupby("k")["v"].describe()
    for key, row in frame.iterrows():
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                             ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            if math.isnan(row[theirs]):
                assert got[key][ours] is None
            else:
                assert got[key][ours] == pytest.approx(row[theirs])
    single = quantiles.summarise(df, [], "v", {"p90": 0.9}).first()["p90"]
    assert single == pytest.approx(pd.Series([v for _, v in data]).quantile(0.9))


def test_medians(spark, rows):
    df = spark.createDataFrame([(1, 2.0, None), (3, None, None), (2, 4.0, None)], "a INT, b DOUBLE, c DOUBLE")
    assert rows(profile.column_medians(df, ["a", "b", "c"])) == [("a", 2.0), ("b", 3.0), ("c", 0.0)]
    assert rows(profile.column_medians(df, ["a", "c"], accuracy=1000)) == [("a", 2.0), ("c", 0.0)]


def test_correlations_like_pandas(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame(rng.normal(size=(700, 3)), columns=["a", "b", "c"])
    frame["b"] = frame["a"] * 2 + frame["b"] + 1e9
    frame["flat"] = 5.0
    frame["empty"] = np.nan
    for name in ("a", "b", "c"):
        frame.loc[rng.random(700) < 0.3, name] = np.nan
    data = [tuple(None if math.isnan(v) else float(v) for v in row) for row in frame.itertuples(index=False)]
    names = list(frame.columns)
    df = spark.createDataFrame(data, ", ".join(f"{n} DOUBLE" for n in names)).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = {(r["x"], r["y"]): r["corr"] for r in profile.correlation_matrix(df, names).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    wanted = frame.corr()
    for x in ("a", "b", "c"):
        for y in ("a", "b", "c"):
            assert got[x, y] == pytest.approx(wanted.loc[x, y], abs=1e-6)
    assert len(got) == len(names) ** 2
    assert all(got[pair] is None for pair in (("a", "flat"), ("flat", "flat"), ("empty", "empty"), ("a", "empty")))


def test_null_profile(spark, rows):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a INT, b STRING, c ARRAY<INT>")
    assert rows(profile.null_profile(df)) == [("b", 1), ("c", 2)]


def test_timeframes_and_requests(spark, rows):
    at = [dt.datetime(2024, 1, 1, 0, 5), dt.datetime(2024, 2, 29, 23, 0), None]
    df = spark.createDataFrame([("KA", "KB", t) for t in at], "o STRING, d STRING, t TIMESTAMP_NTZ")
    frames = timeframes.station_timeframes(df, {"Origin": "o", "Destination": "d"}, "t")
    assert frames.groupBy("station").agg(F.sum("records")).count() == 2
    assert rows(frames.agg(F.sum("records"))) == [(4,)]
    queries = rows(timeframes.observation_requests(frames.filter("role = 'Origin'")), "query")
    assert queries[0][0].startswith("station=KA&data=metar&year1=2023&month1=12&day1=31&")
    assert any("year2=2024&month2=3&day2=1&" in text for (text,) in queries)


def test_paged_lists_keep_every_record(spark):
    data = [("hot", i) for i in range(2500)] + [("cold", i) for i in range(10)] + [(None, 1)]
    df = spark.createDataFrame(data, "k STRING, i BIGINT")
    paged = lists.paged_records(df, ["k"], ["i"], 100, "i").collect()
    assert sum(r["num_records"] for r in paged) == len(data)
    hot = [r for r in paged if r["k"] == "hot"]
    assert len(hot) == 25 and max(r["num_records"] for r in hot) == 100
    assert sorted(x["i"] for r in hot for x in r["records"]) == list(range(2500))
    assert [r["num_records"] for r in paged if r["k"] is None] == [1]


def test_rolling_and_prior(spark, rows):
    day = dt.date(2024, 1, 1)
    data = [("r", day + dt.timedelta(days=d), v) for d, v in ((0, 10.0), (0, 20.0), (3, 30.0), (9, 50.0), (9, None))]
    df = spark.createDataFrame(data, "k STRING, d DATE, v DOUBLE")
    assert rows(rolling.rolling_average(df, ["k"], "d", "v"), "d", "rolling_avg") == [
        (day, 15.0), (day + dt.timedelta(days=3), 20.0), (day + dt.timedelta(days=9), 40.0)
    ]
    assert rows(rolling.prior_average(df, ["k"], "d", "v"), "d", "prior_avg") == [
        (day, None), (day + dt.timedelta(days=3), 15.0), (day + dt.timedelta(days=9), 20.0)
    ]
    attached = rolling.attach_prior_average(df, ["k"], "d", "v")
    assert attached.count() == 5 and attached.filter("prior_avg = 20").count() == 2


def test_lists_of_columns_with_any_name(spark):
    df = spark.createDataFrame([("a", i, "x") for i in range(5)] + [(None, 9, "y")], "pages STRING, _pages LONG, page STRING")
    got = lists.paged_records(df, ["pages"], ["_pages", "page"], 2, "_pages", "found").collect()
    assert sorted((row[0] or "", row["num_records"]) for row in got) == [("", 1), ("a", 1), ("a", 2), ("a", 2)]
    assert sum(len(row["found"]) for row in got) == 6
