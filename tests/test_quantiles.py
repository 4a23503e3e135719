import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.operators import profile, quantiles
from punctual.sources import files

NAMES = {"q0": 0.0, "q1": 0.013, "q25": 0.25, "q5": 0.5, "q9": 0.9, "q1000": 1.0}


def check(spark, groups, schema="k STRING, v DOUBLE"):
    rows = [(key, value) for key, values in groups.items() for value in values]
    random.Random(1).shuffle(rows)
    got = {row[0]: row for row in quantiles.summarise(spark.createDataFrame(rows, schema).repartition(3), ["k"], "v", NAMES, moments=True).collect()}
    for key, values in groups.items():
        known = [float(v) for v in values if v is not None]
        if not known:
            assert key not in got
            continue
        for name, q in NAMES.items():
            assert got[key][name] == pytest.approx(np.quantile(known, q), rel=1e-12, abs=1e-300), (key, name)
        assert got[key]["count"] == len(known) and got[key]["min"] == min(known) and got[key]["max"] == max(known)
        assert got[key]["mean"] == pytest.approx(np.mean(known), rel=1e-9, abs=1e-12)
        if len(known) > 1:
            assert got[key]["std"] == pytest.approx(np.std(known, ddof=1), rel=1e-9, abs=1e-12)
        else:
            assert got[key]["std"] is None


def test_values_of_every_size(spark):
    chance = random.Random(2)
    check(
        spark,
        {
            "close": [1 + chance.random() * 1e-9 for _ in range(900)],
            "wide": [chance.choice([-1, 1]) * 10 ** chance.uniform(-150, 150) for _ in range(901)],
            "uniform": [chance.random() for _ in range(2000)],
            "steps": [float(chance.randrange(-9, 9)) for _ in range(700)],
            "powers": [2.0**k for k in range(-40, 40)] + [math.nextafter(2.0**k, 0) for k in range(-40, 40)],
            "one": [3.5],
            "same": [7.25] * 300,
            "none": [None, None],
            "zeros": [0.0, -0.0, None, 5e-324, -5e-324],
            None: [1.0, 2.0, 4.0],
        },
    )


def test_whole_numbers_and_awkward_names(spark):
    df = spark.createDataFrame([("a", 10**15 + i % 7, "x") for i in range(100)], "_n STRING, pages LONG, _v STRING")
    row = quantiles.summarise(df, ["_n"], "pages", {"_low": 0.5}).first()
    assert row.asDict() == {"_n": "a", "_low": float(10**15 + 3)}
    assert quantiles.summarise(df.limit(0), ["_n"], "pages", {"m": 0.5}, moments=True).count() == 0


def test_nan_and_infinity(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("i", v) for v in (1.0, inf, 2.0, inf, inf)] + [("n", v) for v in (nan, 1.0, 2.0)] + [("m", v) for v in (-inf, inf)] + [("x", nan)]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE")
    got = {row["k"]: row for row in profile.describe_groups(df, ["k"], "v").collect()}
    assert (got["i"]["p25"], got["i"]["p50"], got["i"]["max"], got["i"]["mean"]) == (2.0, inf, inf, inf)
    assert math.isnan(got["i"]["std"])
    assert got["n"]["count"] == 3 and got["n"]["p50"] == 2.0 and got["n"]["min"] == 1.0 and math.isnan(got["n"]["max"])
    assert math.isnan(got["n"]["mean"]) and math.isnan(got["x"]["p50"])
    assert got["m"]["min"] == -inf and got["m"]["max"] == inf
    medians = {row["column"]: row["median"] for row in profile.column_medians(df.select("v", F.lit(None).cast("double").alias("w")), ["v", "w"]).collect()}
    assert medians == {"v": inf, "w": 0.0}


def test_no_task_holds_the_values(spark, monkeypatch):
    """A measure spread over one doubling with as many values as rows: counts of a bounded number of cells at any time."""
    seen, store = [], quantiles.stored

    def counting(session, df, label):
        kept = store(session, df, label)
        seen.append((label, kept.count()))
        return kept

    monkeypatch.setattr(quantiles, "stored", counting)
    monkeypatch.setattr(quantiles, "CELLS", 64)
    n = 200_000
    df = spark.range(n).select((1 + F.pmod(F.col("id") * 7919, F.lit(n)) / n).alias("v"))
    row = quantiles.summarise(df, [], "v", {"p50": 0.5, "p99": 0.99}).first()
    assert row["p50"] == pytest.approx(1 + (n - 1) / 2 / n, abs=1e-12) and row["p99"] == pytest.approx(1 + 0.99 * (n - 1) / n, abs=1e-12)
    assert dict(seen)["value-cells"] <= quantiles.PER_DOUBLING + 1
    assert all(rows <= 4 for label, rows in seen if label == "ranks") and len(seen) > 3


def test_sketches_merge_and_replace_days(spark, tmp_path):
    chance = random.Random(3)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]
    rows = [(day, chance.choice("ab"), chance.gauss(0, 5)) for day in days for _ in range(2000)]
    rows += [(days[0], "a", None), (days[0], "a", float("nan")), (days[1], "b", float("inf"))]
    df = spark.createDataFrame(rows, "day DATE, k STRING, v DOUBLE")
    path = str(tmp_path / "sketches")
    wrong = df.filter(F.col("day") < days[3]).withColumn("v", F.col("v") + 1000)
    for part in (wrong, df.filter(F.col("day") >= days[3]), df.filter(F.col("day") < days[3]), df.filter(F.col("day") == days[5])):
        files.replace_parts(quantiles.daily_sketches(part, "day", ["k"], "v"), "day", path)
    stored = files.read_parts(spark, path)
    assert stored.count() == 12
    asked = {"p5": 0.05, "p50": 0.5, "p95": 0.95}
    for keys in (["k"], []):
        found = quantiles.merged_quantiles(stored, keys, asked)
        real = df.filter("v IS NOT NULL AND NOT isnan(v) AND v < double('infinity')")
        errors = quantiles.rank_errors(real, keys, "v", found, asked).collect()
        assert len(errors) == 3 * (2 if keys else 1)
        assert max(row["error"] for row in errors) < 0.02
    assert quantiles.merged_quantiles(stored.limit(0), ["k"], asked).count() == 0


def test_rank_error_of_wrong_estimates(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    guess = spark.createDataFrame([(60.0, 25.0)], "p50 DOUBLE, p25 DOUBLE")
    got = {row["quantile"]: row["error"] for row in quantiles.rank_errors(df, [], "v", guess, {"p50": 0.5, "p25": 0.25}).collect()}
    assert got["p50"] == pytest.approx((60 - 50.5) / 101) and got["p25"] == 0.0
