import datetime as dt
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from punctual.operators import bitmaps, rolling as days
from punctual.plans import features, model
from punctual.sources import files
from punctual.streaming import late, rolling, sinks

START = dt.date(2024, 1, 1)
EVENT = "id INT, at TIMESTAMP, k STRING"


def test_bitmaps_against_sets(spark, rows):
    chance = random.Random(1)
    far = [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2400, 2, 29), dt.date(9999, 12, 31)]
    data = [(chance.choice(["a", "b", None]), chance.choice([START + dt.timedelta(days=chance.randrange(900)), chance.choice(far)]), chance.randrange(3)) for _ in range(500)]
    data += [("c", None, 0)]
    df = spark.createDataFrame(data, "k STRING, d DATE, load INT")
    stored = bitmaps.day_bitmaps(df, ["k", "load"], "d")
    assert {len(row["days"]) for row in stored.collect()} == {4096}
    want = {}
    for key, date, _ in data:
        if date is not None:
            want.setdefault(key, set()).add(date)
    got = {row["k"]: row["dates"] for row in bitmaps.day_lists(stored, ["k"]).collect()}
    assert got == {key: sorted(dates) for key, dates in want.items()}
    assert {row["k"]: row["num_days"] for row in bitmaps.counts(stored, ["k"]).collect()} == {k: len(v) for k, v in want.items()}
    assert bitmaps.day_lists(stored.limit(0), ["k"]).count() == 0


def test_totals_after_repeated_and_corrected_loads(spark, tmp_path, rows):
    chance = random.Random(2)
    data = [(START + dt.timedelta(days=chance.randrange(20)), chance.choice("ab"), float(chance.randrange(50))) for _ in range(400)]
    df = spark.createDataFrame(data, "day DATE, k STRING, v DOUBLE")
    path, cut = str(tmp_path / "totals"), F.lit(START + dt.timedelta(days=9))
    wrong = df.filter(F.col("day") < cut).withColumn("v", F.col("v") * 100)
    right, rest = df.filter(F.col("day") < cut), df.filter(F.col("day") >= cut)
    for part in (wrong, rest, right, rest):
        files.replace_parts(days.daily_totals(part, ["k"], "day", "v"), "day", path)
    totals = files.read_parts(spark, path)
    names = ["k", "day", "day_sum", "day_rows"]
    assert rows(days.rolling_from_totals(totals, ["k"], "day", 5), *names, "rolling_avg") == rows(days.rolling_average(df, ["k"], "day", "v", 5), *names, "rolling_avg")
    assert rows(days.prior_from_totals(totals, ["k"], "day"), *names, "prior_avg") == rows(days.prior_average(df, ["k"], "day", "v"), *names, "prior_avg")


def _minute(n):
    return dt.datetime(2024, 5, 1) + dt.timedelta(minutes=n)


def _run(stream, folder):
    query = late.split_late(stream, "at", "10 minutes", 1800, f"{folder}/split", f"{folder}/state")
    query.awaitTermination()
    assert query.exception() is None


def test_late_rows_are_kept_and_merged(spark, tmp_path, rows):
    """Three files read one by one; the last one brings rows of closed windows. A restart judges by the same marks."""
    folder = str(tmp_path)
    parts = [[(1, _minute(5), "a"), (2, _minute(100), "b"), (3, None, "a")], [(4, _minute(200), "a"), (5, _minute(75), "b")], [(6, _minute(1), "a"), (7, _minute(205), "b"), (8, _minute(171), "a"), (9, _minute(99), "b")]]
    seen = []
    for part in parts:
        spark.createDataFrame(part, EVENT).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        seen += part
        schema = spark.createDataFrame([], EVENT).schema
        _run(sinks.file_stream(spark, f"{folder}/in", schema, files_per_batch=1), folder)
    # Marks: 100 after the first file, 200 after the second; a window is closed 30 minutes behind them.
    assert rows(late.read_part(spark, f"{folder}/split", "late", schema), "id") == [(6,), (9,)]
    assert rows(late.read_part(spark, f"{folder}/split", "on_time", schema), "id") == [(1,), (2,), (4,), (5,), (7,), (8,)]
    metrics = {"n": F.count(F.lit(1)), "ids": F.sum("id")}
    windows = {name: rolling.windowed_metrics(late.read_part(spark, f"{folder}/split", name, schema), "at", ["k"], metrics, "10 minutes").drop("window_end") for name in ("on_time", "late")}
    late.store_windows(windows["on_time"], f"{folder}/windows")
    late.merge_late(spark, f"{folder}/windows", windows["late"], ["k"], ["n", "ids"])
    whole = rolling.windowed_metrics(spark.createDataFrame(seen, EVENT).filter("at IS NOT NULL"), "at", ["k"], metrics, "10 minutes").drop("window_end")
    names = ["k", "window_start", "n", "ids"]
    assert rows(late.windows(spark, f"{folder}/windows"), *names) == rows(whole, *names)
    late.merge_late(spark, f"{folder}/windows", windows["late"].limit(0), ["k"], ["n", "ids"])
    assert rows(late.windows(spark, f"{folder}/windows"), *names) == rows(whole, *names)


def test_hashed_slots_hold_any_vocabulary(spark):
    spec = features.FeatureSpec(date="d", dep_hhmm="t", arr_hhmm="t", label="label", categories=("c",), lists=("w",), numbers=("x",))
    n = 3000
    df = spark.range(n).select(
        F.concat(F.lit("code"), F.col("id")).alias("c"),
        F.when(F.col("id") % 3 == 0, "rain,fog,rain").when(F.col("id") % 3 == 1, F.lit(None).cast("string")).otherwise("clear").alias("w"),
    )
    coded = model.slot_encoder(32).transform(features.hashed_slots(df, spec, 32)).select("c", "w", vector_to_array("hashed").alias("v"))
    sample = coded.orderBy("c").limit(300).collect()
    import hashlib

    for row in sample:
        words = ["c=" + row["c"]] + ["w=" + word for word in (row["w"] or "None").split(",")]
        want = [0.0] * 32
        for word in words:
            want[int(hashlib.md5(word.encode()).hexdigest()[:7], 16) % 32] += 1
        assert row["v"] == want


def test_model_on_hashed_features_beats_the_majority(spark):
    spec = features.FeatureSpec(date="d", dep_hhmm="t", arr_hhmm="t", label="label", categories=("c",), lists=("w",), numbers=("x",))
    numbers = {name: F.lit(0.0) for name in spec.number_columns}
    rows = spark.range(1200).withColumns(numbers).withColumns(
        {
            "c": F.concat(F.lit("carrier"), F.col("id") % 40),
            "w": F.when(F.col("id") % 5 < 2, "storm").otherwise("clear"),
            "x": (F.col("id") % 7).cast("double"),
            "label": F.when((F.col("id") % 5 < 2) & (F.col("id") % 11 > 0), 1).otherwise(0),
        }
    )
    coded = features.hashed_slots(rows, spec, 64).cache()
    fitted = model.hashed_pipeline(spec, model.boosted_trees(depth=3, iterations=5), 64).fit(coded.filter("id < 900"))
    scored = model.score(fitted, coded.filter("id >= 900"))
    got = model.metrics_table(scored).first()
    assert got["accuracy"] > 0.9 and fitted.stages[-1].numFeatures == 64 + len(spec.number_columns)
    unseen = coded.limit(1).withColumn("c", F.lit("never seen"))
    assert model.score(fitted, features.hashed_slots(unseen.drop("slots"), spec, 64)).count() == 1
    coded.unpersist()
    assert got["rows"] == pytest.approx(300)
