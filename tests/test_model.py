"""Models on data with a clear signal: evening legs of one carrier are late."""

import threading

import pytest
from pyspark.sql import functions as F

from punctual.plans import features, model

SPEC = features.FeatureSpec(
    date="day", dep_hhmm="dep", arr_hhmm="arr", label="late", categories=("carrier",), lists=("clouds",),
    numbers=("wind",), passed_on=("id",),
)


@pytest.fixture(scope="module")
def legs(spark):
    return spark.range(3000).select(
        F.col("id"),
        F.expr("date_add(DATE'2024-01-01', CAST(id % 400 AS INT))").alias("day"),
        F.expr("CAST(id * 7 % 24 * 100 + 5 AS INT)").alias("dep"),
        F.expr("CAST((id * 7 + 1) % 24 * 100 + 5 AS INT)").alias("arr"),
        F.expr("element_at(array('X', 'Y', 'Z'), CAST(id % 3 + 1 AS INT))").alias("carrier"),
        F.expr("CASE WHEN id % 5 = 0 THEN array() ELSE array('few', 'broken') END").alias("clouds"),
        F.expr("CASE WHEN id % 4 > 0 THEN CAST(id % 11 AS DOUBLE) END").alias("wind"),
        F.expr("CASE WHEN id % 50 = 0 THEN NULL WHEN id * 7 % 24 >= 16 AND id % 3 = 1 THEN 1.0 ELSE 0.0 END").alias("late"),
    )


@pytest.fixture(scope="module")
def parts(legs):
    raw = features.labelled(features.raw_features(legs, SPEC))
    training, test = model.train_test(raw, "id")
    fills = features.fit_fills(training, SPEC)
    return [features.shaping.fill_nulls(part, fills).cache() for part in (training, test)], fills


@pytest.fixture(scope="module")
def trees(parts):
    return model.fit(SPEC, parts[0][0], model.boosted_trees(depth=4, iterations=5, seed=1))


def test_split_is_a_function_of_the_key(legs, parts):
    (training, test), _ = parts
    total = training.count() + test.count()
    assert total == 2940 and 0.75 < training.count() / total < 0.85
    again, _ = model.train_test(features.labelled(features.raw_features(legs.repartition(13), SPEC)), "id")
    assert again.select("id").exceptAll(training.select("id")).count() == 0
    halves = model.random_train_test(training)
    assert sum(part.count() for part in halves) == training.count()


def test_fills_come_from_training_rows_only(parts):
    (training, _), fills = parts
    assert fills["wind"] == 5.0 and set(fills) == set(SPEC.number_columns)
    assert training.filter("wind IS NULL").count() == 0


def test_better_than_always_on_time(parts, trees):
    (_, test), _ = parts
    row = model.metrics_table(model.score(trees, test)).first()
    majority = test.filter("label = 0").count() / test.count()
    assert row["accuracy"] > majority + 0.05 and row["recall"] > 0.9


def test_plain_metrics_equal_the_evaluators(parts, trees):
    (_, test), _ = parts
    raw = trees.transform(test).withColumn("label", F.col("label").cast("double"))
    evaluated = model.evaluator_metrics(raw)
    plain = model.metrics_table(model.score(trees, test)).first()
    for name in ("accuracy", "f1", "precision", "recall"):
        assert plain[name] == pytest.approx(evaluated[name])
    assert evaluated["roc_auc"] > 0.9 and evaluated["pr_auc"] > 0.8
    assert sum(r["rows"] for r in model.confusion(model.score(trees, test)).collect()) == test.count()


def test_save_load_score(spark, parts, trees, tmp_path):
    (_, test), _ = parts
    model.save(trees, str(tmp_path / "m"))
    loaded = model.load(str(tmp_path / "m"))
    same = model.score(loaded, test).select("id", "prediction", "delay_probability")
    assert same.exceptAll(model.score(trees, test).select("id", "prediction", "delay_probability")).count() == 0


def test_unseen_category_and_unlabelled_rows_can_be_scored(spark, parts, trees):
    _, fills = parts
    odd = spark.sql(
        "SELECT 1L AS id, DATE'2024-01-06' AS day, 1805 AS dep, 1905 AS arr, 'new' AS carrier, "
        "CAST(NULL AS ARRAY<STRING>) AS clouds, CAST(NULL AS DOUBLE) AS wind"
    )
    row = model.score(trees, features.build_features(odd, SPEC, fills)).first()
    assert row["prediction"] in (0, 1) and 0 <= row["delay_probability"] <= 1


def test_score_of_a_date_and_of_ids(spark, parts, trees):
    (_, test), _ = parts
    day = test.agg(F.min("leg_day")).first()[0].isoformat()
    scored = model.score_date(trees, test, day, ["id"])
    minutes = [r["dep_minute_of_day"] for r in scored.collect()]
    assert minutes == sorted(minutes) and scored.count() == test.filter(F.col("leg_day") == day).count()
    ids = test.select("id").limit(3)
    assert model.score_ids(trees, test, ids.unionAll(ids), "id").count() == 3


def test_segments_weeks_importance(spark, parts, trees):
    (_, test), _ = parts
    scored = model.score(trees, test)
    assert model.error_by_segment(scored, "carrier").agg(F.sum("rows")).first()[0] == test.count()
    assert model.performance_over_time(scored).agg(F.sum("rows")).first()[0] == test.count()
    importance = model.feature_importance(spark, trees, test).collect()
    assert importance[0]["feature"] in ("DepHour", "ArrHour", "carrier_code_Y")
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)


def test_class_weights_balance(parts):
    (training, _), _ = parts
    sums = model.with_class_weight(training).groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert sums[0]["w"] == pytest.approx(sums[1]["w"]) == pytest.approx(training.count() / 2)


def test_forest_with_scaled_numbers(parts):
    (training, test), _ = parts
    forest = model.fit(SPEC, training, model.random_forest(trees=10, depth=6, seed=1), scale_numbers=True)
    assert model.metrics_table(model.score(forest, test)).first()["accuracy"] > 0.8


def test_grid_and_half_years(spark, legs, parts, tmp_path):
    (training, _), _ = parts
    found = model.grid_search(SPEC, training, {"maxDepth": [1, 4], "maxIter": [2]}, folds=2)
    results = model.grid_results(spark, found).collect()
    assert {r["parameters"] for r in results} == {"maxDepth=1, maxIter=2", "maxDepth=4, maxIter=2"}
    assert [r["roc_auc"] for r in results if r["best"]] == [max(r["roc_auc"] for r in results)]
    raw = features.labelled(features.raw_features(legs, SPEC))
    ranges = model.compare_ranges(raw, SPEC, "id", model.random_forest(trees=2, depth=3, seed=1), str(tmp_path / "h"))
    assert [r["range_start"] for r in ranges.collect()] == ["2024-01", "2024-07", "2025-01"]


def test_every_range_has_a_row(spark, legs, tmp_path):
    raw = features.labelled(features.raw_features(legs, SPEC)).filter("leg_day < '2024-03-01' OR label = 0")
    ranges = model.compare_ranges(raw, SPEC, "id", model.random_forest(trees=2, depth=3, seed=1), str(tmp_path / "r"), months=2, step=1)
    got = {r["range_start"]: r for r in ranges.collect()}
    assert list(got) == [*[f"2024-{m:02d}" for m in range(1, 13)], "2025-01", "2025-02"]
    assert got["2024-01"]["accuracy"] is not None and got["2024-06"]["accuracy"] is None and got["2024-06"]["rows"] > 0
    empty = model.compare_ranges(raw.limit(0), SPEC, "id", model.random_forest(), str(tmp_path / "e"))
    assert empty.count() == 0


def test_curve_areas_equal_the_evaluator(spark, parts, trees):
    (_, test), _ = parts
    raw = trees.transform(test).select(F.col("label").cast("double").alias("label"), "prediction", "probability")
    wanted = model.evaluator_metrics(raw)
    got = model.curve_table(model.score(trees, test)).first()
    assert got["roc_auc"] == pytest.approx(wanted["roc_auc"], abs=1e-9)
    assert got["pr_auc"] == pytest.approx(wanted["pr_auc"], abs=1e-6)


def test_stored_splits(spark, parts, tmp_path):
    (training, _), _ = parts
    model.write_splits(training, "id", str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == training.count() and "split" in stored.columns


def test_word_flags_take_the_place_of_list_texts(legs):
    words = {"clouds": ["few", "broken", "overcast"]}
    flagged = features.with_word_flags(legs, words).select("id", "clouds", "clouds_few", "clouds_broken", "clouds_overcast")
    row = flagged.filter("id = 1").first()
    assert (row["clouds_few"], row["clouds_broken"], row["clouds_overcast"]) == (1.0, 1.0, 0.0)
    assert flagged.filter("id = 5").first()["clouds_few"] == 0.0
    raw = features.labelled(features.build_features(legs, SPEC, {"wind": 5.0})).join(flagged.drop("clouds"), "id")
    names = ["clouds_few", "clouds_broken", "clouds_overcast"]
    fitted = model.fit(SPEC, raw, model.boosted_trees(depth=2, iterations=2), word_flags=names)
    assert model.score(fitted, raw).filter("prediction IS NULL").count() == 0


def test_ranges_are_fitted_side_by_side(spark, legs, tmp_path, monkeypatch):
    raw = features.labelled(features.raw_features(legs, SPEC))
    forest, fit, together = model.random_forest(trees=2, depth=3, seed=1), model.fit, threading.Barrier(2)
    alone = model.compare_ranges(raw, SPEC, "id", forest, str(tmp_path / "1"), months=4, step=4, parallelism=1).collect()

    def waiting(*arguments):
        together.wait(timeout=60)  # comes back only once two fits have begun
        return fit(*arguments)

    monkeypatch.setattr(model, "fit", waiting)
    ranges = model.compare_ranges(raw, SPEC, "id", forest, str(tmp_path / "2"), months=4, step=4, parallelism=2).collect()
    assert ranges == alone and len([r for r in ranges if r["accuracy"] is not None]) == 4
