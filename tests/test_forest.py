"""Forests fitted on packed rows against Spark ML's own, where nothing is drawn, and by what their draws should give."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler

from punctual.plans import forest, model


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(5)
    made = []
    for number in range(2000):
        place, wind = draw.randrange(6), draw.choice([0.0, -2.5, 1.0, 4.0, draw.uniform(0, 9)])
        late = draw.random() < (0.85 if place == 2 and wind > 1 else 0.15 + 0.05 * place)
        made.append((number, float(place), wind, draw.uniform(-1, 1), int(late)))
    table = spark.createDataFrame(made, "id INT, place DOUBLE, wind DOUBLE, other DOUBLE, label INT")
    coded = OneHotEncoder(inputCol="place", outputCol="code").fit(table).transform(table)
    return VectorAssembler(inputCols=["code", "wind", "other"], outputCol="features").transform(coded).cache()


def nodes(fitted):
    return sorted(line for line in fitted.toDebugString.splitlines() if "uid" not in line)


def test_same_tree_as_spark_ml_where_nothing_is_drawn(rows, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_ROWS", 256)
    plain = {"bootstrap": False, "featureSubsetStrategy": "all", "seed": 4}
    mine = model.packed_forest(2, 6, **plain)
    assert isinstance(mine, forest.EntryForest)
    theirs = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=2, maxDepth=6, **plain)
    found, expected = mine.fit(rows), theirs.fit(rows)
    assert nodes(found) == nodes(expected) and found.totalNumNodes > 30
    assert np.allclose(found.featureImportances.toArray(), expected.featureImportances.toArray(), rtol=1e-9)
    scores = [[r["probability"][1] for r in m.transform(rows).orderBy("id").collect()] for m in (found, expected)]
    assert np.allclose(*scores, rtol=1e-12)


def test_draws(rows, tmp_path):
    mine = model.packed_forest(30, 5, seed=4)
    found = mine.fit(rows)
    assert found.getNumTrees == 30 and len({tree.toDebugString.split("\n", 1)[1] for tree in found.trees}) > 25
    again = [[r["probability"][1] for r in m.transform(rows).orderBy("id").collect()] for m in (found, mine.fit(rows))]
    assert again[0] == again[1]
    theirs = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=30, maxDepth=5, seed=4).fit(rows)
    scores = [r["probability"][1] for r in theirs.transform(rows).orderBy("id").collect()]
    assert np.corrcoef(again[0], scores)[0, 1] > 0.95 and abs(np.mean(again[0]) - np.mean(scores)) < 0.02
    found.save(str(tmp_path / "forest"))
    loaded = RandomForestClassificationModel.load(str(tmp_path / "forest"))
    assert [r["probability"][1] for r in loaded.transform(rows).orderBy("id").collect()] == again[0]


def test_little_memory_gives_the_same_trees(rows, monkeypatch):
    whole = model.packed_forest(6, 4, seed=2).fit(rows)
    monkeypatch.setattr(forest.EntryForest, "getMaxMemoryInMB", lambda self: 0)
    assert nodes(model.packed_forest(6, 4, seed=2).fit(rows)) == nodes(whole)


def test_a_row_is_kept_by_its_entries_and_a_byte_per_tree(rows, monkeypatch):
    table = rows.select(forest.F.unwrap_udt("features").alias("vector"), forest.F.col("label").cast("double").alias("label")).limit(50).toArrow()
    bins = forest.Bins([None] * 5 + [np.array([0.5]), np.array([0.0])])
    monkeypatch.setattr(forest.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    block = forest._pack(bins, 10, 1, True)(table, 0)
    assert len(block["bins"]) <= 2 * 3 * 50 and len(block["counts"]) == 10 * 50 and len(block["label"]) == 50
