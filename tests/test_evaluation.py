import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from punctual.operators.ranking import numbered_by_digest
from punctual.plans import evaluation, lookup, model


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def table(spark, n=400):
    chance = random.Random(5)
    rows = [(i, chance.randrange(1440), chance.choice(["x", "y", None]), chance.choice([0, 1, None])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id LONG, minute INT, kind STRING, label INT").repartition(3)


def late(df):
    return df.withColumn("prediction", F.when(F.col("minute") >= 720, 1).otherwise(0))


def test_numbers_follow_the_hash(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("d"))
    got = numbered_by_digest(df, ["g"], "d", "n", digits=2).collect()
    for g in range(3):
        mine = sorted((row["d"], row["n"]) for row in got if row["g"] == g)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))


def test_a_hash_given_as_an_expression_is_not_moved(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), "id")
    numbered = numbered_by_digest(df, ["g"], F.md5(F.col("id").cast("string")), "n", digits=2)
    plan = numbered._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(", 1)
    assert "md5(" in plan[0] and "md5(" not in plan[1].replace("substring(md5(", "")
    by_column = numbered_by_digest(df.withColumn("d", F.md5(F.col("id").cast("string"))), ["g"], "d", "n", digits=2)
    assert sorted(numbered.collect()) == sorted(by_column.select("g", "id", "n").collect())


def test_permutation_is_one(spark):
    rows, df = table(spark)
    got = evaluation.permuted_values(df, "id", ["minute", "kind"], seed=3).collect()
    assert len(got) == 2 * len(rows)
    for name, at in (("minute", 1), ("kind", 2)):
        mine = {row["id"]: row["value"] for row in got if row["feature"] == name}
        places = sorted((row[0] for row in rows), key=lambda i: md5(f"3:{i}"))
        values = [row[at] for row in sorted(rows, key=lambda row: md5(f"3:{name}:{row[0]}"))]
        assert [mine[i] for i in places] == [None if v is None else str(v) for v in values]


def test_importance(spark):
    rows, df = table(spark)
    df = df.withColumn("label", F.when(F.col("label").isNotNull(), F.when(F.col("id") % 10 == 0, 1 - (F.col("minute") >= 720).cast("int")).otherwise((F.col("minute") >= 720).cast("int"))))
    known = [row for row in rows if row[3] is not None]
    got = {row["feature"]: row for row in evaluation.permutation_importance(df, "id", ["minute", "kind"], late).collect()}
    assert set(got) == {"minute", "kind"} and {row["rows"] for row in got.values()} == {len(known)}
    assert got["kind"]["importance"] == 0.0
    assert got["minute"]["importance"] > 0.2
    again = {row["feature"]: row["importance"] for row in evaluation.permutation_importance(df.repartition(5), "id", ["minute", "kind"], late).collect()}
    assert again == {name: row["importance"] for name, row in got.items()}


def test_segments_against_every_combination(spark):
    chance = random.Random(6)
    rows = [(chance.choice(["A", "B", None]), chance.choice(["p", "q", None]), chance.randrange(3), chance.choice([0, 1]), chance.choice([0, 1])) for _ in range(300)]
    names = ["c", "a", "h"]
    scored = spark.createDataFrame(rows, "c STRING, a STRING, h INT, label INT, prediction INT")
    for least in (1, 25):
        got = {(r["level"], r["c"], r["a"], r["h"]): r for r in evaluation.segments(scored, names, least).collect()}
        want = {}
        for size in range(4):
            for fixed in itertools.combinations(range(3), size):
                for values in {tuple(row[i] for i in fixed) for row in rows}:
                    mine = [row for row in rows if tuple(row[i] for i in fixed) == values]
                    key = ["+".join(names[i] for i in fixed), None, None, None]
                    for i, value in zip(fixed, values):
                        key[1 + i] = value
                    parent = [row for row in rows if tuple(row[i] for i in fixed[:-1]) == values[:-1]] if fixed else None
                    rate = sum(row[3] != row[4] for row in mine) / len(mine)
                    lift = rate / (sum(row[3] != row[4] for row in parent) / len(parent)) if parent else None
                    if len(mine) >= least:
                        want[tuple(key)] = (len(mine), rate, lift)
        assert set(got) == set(want)
        for key, (n, rate, lift) in want.items():
            assert got[key]["rows"] == n and got[key]["error_rate"] == pytest.approx(rate)
            assert got[key]["lift"] == (None if lift is None else pytest.approx(lift))


def test_null_scores_rank_last(spark):
    rows = [(1, 0.9), (1, None), (0, 0.5), (0, float("nan")), (0, 0.95), (1, 0.2)]
    got = model.curve_table(spark.createDataFrame(rows, "label INT, delay_probability DOUBLE")).first()
    low = [(label, -1.0 if p is None or p != p else p) for label, p in rows]
    pairs = [(a, b) for x, a in low if x == 1 for y, b in low if y == 0]
    assert got["roc_auc"] == pytest.approx(sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs))
    worst = model.curve_table(spark.createDataFrame([(1, None), (0, 0.5)], "label INT, delay_probability DOUBLE")).first()
    assert worst["roc_auc"] == 0.0


def test_metrics_like_the_evaluators(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

    chance = random.Random(7)
    rows = [(label := chance.choice([0, 1]), round(min(max(chance.gauss(0.4 + 0.2 * label, 0.2), 0.0), 1.0), 2)) for _ in range(500)]
    scored = spark.createDataFrame(rows, "label INT, delay_probability DOUBLE").withColumn("prediction", (F.col("delay_probability") > 0.5).cast("int"))
    got = {row["metric"]: row["value"] for row in model.all_metrics(scored).collect()}
    raw = scored.select(F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"), F.col("delay_probability").alias("raw"))
    multi = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricLabel=1.0)
    for name, theirs in (("accuracy", "accuracy"), ("f1", "f1"), ("precision", "precisionByLabel"), ("recall", "recallByLabel")):
        assert got[name] == pytest.approx(multi.setMetricName(theirs).evaluate(raw))
    curve = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="raw", numBins=0)
    for name, theirs in (("roc_auc", "areaUnderROC"), ("pr_auc", "areaUnderPR")):
        assert got[name] == pytest.approx(curve.setMetricName(theirs).evaluate(raw))


def test_digest_ids(spark):
    rows = [(1, "a"), (1, None), (1, ""), (11, "a"), (1, "a")]
    got = [row["leg_id"] for row in lookup.with_digest_id(spark.createDataFrame(rows, "n INT, s STRING").coalesce(1), ["n", "s"]).collect()]
    assert len(set(got)) == 4 and got[0] == got[4] == md5("1=1|1=a")
