"""Training, evaluation and scoring of delay classifiers with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizerModel, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators.shaping import fill_nulls
from ..sources.dimensions import literal_table
from ..sources.files import write_partitioned
from .boosting import EntryBoosting
from .features import HASHED_WIDTH, FeatureSpec, build_features, fit_fills, scoring_row_to_leg
from .forest import EntryForest
from .lookup import by_ids


def split_column(key: str, train_percent: int = 80, seed: int = 42) -> Column:
    """``train`` or ``test`` by a hash of the row key: the same row falls on the same side in any run and
    any engine, after any repartitioning and when a lost task is computed again."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    bucket = F.conv(F.substring(digest, 1, 7), 16, 10).cast("int") % 100
    return F.when(bucket < train_percent, "train").otherwise("test")


def tag_split(features: DataFrame, key: str, train_percent: int = 80, seed: int = 42) -> DataFrame:
    return features.withColumn("split", split_column(key, train_percent, seed))


def train_test(features: DataFrame, key: str, train_percent: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    tagged = tag_split(features, key, train_percent, seed)
    return tagged.filter("split = 'train'").drop("split"), tagged.filter("split = 'test'").drop("split")


def random_train_test(features: DataFrame, train: float = 0.8, seed: int = 42) -> list[DataFrame]:
    """Spark's own seeded split; it depends on partitioning, so use it on a stored table."""
    return features.randomSplit([train, 1 - train], seed)


def seeded_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def boosted_trees(depth: int = 5, iterations: int = 50, **params) -> EntryBoosting:
    """Trees by the rules of ``GBTClassifier``, fitted on the entries of sparse rows (``boosting``)."""
    return EntryBoosting(labelCol="label", featuresCol="features", maxDepth=depth, maxIter=iterations, **params)


def random_forest(trees: int = 100, depth: int = 10, **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, **params)


def packed_forest(trees: int = 100, depth: int = 10, **params) -> EntryForest:
    """Trees by the rules of ``RandomForestClassifier``, fitted on packed rows (``forest``): for tables of many rows."""
    return EntryForest(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, **params)


def pipeline(
    spec: FeatureSpec,
    classifier: Estimator,
    scale_numbers: bool = False,
    keep_invalid: bool = True,
    word_flags: Sequence[str] | None = None,
) -> Pipeline:
    """Index and one-hot encode the categories, assemble with the numbers, classify.

    Unseen categories get an index of their own. ``scale_numbers`` standardises the numbers, which
    trees do not need but linear models do. ``word_flags`` names flag columns (``features.with_word_flags``) that take
    the place of the list texts, whose different combinations grow with the data.
    """
    categories = spec.category_columns if word_flags is None else list(spec.categories)
    indexes = [f"{c}_index" for c in categories]
    codes = [f"{c}_code" for c in categories]
    stages = [
        StringIndexer(inputCols=categories, outputCols=indexes, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexes, outputCols=codes),
    ]
    invalid = "keep" if keep_invalid else "error"
    numbers = [*spec.number_columns, *(word_flags or ())]
    if scale_numbers:
        stages += [
            VectorAssembler(inputCols=numbers, outputCol="numbers", handleInvalid=invalid),
            StandardScaler(inputCol="numbers", outputCol="scaled_numbers", withMean=True, withStd=True),
        ]
        numbers = ["scaled_numbers"]
    stages.append(VectorAssembler(inputCols=[*codes, *numbers], outputCol="features", handleInvalid=invalid))
    return Pipeline(stages=[*stages, classifier])


def slot_encoder(width: int = HASHED_WIDTH, slots: str = "slots", vector: str = "hashed") -> CountVectorizerModel:
    """A sparse vector of ``width`` counts from the slots that ``features.hashed_slots`` gives.

    Its vocabulary is the numbers of the slots, fixed by the width; nothing is fitted.
    """
    return CountVectorizerModel.from_vocabulary([str(slot) for slot in range(width)], inputCol=slots, outputCol=vector)


def hashed_pipeline(spec: FeatureSpec, classifier: Estimator, width: int = HASHED_WIDTH) -> Pipeline:
    """The pipeline for open vocabularies: hashed categories and list words beside the numbers.

    Rows need the column ``slots`` (``features.hashed_slots``). The vector has ``width`` slots and the numbers, however
    many categories there are, where ``pipeline`` has a slot for each.
    """
    assembler = VectorAssembler(inputCols=["hashed", *spec.number_columns], outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[slot_encoder(width), assembler, classifier])


def standardised(df: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """Numbers with mean 0 and standard deviation 1; rows with a missing number are left out."""
    assembler = VectorAssembler(inputCols=list(numbers), outputCol="_numbers", handleInvalid="skip")
    scaler = StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True)
    scaled = Pipeline(stages=[assembler, scaler]).fit(df).transform(df).withColumn("_scaled", vector_to_array("_scaled"))
    return scaled.withColumns({name: F.col("_scaled")[at] for at, name in enumerate(numbers)}).drop("_numbers", "_scaled")


def class_weights(training: DataFrame, weight: str = "weight") -> DataFrame:
    """Weight per label value with which both labels count the same in total."""
    everything = Window.partitionBy()
    rows, labels = F.sum("_rows").over(everything), F.count(F.lit(1)).over(everything)
    shares = training.groupBy("label").agg(F.count(F.lit(1)).alias("_rows"))
    return shares.select("label", (rows / (labels * F.col("_rows"))).alias(weight))


def with_class_weight(training: DataFrame, weight: str = "weight") -> DataFrame:
    """Add the weight column that a classifier takes as ``weightCol``."""
    return training.join(class_weights(training, weight), "label")


def fit(spec: FeatureSpec, training: DataFrame, classifier: Estimator, **options) -> PipelineModel:
    return pipeline(spec, classifier, **options).fit(training)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Features with ``prediction`` (int) and ``delay_probability``; works on batch and streaming tables."""
    scored = model.transform(features)
    helpers = [c for c in scored.columns if c not in features.columns and c not in ("prediction", "probability")]
    return scored.withColumns(
        {
            "delay_probability": vector_to_array("probability")[1],
            "prediction": F.col("prediction").cast("int"),
        }
    ).drop("probability", *helpers)


def rule_scores(features: DataFrame, late_when: Column) -> DataFrame:
    """A rule in the place of a model, as the baseline that a model has to beat."""
    says_late = F.when(late_when, 1).otherwise(0)
    return features.withColumns({"prediction": says_late, "delay_probability": says_late.cast("double")})


def score_typed_rows(
    model: PipelineModel | None, rows: DataFrame, spec: FeatureSpec, fills: Mapping[str, float], scorer=None
) -> DataFrame:
    """Scores for hand-typed legs, by the same feature build as everywhere else; ``scorer`` may stand in for the model."""
    built = build_features(scoring_row_to_leg(rows), spec, fills)
    scored = scorer(built) if scorer else score(model, built)
    return scored.select(*spec.passed_on, *spec.categories, "prediction", "delay_probability")


def all_metrics(scored: DataFrame) -> DataFrame:
    """``(metric, value)``: accuracy, weighted F1, precision and recall of the delayed class, both curve areas.

    Two aggregates over scored rows; give it a stored table, or the rows are scored for each of them.
    """
    names = ["accuracy", "f1", "precision", "recall"]
    areas = ["roc_auc", "pr_auc"]

    def long(row: DataFrame, columns: Sequence[str]) -> DataFrame:
        cells = [F.struct(F.lit(name).alias("metric"), F.col(name).alias("value")) for name in columns]
        return row.select(F.inline(F.array(*cells)))

    return long(metrics_table(scored), names).unionByName(long(curve_table(scored), areas))


def score_date(
    model: PipelineModel | None, features: DataFrame, day: str, columns: Sequence[str], scorer=None
) -> DataFrame:
    """Scored legs of one date in order of departure, with the printed labels.

    The date filter stands before the model, so other days are neither read nor scored. ``scorer`` may stand in
    for the model, such as a rule.
    """
    of_day = features.filter(F.col("leg_day") == F.lit(day).cast("date"))
    scored = scorer(of_day) if scorer else score(model, of_day)
    return (
        scored.select(
            *columns,
            "dep_minute_of_day",
            "prediction",
            text.delay_status("prediction").alias("status"),
            text.probability_text("delay_probability").alias("probability"),
        )
        .orderBy("dep_minute_of_day", *columns)
    )


def score_ids(model: PipelineModel | None, features: DataFrame, ids: DataFrame, key: str, scorer=None) -> DataFrame:
    """Scores for a table of ids; the semi join stands before the model (or the ``scorer`` in its place)."""
    wanted = by_ids(features, ids, key)
    scored = scorer(wanted) if scorer else score(model, wanted)
    return scored.select(key, F.col("prediction").alias("delay"), "delay_probability")


def evaluator_metrics(scored_raw: DataFrame) -> dict[str, float]:
    """Accuracy, weighted F1, precision and recall of the delayed class, both curve areas.

    Takes the model's own output with double ``prediction`` and vector ``probability``.
    """
    multi = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricLabel=1.0)
    # Without bins: every different score is a point of the curve.
    curve = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability", numBins=0)
    names = {
        "accuracy": "accuracy",
        "f1": "f1",
        "precision": "precisionByLabel",
        "recall": "recallByLabel",
    }
    result = {name: multi.setMetricName(metric).evaluate(scored_raw) for name, metric in names.items()}
    for name, metric in {"roc_auc": "areaUnderROC", "pr_auc": "areaUnderPR"}.items():
        result[name] = curve.setMetricName(metric).evaluate(scored_raw)
    return result


def metrics_table(scored: DataFrame, *groups: str) -> DataFrame:
    """Rows, accuracy, precision, recall and weighted F1 as plain aggregates, per group if given."""
    actual, predicted = F.col("label") == 1, F.col("prediction") == 1
    counts = scored.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )
    tp, fp, fn, tn, rows = (F.col(c) for c in ("tp", "fp", "fn", "tn", "rows"))

    def f1(hit, wrong, missed):
        return F.coalesce(F.try_divide(2 * hit, 2 * hit + wrong + missed), F.lit(0.0))

    weighted = (f1(tp, fp, fn) * (tp + fn) + f1(tn, fn, fp) * (tn + fp)) / rows
    return counts.select(
        *groups,
        "rows",
        ((tp + tn) / rows).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
        weighted.alias("f1"),
    )


def curve_table(scored: DataFrame) -> DataFrame:
    """Areas under the ROC and the precision-recall curve, from counts per different score in one pass.

    Scores with equal values are one step of the curves; areas are sums of trapezoids, the precision-recall curve
    starting at the precision of its first point. The running counts are over different scores, cut into
    ``CURVE_PARTS`` parts by score so that no task holds all of them. Rows without a score (NULL or NaN) rank below all
    others, as one step.
    """
    score = F.col("delay_probability")
    counts = scored.groupBy(F.when(~F.isnan(score), score).alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    part = F.greatest(F.least(F.floor(F.col("score") * CURVE_PARTS), F.lit(CURVE_PARTS - 1)), F.lit(0))
    parted = counts.withColumn("part", F.when(F.col("score").isNull(), -1).otherwise(part))
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    starts = parted.groupBy("part").agg(F.sum("pos").alias("part_pos"), F.sum("neg").alias("part_neg"))
    starts = starts.select(
        F.col("part").alias("_part"),
        F.coalesce(F.sum("part_pos").over(above), F.lit(0)).alias("_tp"),
        F.coalesce(F.sum("part_neg").over(above), F.lit(0)).alias("_fp"),
        F.sum("part_pos").over(Window.partitionBy()).alias("_all_pos"),
        F.sum("part_neg").over(Window.partitionBy()).alias("_all_neg"),
    )
    inside = Window.partitionBy("part").orderBy(F.desc("score"))
    placed = parted.join(starts, F.col("part").eqNullSafe(F.col("_part"))).select(
        "pos", "neg", "_all_pos", "_all_neg",
        (F.col("_tp") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("_fp") + F.sum("neg").over(inside)).alias("fp"),
    )
    before_tp, before_fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    roc = F.col("neg") * (F.col("tp") + before_tp) / 2
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    before_precision = F.coalesce(F.try_divide(before_tp, before_tp + before_fp), precision)
    pr = F.col("pos") * (precision + before_precision) / 2
    all_pos, all_neg = F.max("_all_pos"), F.max("_all_neg")
    return placed.agg(
        F.try_divide(F.sum(roc), all_pos * all_neg).alias("roc_auc"), F.try_divide(F.sum(pr), all_pos).alias("pr_auc")
    )


CURVE_PARTS = 1024


def confusion(scored: DataFrame) -> DataFrame:
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("rows")).orderBy("label", "prediction")


def error_by_segment(scored: DataFrame, *segments: str) -> DataFrame:
    """Error rate per segment, for example carrier, airport, hour."""
    wrong = F.col("label") != F.col("prediction")
    return (
        scored.groupBy(*segments)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(wrong).alias("errors"),
            (F.count_if(wrong) / F.count(F.lit(1))).alias("error_rate"),
            F.avg("delay_probability").alias("avg_delay_probability"),
        )
        .orderBy(*segments)
    )


def performance_over_time(scored: DataFrame, day: str = "leg_day", width: str = "7 days") -> DataFrame:
    """Model metrics per week of legs."""
    weekly = scored.withColumn("week", F.window(F.col(day).cast("timestamp_ntz"), width)["start"])
    return metrics_table(weekly, "week").orderBy("week")


def metrics_by_range(scored: DataFrame, months: int, day: str = "leg_day") -> DataFrame:
    """Metrics of every range of ``months`` months that holds a row, starting anew each month.

    A row takes part in as many ranges as they have months; tasks add up before the shuffle.
    """
    month = F.year(day) * 12 + F.month(day) - 1
    starts = scored.withColumn("_month", F.explode(F.sequence(month - (months - 1), month)))
    first = F.format_string("%d-%02d", F.floor(F.col("_month") / 12).cast("int"), F.pmod("_month", F.lit(12)) + 1)
    return metrics_table(starts.withColumn("range_start", first), "range_start").orderBy("range_start")


def feature_importance(spark: SparkSession, model: PipelineModel, sample: DataFrame) -> DataFrame:
    """``(feature, importance)`` of a tree model, names from the assembled vector's attributes.

    Only the schema of ``sample`` is used. There are as many rows as the vector has slots.
    """
    attributes = model.transform(sample.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    importances = model.stages[-1].featureImportances
    rows = [
        (slot["name"], float(importances[slot["idx"]])) for kind in attributes.values() for slot in kind
    ]
    table = spark.createDataFrame(rows, "feature STRING, importance DOUBLE")
    return table.orderBy(F.desc("importance"), "feature")


def grid_search(
    spec: FeatureSpec,
    training: DataFrame,
    grid: Mapping[str, Sequence[float]],
    folds: int = 3,
    parallelism: int = 4,
    seed: int = 42,
) -> CrossValidatorModel:
    """Cross-validated search over boosted-tree parameters by area under the ROC curve."""
    trees = boosted_trees(seed=seed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(trees.getParam(name), list(values))
    search = CrossValidator(
        estimator=pipeline(spec, trees),
        estimatorParamMaps=builder.build(),
        evaluator=BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability", numBins=0),
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
    )
    return search.fit(training)


# The wide and the reduced parameter grid.
WIDE_GRID = {"maxDepth": [3, 5, 7], "maxIter": [30, 50, 100], "stepSize": [0.05, 0.1, 0.2], "maxBins": [32, 64]}
REDUCED_GRID = {"maxDepth": [3, 5], "maxIter": [40, 80], "stepSize": [0.1]}


def grid_results(spark: SparkSession, search: CrossValidatorModel) -> DataFrame:
    """One row per grid point: parameters as text, mean area under the curve, best or not."""
    # The search keeps the first of several equally good points.
    best = list(search.avgMetrics).index(max(search.avgMetrics))
    rows = []
    for position, params in enumerate(search.getEstimatorParamMaps()):
        chosen = ", ".join(sorted(f"{param.name}={value}" for param, value in params.items()))
        rows.append((chosen, float(search.avgMetrics[position]), position == best))
    return literal_table(spark, rows, "parameters STRING, roc_auc DOUBLE, best BOOLEAN")


def compare_ranges(
    raw: DataFrame,
    spec: FeatureSpec,
    key: str,
    classifier: Estimator,
    stored: str,
    day: str = "leg_day",
    months: int = 6,
    step: int = 6,
    parallelism: int = 4,
) -> DataFrame:
    """Train and evaluate one model per range of months of unfilled features; one metrics row per range.

    The features are stored once, by range, under ``stored``; each fit then reads its own folders. The loop runs
    over ranges, of which a century has 1,200; each fit is a distributed job, and ``parallelism`` of them run at a time,
    since the rows of one range seldom keep all cores busy. The fill values come from the range's own training rows. ``months`` is the length of a range and ``step`` the distance of their starts, so
    ``6, 6`` gives half-years and ``6, 1`` rolling ranges. Every range has a row; one that can't be trained or
    tested (one label only, no rows) has NULL metrics.
    """
    spark = raw.sparkSession
    month = F.year(day) * 12 + F.month(day) - 1
    tagged = tag_split(raw, key).withColumn("month_number", month)
    write_partitioned(tagged, stored, ["month_number", "split"])
    features = spark.read.schema(tagged.schema).parquet(stored)
    counts = {}
    for row in features.groupBy("month_number", "split", "label").agg(F.count(F.lit(1)).alias("rows")).collect():
        counts[row["month_number"], row["split"], row["label"]] = row["rows"]
    present = sorted({number for number, _, _ in counts if number is not None})
    first = present[0] // step * step if present else 0

    def one_range(start: int) -> DataFrame:
        inside = F.col("month_number").between(start, start + months - 1)
        sizes = {
            (part, label): sum(n for (m, p, v), n in counts.items() if m is not None and start <= m < start + months and (p, v) == (part, label))
            for part in ("train", "test")
            for label in (0, 1)
        }
        name = f"{start // 12}-{start % 12 + 1:02d}"
        if not all(sizes["train", label] for label in (0, 1)) or not sizes["test", 0] + sizes["test", 1]:
            tested = sizes["test", 0] + sizes["test", 1]
            return spark.createDataFrame([(name, tested, None, None, None, None)], RANGE_METRICS)
        training, test = (features.filter(inside & (F.col("split") == part)).drop("month_number", "split") for part in ("train", "test"))
        fills = fit_fills(training, spec)
        fitted = fit(spec, fill_nulls(training, fills), classifier)
        metrics = metrics_table(score(fitted, fill_nulls(test, fills)))
        return metrics.select(F.lit(name).alias("range_start"), "*")

    starts = range(first, present[-1] + 1 if present else 0, step)
    with ThreadPoolExecutor(parallelism) as pool:
        # The wrapper holds the properties of one call's thread, so every range gets its own.
        running = [pool.submit(inheritable_thread_target(spark)(one_range), start) for start in starts]
        rows = [range_metrics.result() for range_metrics in running]
    return reduce(DataFrame.unionByName, rows, spark.createDataFrame([], RANGE_METRICS))


RANGE_METRICS = "range_start STRING, rows LONG, accuracy DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE"


def write_splits(features: DataFrame, key: str, path: str) -> None:
    """Store the split as a tag and a folder, so that experiments share it."""
    write_partitioned(tag_split(features, key), path, ["split"])
