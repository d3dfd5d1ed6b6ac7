"""Delay classifiers: dataset, time split, features, four models, champion, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.operators.ranking import arg_max

# Columns and settings of the delay models.
LABEL = "label"
CATEGORIES = ["line_ref", "published_line", "direction", "cat_jour"]
NUMBERS = [
    "hour",
    "day_of_week",
    "is_weekend",
    "is_holiday",
    "is_school_holiday",
    "hist_avg_arrival_delay_sec",
    "hist_pct_on_time",
]
TRAIN_FRACTION = 0.8
QUANTILE_ERROR = 0.01
SETTINGS = {
    "logreg": {"maxIter": 50},
    "dtree": {"maxDepth": 8},
    "rforest": {"numTrees": 200, "maxDepth": 10},
    "gbt": {"maxIter": 100, "maxDepth": 5},
}
CLASSIFIERS = {
    "logreg": LogisticRegression,
    "dtree": DecisionTreeClassifier,
    "rforest": RandomForestClassifier,
    "gbt": GBTClassifier,
}


def dataset(features: DataFrame) -> DataFrame:
    """Label and numbers as doubles, unknown numbers 0; rows without label or date dropped."""
    typed = features.withColumns(
        {LABEL: F.col("is_delayed").cast("double"), **{c: F.col(c).cast("double") for c in NUMBERS}}
    )
    return typed.where(F.col(LABEL).isNotNull() & F.col("service_date").isNotNull()).na.fill(0.0, NUMBERS)


def exact_cutoff_date(df: DataFrame, fraction: float = TRAIN_FRACTION):
    """The first date up to which at least the fraction of rows lies, from one count a date."""
    per_day = df.groupBy("service_date").agg(F.count("*").alias("n"))
    upto = per_day.withColumn("upto", F.sum("n").over(Window.orderBy("service_date")))
    enough = F.col("upto") >= F.lit(fraction) * per_day.agg(F.sum("n")).scalar()
    return upto.where(enough).agg(F.min("service_date")).first()[0]


def _below_each(counts: DataFrame, key: str, n: str, ranges: int) -> DataFrame:
    """Adds _below: the sum of ``n`` over the rows of lesser key, of which each occurs once.

    Keys are cut into ranges at quantiles; a range is summed on its own, from the sum of the
    ranges before it, so that no task gets them all.
    """
    cuts = counts.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 100 * ranges)).scalar()
    placed = counts.withColumn("_cuts", cuts).withColumn("_range", F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < F.col(key))), F.lit(0))).drop("_cuts")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = placed.groupBy("_range").agg(F.sum(n).alias("_n")).select("_range", F.sum("_n").over(before).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_inside", F.sum(n).over(inside)).join(starts, "_range")
    return summed.withColumn("_below", F.coalesce("_start", F.lit(0)) + F.coalesce("_inside", F.lit(0)))


def score_metrics(scored: DataFrame, label: str, score: str, threshold: float, ranges: int = 64) -> DataFrame:
    """(auc, f1) of scores against 0/1 labels, in one row.

    The area under the curve is the share of (late, punctual) pairs in which the late row
    scores higher, ties half; it comes from counts per distinct score, summed up by ranges of scores.
    """
    rows = scored.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    late, guessed = F.col(label) == 1, F.col(score) >= threshold
    per_score = rows.groupBy(score).agg(F.count_if(late).alias("late"), F.count_if(~late).alias("punctual"))
    ranged = _below_each(per_score, score, "punctual", ranges)
    won = ranged.withColumn("won", F.col("late") * (2 * F.col("_below") + F.col("punctual")))
    area = won.agg(F.try_divide(F.sum("won").cast("double"), 2.0 * F.sum("late") * F.sum("punctual")).alias("auc"))
    both = rows.agg(F.count_if(late & guessed).alias("hit"), F.count_if(late | guessed).alias("any"))
    f1 = F.try_divide(2.0 * F.col("hit"), F.col("hit") + F.col("any"))
    return both.select(F.round(area.scalar(), 6).alias("auc"), F.round(f1, 6).alias("f1"))


def cutoff_date(df: DataFrame, fraction: float = TRAIN_FRACTION, error: float = QUANTILE_ERROR):
    """Last training date: the approximate quantile of the service date."""
    days = df.select(F.unix_date("service_date").alias("d"))
    day = days.approxQuantile("d", [fraction], error)[0]
    return df.sparkSession.range(1).select(F.date_from_unix_date(F.lit(int(day)))).first()[0]


def time_split(df: DataFrame, cutoff) -> tuple[DataFrame, DataFrame]:
    """(train, test): up to and including the cutoff date, and after it."""
    return df.where(F.col("service_date") <= F.lit(cutoff)), df.where(F.col("service_date") > F.lit(cutoff))


def positional_split(df: DataFrame, fraction: float = TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    """(train, test): the first share of rows by date, the rest after it.

    Rows get a position from counts per date and a row number inside the date, so no task
    sorts the whole table. Dates that are wholly before or after the cut are not numbered.
    """
    per_day = df.groupBy("service_date").agg(F.count("*").alias("n"))
    running = Window.orderBy("service_date").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_day.withColumn("_before", F.coalesce(F.sum("n").over(running), F.lit(0)))
    rows_to_train = F.floor(F.lit(fraction) * per_day.agg(F.sum("n")).scalar())
    placed = df.join(starts, "service_date").withColumn("_cut", rows_to_train)
    whole = placed.where(F.col("_before") + F.col("n") <= F.col("_cut"))
    after = placed.where(F.col("_before") >= F.col("_cut"))
    cut_day = placed.where((F.col("_before") < F.col("_cut")) & (F.col("_before") + F.col("n") > F.col("_cut")))
    # Inside the one cut day, rows are split by a hash order's quantile position.
    ordered = cut_day.withColumn("_h", F.xxhash64(*df.columns))
    slot = ordered.withColumn("_slot", F.shiftright("_h", 48))
    slots = slot.groupBy("_slot").agg(F.count("*").alias("_m"))
    slot_run = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slot_starts = slots.withColumn("_slot_before", F.coalesce(F.sum("_m").over(slot_run), F.lit(0)))
    numbered = slot.join(slot_starts, "_slot").withColumn(
        "_pos",
        F.col("_before") + F.col("_slot_before") + F.row_number().over(Window.partitionBy("_slot").orderBy("_h")),
    )
    first, second = numbered.where(F.col("_pos") <= F.col("_cut")), numbered.where(F.col("_pos") > F.col("_cut"))
    columns = df.columns
    return (
        whole.select(*columns).unionByName(first.select(*columns)),
        after.select(*columns).unionByName(second.select(*columns)),
    )


def feature_stages(standardise: bool = False) -> list:
    """Index and one-hot encode categories (unseen kept), assemble with the numbers."""
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep") for c in CATEGORIES]
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in CATEGORIES], outputCols=[f"{c}_hot" for c in CATEGORIES], handleInvalid="keep"
    )
    hot = [f"{c}_hot" for c in CATEGORIES]
    if not standardise:
        return [*indexers, encoder, VectorAssembler(inputCols=hot + NUMBERS, outputCol="features")]
    numbers = VectorAssembler(inputCols=NUMBERS, outputCol="numbers")
    scaler = StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True)
    return [*indexers, encoder, numbers, scaler, VectorAssembler(inputCols=[*hot, "scaled"], outputCol="features")]


def classifier(name: str, **settings):
    return CLASSIFIERS[name](labelCol=LABEL, featuresCol="features", **{**SETTINGS[name], **settings})


def evaluate(predictions: DataFrame) -> tuple[float, float]:
    """(area under ROC, F1)."""
    auc = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC").evaluate(predictions)
    f1 = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="f1").evaluate(predictions)
    return auc, f1


def train_all(
    train: DataFrame,
    test: DataFrame,
    folder: str,
    run_at: datetime,
    names: Sequence[str] = tuple(SETTINGS),
    standardise: bool = False,
    settings: dict[str, dict] | None = None,
) -> DataFrame:
    """Fits the models, saves each under the folder, and returns the runs with their metrics.

    The features are fitted and computed once and shared by all models. Runs: (run_at,
    algorithm, roc_auc, f1, path, is_champion); the champion has the greatest AUC.
    """
    spark = train.sparkSession
    features = Pipeline(stages=feature_stages(standardise)).fit(train)
    wide = [LABEL, "features"]
    train_x, test_x = features.transform(train).select(*wide).persist(), features.transform(test).select(*wide).persist()
    rows = []
    for name in names:
        model = classifier(name, **(settings or {}).get(name, {})).fit(train_x)
        auc, f1 = evaluate(model.transform(test_x))
        path = f"{folder}/{name}"
        PipelineModel(stages=[features, model]).write().overwrite().save(path)
        rows.append((run_at, name, float(auc), float(f1), path))
    train_x.unpersist()
    test_x.unpersist()
    runs = spark.createDataFrame(rows, "run_at timestamp, algorithm string, roc_auc double, f1 double, path string")
    best = arg_max(runs, "algorithm", "roc_auc").select("algorithm", F.lit(True).alias("_best"))
    return runs.join(best, "algorithm", "left").withColumn("is_champion", F.coalesce("_best", F.lit(False))).drop("_best")


def champion(spark: SparkSession, runs: DataFrame) -> Transformer:
    """The saved model of the champion run."""
    return PipelineModel.load(runs.where("is_champion").select("path").first()[0])


def score(model: Transformer, features: DataFrame) -> DataFrame:
    """Delay predictions for passages; rows need no label."""
    ready = features.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in NUMBERS})
    return model.transform(ready).select(
        "journey_ref", "stop_point_ref", "service_date", F.col("prediction").cast("boolean").alias("predicted_delayed")
    )
