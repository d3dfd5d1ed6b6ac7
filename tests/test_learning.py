from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from headway.ml import delays


@pytest.fixture(scope="module")
def features(spark):
    n = F.col("id")
    return spark.range(400).select(
        F.concat(F.lit("J"), n).alias("journey_ref"),
        F.lit("7").alias("stop_point_ref"),
        F.concat(F.lit("C"), n % 3).alias("line_ref"),
        F.concat(F.lit("L"), n % 3).alias("published_line"),
        F.when(n % 2 == 0, "out").alias("direction"),
        F.lit("JOHV").alias("cat_jour"),
        F.date_add(F.lit(dt.date(2025, 1, 1)), (n / 40).cast("int")).alias("service_date"),
        (n % 24).cast("int").alias("hour"),
        (n % 7 + 1).cast("int").alias("day_of_week"),
        (n % 7 >= 5).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("boolean").alias("is_school_holiday"),
        (n % 24 * 10.0).alias("hist_avg_arrival_delay_sec"),
        F.when(n % 5 > 0, 80.0).alias("hist_pct_on_time"),
        F.when(n != 3, n % 24 >= 12).alias("is_delayed"),
    )


def test_dataset(features):
    data = delays.dataset(features)
    assert data.count() == 399
    assert data.where("is_school_holiday is null or hist_pct_on_time is null").isEmpty()


def test_time_split(features):
    data = delays.dataset(features)
    cutoff = delays.cutoff_date(data)
    assert dt.date(2025, 1, 7) <= cutoff <= dt.date(2025, 1, 9)
    train, test = delays.time_split(data, cutoff)
    assert train.count() + test.count() == 399 and not test.isEmpty()
    assert train.agg(F.max("service_date")).first()[0] < test.agg(F.min("service_date")).first()[0]


@pytest.mark.parametrize("fraction", [0.8, 0.83, 0.1])
def test_positional_split(features, fraction):
    data = delays.dataset(features)
    train, test = delays.positional_split(data, fraction)
    assert train.count() == int(399 * fraction) and train.count() + test.count() == 399
    assert train.agg(F.max("service_date")).first()[0] <= test.agg(F.min("service_date")).first()[0]


def test_models_and_champion(spark, features, tmp_path):
    data = delays.dataset(features)
    train, test = delays.time_split(data, dt.date(2025, 1, 8))
    small = {"rforest": {"numTrees": 5, "maxDepth": 4}, "gbt": {"maxIter": 3, "maxDepth": 3}}
    runs = delays.train_all(train, test, str(tmp_path), dt.datetime(2025, 1, 11), settings=small).persist()
    got = {r.algorithm: r for r in runs.collect()}
    assert set(got) == {"logreg", "dtree", "rforest", "gbt"}
    assert sum(r.is_champion for r in got.values()) == 1
    best = max(r.roc_auc for r in got.values())
    assert next(r for r in got.values() if r.is_champion).roc_auc == best > 0.9
    scored = delays.score(delays.champion(spark, runs), features.drop("is_delayed"))
    assert scored.count() == 400 and scored.where("predicted_delayed").count() > 100


def test_standardised_variant(spark, features, tmp_path):
    train, test = delays.positional_split(delays.dataset(features))
    runs = delays.train_all(train, test, str(tmp_path), dt.datetime(2025, 1, 11), ["logreg"], standardise=True)
    assert runs.first().roc_auc > 0.9
