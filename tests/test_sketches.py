from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from headway.ml import delays
from headway.plans import sketches

FIRST = dt.date(2025, 3, 1)
SCHEMA = "day date, n long, x double, name string, empty int"


def day_rows(i):
    rng = random.Random(i)
    # One day holds a third of all rows; another has no known number.
    size = 9000 if i == 4 else 700
    day = FIRST + dt.timedelta(days=i)
    return [(day, None if i == 7 else rng.randint(0, 5000), rng.gauss(i, 3), None if rng.random() < 0.2 else f"name{rng.randint(0, 3000)}", None) for _ in range(size)]


@pytest.fixture(scope="module")
def days(spark, tmp_path_factory):
    """Ten days' sketches stored day by day, and the rows they are of."""
    folder = str(tmp_path_factory.mktemp("sketches") / "s")
    rows = [day_rows(i) for i in range(10)]
    for i, some in enumerate(rows):
        wrong = some[:10]  # a load that is repeated in full
        for load in (wrong, some) if i == 2 else (some,):
            sketches.keep(sketches.day_sketches(spark.createDataFrame(load, SCHEMA), "day"), folder)
    return folder, spark.createDataFrame([r for some in rows for r in some], SCHEMA)


def test_profile_of_days_equals_one_pass(spark, days):
    folder, table = days
    parts = {r.column: r for r in sketches.profile(sketches.stored(spark, folder)).collect()}
    whole = {r.column: r for r in sketches.profile(sketches.day_sketches(table.withColumn("day", F.lit(FIRST)), "day")).collect()}
    exact = table.agg(*[F.count_distinct(c).alias(c) for c in ("n", "x", "name", "empty")]).first()
    for c in ("n", "x", "name", "empty"):
        assert parts[c].rows == whole[c].rows == 15_300
        assert (parts[c].null_pct, parts[c].min, parts[c].max) == (whole[c].null_pct, whole[c].min, whole[c].max)
        assert parts[c]["mean"] == pytest.approx(whole[c]["mean"])
        for found in (parts[c], whole[c]):
            assert abs(found.n_distinct - exact[c]) <= 3 * sketches.DISTINCT_DEVIATION * exact[c]
    assert (parts["empty"].null_pct, parts["empty"].n_distinct, parts["empty"].min, parts["empty"]["mean"]) == (100.0, 0, None, None)
    assert parts["name"].min == table.agg(F.min("name")).first()[0]


def test_quantiles_keep_to_their_error(spark, days):
    folder, table = days
    last = FIRST + dt.timedelta(days=8)
    found = [tuple(r) for r in sketches.quantiles(sketches.stored(spark, folder, FIRST + dt.timedelta(days=1), last), [0.0, 0.1, 0.5, 0.8, 1.0]).collect()]
    assert {c for c, _, _ in found} == {"n", "x"}
    misses = sketches.rank_misses(table.where(F.col("day").between(FIRST + dt.timedelta(days=1), last)), found).collect()
    assert len(misses) == 10 and all(r.miss <= sketches.RANK_ERROR for r in misses)


def test_only_asked_days_are_read(spark, days):
    asked = sketches.stored(spark, days[0], FIRST, FIRST)
    assert asked.select("rows").distinct().collect() == [(700,)]
    assert len(asked.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(day" in asked._jdf.queryExecution().toString()


def test_cutoff_day_from_sketches(spark, days):
    _, table = days
    dated = table.select("day", F.unix_date("day").alias("d"))
    cut = spark.range(1).select(sketches.cutoff_day(sketches.day_sketches(dated, "day", ["d"]), "d", 0.8)).first()[0]
    upto = {p: dated.where(F.col("day") <= F.lit(cut + dt.timedelta(days=p))).count() / dated.count() for p in (-1, 0)}
    assert upto[-1] - sketches.RANK_ERROR <= 0.8 <= upto[0] + sketches.RANK_ERROR


@pytest.mark.parametrize("ranges", [1, 2, 64])
def test_area_under_the_curve_by_ranges(spark, ranges):
    rng = random.Random(ranges)
    rows = [(float(rng.random() < 0.3), rng.choice([0.0, 0.5, 1.0, rng.random(), rng.random() ** 3])) for _ in range(2000)]
    late, punctual = [s for y, s in rows if y], [s for y, s in rows if not y]
    area = sum((a > b) + 0.5 * (a == b) for a in late for b in punctual) / len(late) / len(punctual)
    scored = spark.createDataFrame(rows, "label double, score double")
    assert delays.score_metrics(scored, "label", "score", 0.5, ranges).first()["auc"] == pytest.approx(area, abs=1e-6)


def test_area_of_no_scores(spark):
    assert tuple(delays.score_metrics(spark.createDataFrame([], "label double, score double"), "label", "score", 0.5).first()) == (None, None)
