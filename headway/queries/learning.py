"""Model dataset and split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.ml import delays
from headway.queries.realtime import features
from headway.queries.registry import Tables, query

_SHOWN = ["journey_ref", "stop_point_ref", "service_date", "label", *delays.NUMBERS]


@query(
    "ml_dataset",
    """
SELECT journey_ref, stop_point_ref, service_date, CAST(is_delayed AS DOUBLE) AS label, CAST(hour AS DOUBLE) AS hour,
       coalesce(CAST(day_of_week AS DOUBLE), 0) AS day_of_week, coalesce(CAST(is_weekend AS DOUBLE), 0) AS is_weekend,
       coalesce(CAST(is_holiday AS DOUBLE), 0) AS is_holiday, coalesce(CAST(is_school_holiday AS DOUBLE), 0) AS is_school_holiday,
       coalesce(hist_avg_arrival_delay_sec, 0) AS hist_avg_arrival_delay_sec, coalesce(hist_pct_on_time, 0) AS hist_pct_on_time
FROM v_features WHERE is_delayed IS NOT NULL AND service_date IS NOT NULL
""",
)
def ml_dataset(t: Tables) -> DataFrame:
    return delays.dataset(features(t)).select(*_SHOWN)


_LATE = "SELECT service_date, CAST(is_delayed AS INTEGER) AS label FROM v_features WHERE is_delayed IS NOT NULL AND service_date IS NOT NULL"


@query(
    "ml_split",
    f"""
WITH f AS ({_LATE}),
c AS (SELECT min(service_date) AS cut
      FROM (SELECT service_date, sum(count(*)) OVER (ORDER BY service_date) AS upto, sum(count(*)) OVER () AS total FROM f GROUP BY 1)
      WHERE upto >= 0.8::DOUBLE * total)
SELECT CASE WHEN service_date <= cut THEN 'train' ELSE 'test' END AS part, count(*) AS rows, round(avg(label), 4) AS late_share,
       min(service_date) AS first_day, max(service_date) AS last_day
FROM f, c GROUP BY 1
""",
)
def ml_split(t: Tables) -> DataFrame:
    """Rows and late share of both sides of the time split at the exact quantile of the date."""
    data = delays.dataset(features(t))
    train, test = delays.time_split(data, delays.exact_cutoff_date(data))
    both = train.select(F.lit("train").alias("part"), "label", "service_date").unionByName(
        test.select(F.lit("test").alias("part"), "label", "service_date")
    )
    return both.groupBy("part").agg(
        F.count("*").alias("rows"),
        F.round(F.avg("label"), 4).alias("late_share"),
        F.min("service_date").alias("first_day"),
        F.max("service_date").alias("last_day"),
    )


@query(
    "ml_metrics",
    """
WITH f AS (SELECT CAST(is_delayed AS INTEGER) AS label, 100 - coalesce(hist_pct_on_time, 0) AS score FROM v_features
           WHERE is_delayed IS NOT NULL AND service_date IS NOT NULL)
SELECT round((SELECT sum(p.n * q.n * CASE WHEN p.score > q.score THEN 1.0::DOUBLE WHEN p.score = q.score THEN 0.5::DOUBLE ELSE 0 END)
              FROM (SELECT score, count(*) AS n FROM f WHERE label = 1 GROUP BY 1) p, (SELECT score, count(*) AS n FROM f WHERE label = 0 GROUP BY 1) q)
             / count(*) FILTER (WHERE label = 1) / count(*) FILTER (WHERE label = 0), 6) AS auc,
       round(2.0::DOUBLE * count(*) FILTER (WHERE label = 1 AND score >= 50)
             / (count(*) FILTER (WHERE label = 1) + count(*) FILTER (WHERE score >= 50)), 6) AS f1
FROM f
""",
)
def ml_metrics(t: Tables) -> DataFrame:
    """Area under the curve and F1 of the stop's past late share as a prediction."""
    scored = delays.dataset(features(t)).withColumn("score", 100 - F.col("hist_pct_on_time"))
    return delays.score_metrics(scored, delays.LABEL, "score", 50)
