"""Model work: split, metrics, promotion by rule; fitted models without SQL twin."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ...constants import CLASSIFIER_CATEGORICAL, CLASSIFIER_NUMERIC, REGRESSOR_FEATURES
from ...learning import (
    classification_metrics,
    classifier_estimators,
    detached,
    evaluate_predicted_labels,
    minutes_scores,
    preprocessing_stages,
    promote,
    regression_metrics,
    score,
    typed_features,
    with_split,
)
from ...learning.scorers import Scorer
from ...learning.training import train_classifiers, train_regressors
from ...functions import clip_and_round
from ...operators import add_flight_features, delayed_with_target, enrich_with_weather, reconcile, select_features, semi_join
from ...session import written
from .base import flights, over_flights, register
from .event_flights import event_predictions, event_weather


def _features(spark, sf_dir):
    rows = flights(spark, sf_dir)
    return add_flight_features(enrich_with_weather(rows, written(event_weather(rows), "weather")))


@register(over_flights("""
SELECT is_delayed, b <= cut AS is_test, count(*) AS n
FROM buckets JOIN (
  SELECT is_delayed AS grp, max(b) FILTER (before < wanted) AS cut FROM (
    SELECT is_delayed, b, sum(n) OVER (PARTITION BY is_delayed ORDER BY b) - n AS before,
           ceil(sum(n) OVER (PARTITION BY is_delayed) * 0.2::DOUBLE) AS wanted
    FROM (SELECT is_delayed, b, count(*) AS n FROM buckets GROUP BY ALL)
  ) GROUP BY is_delayed
) c ON is_delayed = grp
GROUP BY ALL
""", """buckets AS (
  SELECT is_delayed, CAST('0x' || substr(md5('42|' || flight_id), 1, 4) AS INTEGER) AS b FROM flagged
)"""))
def split_balance(spark, sf_dir):
    """Test share per class."""
    marked = with_split(add_flight_features(flights(spark, sf_dir)), ["flight_id"], "is_delayed")
    return marked.groupBy("is_delayed", "is_test").agg(F.count(F.lit(1)).alias("n"))


_CLASS_METRICS = """
  SELECT {by} (tp + tn) / (tp + fp + fn + tn) AS accuracy,
         CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
         CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1
  FROM (SELECT {by} count(*) FILTER (a AND g) AS tp, count(*) FILTER (NOT a AND g) AS fp,
               count(*) FILTER (a AND NOT g) AS fn, count(*) FILTER (NOT a AND NOT g) AS tn
        FROM ({source}) GROUP BY ALL)
"""


@register(over_flights(_CLASS_METRICS.format(
    by="origin_airport,", source="SELECT origin_airport, is_delayed AS a, k % 2 = 0 AS g FROM flagged"
)))
def classifier_metrics(spark, sf_dir):
    """Metrics of a rule-based prediction per origin."""
    rows = add_flight_features(flights(spark, sf_dir)).withColumn("guess", F.col("k") % 2 == 0)
    return classification_metrics(rows, "is_delayed", "guess", by=["origin_airport"])


@register(over_flights("""
SELECT origin_airport, round(avg(abs(delay_minutes - value)), 6) AS mae,
       round(sqrt(avg((delay_minutes - value) ** 2)), 6) AS rmse,
       round(1 - avg((delay_minutes - value) ** 2) / var_pop(delay_minutes), 6) AS r2
FROM flagged WHERE is_delayed AND delay_minutes IS NOT NULL GROUP BY origin_airport
"""))
def regressor_metrics(spark, sf_dir):
    """Metrics of a rule-based number per origin."""
    rows = delayed_with_target(add_flight_features(flights(spark, sf_dir)))
    metrics = regression_metrics(rows, "delay_minutes", "value", by=["origin_airport"])
    return metrics.select("origin_airport", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


@register(over_flights(_CLASS_METRICS.format(by="", source="""
SELECT f.is_delayed AS a, p.is_delayed AS g FROM flagged f JOIN predictions p
  ON f.flight_number = p.flight_number AND f.date = p.flight_date AND f.origin_airport = p.origin_airport
""")))
def live_evaluation(spark, sf_dir):
    """Outcomes against reconciled predictions."""
    rows = flights(spark, sf_dir)
    return evaluate_predicted_labels(reconcile(add_flight_features(rows), event_predictions(rows)))


_REGISTRY_SQL = """registry AS (
  SELECT origin_airport AS name, CAST(isodow(date) AS BIGINT) AS version,
         CASE isodow(date) WHEN 1 THEN 'Production' WHEN 2 THEN 'Staging' WHEN 3 THEN 'Archived' ELSE 'None' END
           AS stage,
         count(*) FILTER (is_delayed) / count(*) AS metric
  FROM flagged GROUP BY ALL
),
standing AS (
  SELECT name, coalesce(max(metric) FILTER (stage = 'Production'), 0) AS champion,
         max(metric) FILTER (version = 7) AS challenger
  FROM registry GROUP BY name
)"""


def _registry(spark, sf_dir):
    """Seven versions per origin; the newest is the candidate."""
    versions = (
        add_flight_features(flights(spark, sf_dir))
        .groupBy(F.col("origin_airport").alias("name"), F.col("day_of_week").alias("version"))
        .agg((F.count_if("is_delayed") / F.count(F.lit(1))).alias("metric"))
    )
    v = F.col("version")
    stage = F.when(v == 1, "Production").when(v == 2, "Staging").when(v == 3, "Archived").otherwise("None")
    return versions.select("name", "version", stage.alias("stage"), "metric")


@register(over_flights("""
SELECT r.name, version, metric,
  CASE WHEN version = 7 AND challenger < 0.75 THEN 'Archived'
       WHEN version = 7 AND challenger > champion THEN 'Production'
       WHEN version = 7 THEN 'Staging'
       WHEN challenger >= 0.75 AND challenger > champion AND stage = 'Production' THEN 'Archived'
       WHEN challenger >= 0.75 AND stage IN ('None', 'Staging') THEN 'Archived'
       ELSE stage END AS stage
FROM registry r JOIN standing s ON r.name = s.name
""", _REGISTRY_SQL))
def promotion(spark, sf_dir):
    """Champion and challenger per model, larger is better."""
    return promote(_registry(spark, sf_dir), F.col("version") == 7, 0.75, "max")


@register(over_flights("""
SELECT r.name, version, metric,
  CASE WHEN version = 7 AND challenger < champion THEN 'Production'
       WHEN version = 7 THEN 'Staging'
       WHEN challenger <= 0.8 AND challenger < champion AND stage = 'Production' THEN 'Archived'
       ELSE stage END AS stage
FROM registry r JOIN standing s ON r.name = s.name
WHERE version <> 7 OR challenger <= 0.8
""", _REGISTRY_SQL))
def promotion_smaller_wins(spark, sf_dir):
    """The same with an error measure: a candidate over the limit is not registered."""
    return promote(_registry(spark, sf_dir), F.col("version") == 7, 0.8, "min", archive_superseded=False)


@register()
def score_flights(spark, sf_dir):
    """A fitted classifier over every flight."""
    rows = _features(spark, sf_dir)
    labelled = written(rows.withColumn("label", F.col("is_delayed").cast("double")), "labelled")
    stages = preprocessing_stages(CLASSIFIER_CATEGORICAL, CLASSIFIER_NUMERIC)
    model = detached(spark, Pipeline(stages=[*stages, classifier_estimators()["LogisticRegression"]]).fit(labelled))
    return score(rows.drop("is_delayed"), model).select("flight_id", "is_delayed")


@register()
def score_minutes(spark, sf_dir):
    """A fitted regressor over the flights predicted late on one day."""
    rows = _features(spark, sf_dir)
    delayed = select_features(delayed_with_target(rows), [*REGRESSOR_FEATURES, "delay_minutes"], lenient=True)
    delayed = written(delayed, "delayed")
    available = [c for c in delayed.columns if c != "delay_minutes"]
    stages = preprocessing_stages(*typed_features(delayed, available))
    estimator = LinearRegression(labelCol="delay_minutes")
    model = detached(spark, Pipeline(stages=[*stages, estimator]).fit(delayed))
    return minutes_scores(rows, event_predictions(rows), model, dt.date(2024, 1, 15)).select(
        "flight_id", "predicted_delay_minutes"
    )


def _stored(name: str) -> Scorer:
    """A scorer as a training run leaves it: features, weights and trees."""
    return Scorer.from_json((Path(__file__).parent / "scorers" / f"{name}.json").read_text())


_OBSERVED = """observed AS (
  SELECT f.*, w.* EXCLUDE (date, airport_iata) FROM flagged f
  LEFT JOIN weather w ON f.date = w.date AND f.origin_airport = w.airport_iata
)"""


@register(over_flights(f"SELECT flight_id, {_stored('late').prediction_sql()} AS is_delayed FROM observed", _OBSERVED))
def score_flights_stored(spark, sf_dir):
    """A stored logistic model over every flight, as one expression."""
    rows = _features(spark, sf_dir)
    return rows.select("flight_id", _stored("late").column().alias("is_delayed"))


@register(over_flights(f"""
SELECT flight_id, round_even(greatest({_stored('minutes').prediction_sql()}, 0), 1) AS predicted_delay_minutes
FROM observed WHERE (flight_number, origin_airport) IN (
  SELECT flight_number, origin_airport FROM predictions WHERE is_delayed AND flight_date = DATE '2024-01-15'
)""", _OBSERVED))
def score_minutes_stored(spark, sf_dir):
    """Stored boosted trees over the flights predicted late on one day."""
    rows = _features(spark, sf_dir)
    day = F.lit(dt.date(2024, 1, 15))
    late = event_predictions(rows).filter(F.col("is_delayed") & (F.col("flight_date") == day))
    wanted = semi_join(rows, late, {"flight_number": "flight_number", "origin_airport": "origin_airport"})
    return wanted.select("flight_id", clip_and_round(_stored("minutes").column()).alias("predicted_delay_minutes"))


@register(over_flights("""
SELECT flight_id, CAST(place AS DOUBLE) AS origin_index, round((k - mean_k) / dev_k, 6) AS k_scaled,
       round((coalesce(dep_hour, mean_hour) - mean_hour) / dev_hour, 6) AS hour_scaled
FROM flagged JOIN (
  SELECT origin_airport AS code, row_number() OVER (ORDER BY count(*) DESC, origin_airport) - 1 AS place
  FROM flagged GROUP BY origin_airport
) ON origin_airport = code
CROSS JOIN (
  SELECT avg(k) AS mean_k, stddev_samp(k) AS dev_k, avg(dep_hour) AS mean_hour, stddev_samp(dep_hour) AS dev_hour FROM flagged
)
"""))
def standardised_features(spark, sf_dir):
    """Category positions and standardised numbers as the models see them."""
    rows = add_flight_features(flights(spark, sf_dir))
    stages = preprocessing_stages(["origin_airport"], ["k", "dep_hour"])
    seen = Pipeline(stages=stages).fit(rows).transform(rows)
    scaled = vector_to_array("scaled_numbers")
    return seen.select(
        "flight_id",
        F.col("origin_airport_index").alias("origin_index"),
        F.round(scaled[0], 6).alias("k_scaled"),
        F.round(scaled[1], 6).alias("hour_scaled"),
    )


@register(over_flights("""
SELECT flight_id, round_even(greatest(base + slope * dep_hour, 0), 1) AS predicted_delay_minutes
FROM flagged CROSS JOIN (
  SELECT regr_slope(delay_minutes, dep_hour) AS slope, regr_intercept(delay_minutes, dep_hour) AS base
  FROM flagged WHERE is_delayed AND delay_minutes IS NOT NULL
)
WHERE (flight_number, origin_airport) IN (
  SELECT flight_number, origin_airport FROM predictions WHERE is_delayed AND flight_date = DATE '2024-01-15'
)
"""))
def score_minutes_by_hour(spark, sf_dir):
    """Minutes from a line through departure hours, fitted on late flights, for flights predicted late on one day."""
    rows = add_flight_features(flights(spark, sf_dir))
    stages = [*preprocessing_stages([], ["dep_hour"]), LinearRegression(labelCol="delay_minutes")]
    model = detached(spark, Pipeline(stages=stages).fit(delayed_with_target(rows)))
    return minutes_scores(rows, event_predictions(rows), model, dt.date(2024, 1, 15)).select(
        "flight_id", "predicted_delay_minutes"
    )


@register()
def trained_classifiers(spark, sf_dir):
    """Metrics of trained classifiers on the test rows."""
    fitted = train_classifiers(_features(spark, sf_dir), ["flight_id"], CLASSIFIER_CATEGORICAL, CLASSIFIER_NUMERIC)
    return _metric_rows(spark, fitted)


@register()
def trained_regressors(spark, sf_dir):
    """Metrics of trained regressors on the test rows."""
    fitted = train_regressors(_features(spark, sf_dir), ["flight_id"], REGRESSOR_FEATURES)
    return _metric_rows(spark, fitted)


def _metric_rows(spark, fitted):
    rows = [(f.name, metric, float(value)) for f in fitted for metric, value in f.metrics.items()]
    return spark.createDataFrame(rows, "model string, metric string, value double")
