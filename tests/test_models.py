"""Features, fits, scores and the per-borough models on planted signals."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from helpers_core import rows
from curbside.models import duration, features
from curbside.operators.stats import compare_hourly, mean_absolute_error


def planted(spark, size, start=0, boroughs=("Queens", "Bronx")):
    """Trips whose duration is 3 minutes per mile plus an effect of the hour."""
    i = F.col("id")
    names = F.array(*[F.lit(b) for b in boroughs])
    return spark.range(start, start + size).select(
        "id",
        F.concat(F.lit("2024-01-"), F.lpad((i % 5 + 10).cast("string"), 2, "0")).alias("day"),
        (i % 6).cast("int").alias("hour"),
        (i % 11).cast("int").alias("pulocationid"),
        (i % 13).cast("int").alias("dolocationid"),
        (i % 97 / 4 + 1).alias("trip_distance"),
        (i % 7 > 4).alias("is_weekend"),
        (i % 5 % 2).cast("int").alias("holiday_scale"),
        (i % 17 - 5).cast("double").alias("temp"),
        (i % 19).cast("double").alias("windgust"),
        F.element_at(names, (i % len(boroughs) + 1).cast("int")).alias("Borough"),
    ).withColumn("trip_duration", 3 * F.col("trip_distance") + 2 * F.col("hour") + 5).withColumn(
        "speed", F.col("trip_distance") / (F.col("trip_duration") / 60)
    )


def test_index_order_is_frequency_then_text(spark):
    table = spark.createDataFrame([(2,), (2,), (10,), (10,), (3,)], "hour int")
    fitted = features.string_indexer(["hour"]).fit(table)
    assert list(fitted.labelsArray[0]) == ["10", "2", "3"]


def test_unseen_category_is_a_zero_vector(spark):
    train = spark.createDataFrame([(1,), (1,), (2,)], "hour int")
    test = spark.createDataFrame([(2,), (9,)], "hour int")
    indexer = features.string_indexer(["hour"]).fit(train)
    encoder = features.one_hot_encoder(["hour"]).fit(indexer.transform(train))
    encoded = encoder.transform(indexer.transform(test))
    found = {r["hour"]: r["v"] for r in encoded.select("hour", vector_to_array("hour_encoded").alias("v")).collect()}
    assert found == {2: [0.0, 1.0], 9: [0.0, 0.0]}


def test_scaling_does_not_centre_unless_asked(spark):
    train = planted(spark, 300)
    deviation = train.select(F.stddev_samp("trip_distance")).first()[0]
    prepared, _, _ = features.prepare_features(train, train)
    at = vector_to_array(features.SCALED)
    row = prepared.select("trip_distance", F.element_at(at, -5).alias("s")).first()
    assert row["s"] == pytest.approx(row["trip_distance"] / deviation)
    centred, _, _ = features.prepare_features(train, train, with_mean=True)
    assert centred.select(F.avg(F.element_at(at, -5))).first()[0] == pytest.approx(0, abs=1e-9)


def test_models_beat_the_mean_and_repeat(spark):
    train, test = planted(spark, 1500), planted(spark, 400, 1500)
    fit_rows, score_rows, _ = features.prepare_features(train, test)
    average = train.select(F.avg("trip_duration")).first()[0]
    naive = test.select(F.avg(F.abs(F.col("trip_duration") - average))).first()[0]
    for name, model in duration.default_models().items():
        scored = duration.predict(fit_rows, score_rows, model)
        error = mean_absolute_error(scored).first()["mae"]
        assert error < naive / 2, name
        again = mean_absolute_error(duration.predict(fit_rows, score_rows, model)).first()["mae"]
        assert error == pytest.approx(again, abs=1e-9)
        evaluator = RegressionEvaluator(labelCol="trip_duration", metricName="mae")
        assert error == pytest.approx(evaluator.evaluate(scored), abs=1e-9)
        row = scored.first()
        assert row["predicted_speed"] == pytest.approx(row["trip_distance"] / (row["prediction"] / 60))


def test_univariate_line_equals_linear_regression(spark):
    train = planted(spark, 500)
    line = duration.univariate_line(train).first()
    assembled = VectorAssembler(inputCols=["trip_distance"], outputCol="x").transform(train)
    model = LinearRegression(featuresCol="x", labelCol="trip_duration").fit(assembled)
    assert line["slope"] == pytest.approx(model.coefficients[0])
    assert line["intercept"] == pytest.approx(model.intercept)
    assert line["n"] == 500


def test_boroughs_without_rows_are_reported(spark):
    train = planted(spark, 600)
    test = planted(spark, 200, 600, boroughs=("Queens", "EWR")).where("Borough != 'EWR' or id % 4 = 3")
    models = {"linear": duration.linear_regression()}
    scores = duration.borough_scores(train, test, ["Queens", "Bronx", "EWR", "Nowhere"], models)
    found = {r["Borough"]: r for r in scores.collect()}
    assert found["Queens"]["status"] == "scored" and found["Queens"]["mae"] < 1e-6
    assert (found["Bronx"]["status"], found["Bronx"]["mae"]) == ("no test rows", None)
    assert (found["EWR"]["status"], found["EWR"]["mae"]) == ("no training rows", None)
    assert found["EWR"]["test_rows"] > 0
    assert found["Nowhere"]["train_rows"] == 0


def test_no_borough_with_training_rows(spark):
    empty = planted(spark, 10).where("false")
    predictions = duration.borough_predictions(empty, empty, ["Queens"])
    assert predictions.columns == ["Borough", "model", *duration.PREDICTION_COLUMNS]
    assert predictions.count() == 0
    scores = duration.borough_scores(empty, empty, ["Queens"])
    assert rows(scores, "Borough", "model", "status", "mae") == [
        ("Queens", "forest", "no training rows", None),
        ("Queens", "linear", "no training rows", None),
    ]


def test_every_borough_has_its_own_model(spark):
    # Durations are 3 minutes per mile in one borough and 6 in the other.
    table = planted(spark, 800).withColumn(
        "trip_duration", F.when(F.col("Borough") == "Queens", 3.0).otherwise(6.0) * F.col("trip_distance")
    )
    models = {"linear": duration.linear_regression()}
    predictions = duration.borough_predictions(table, table, ["Queens", "Bronx"], models)
    errors = mean_absolute_error(predictions, "Borough", "model")
    assert all(r["mae"] < 1e-6 and r["predictions"] == 400 for r in errors.collect())
    assert errors.count() == 2


def test_hourly_comparison_keeps_hours_of_either_side(spark):
    def scored(listed):
        return spark.createDataFrame(listed, "day string, hour int, speed double, predicted_speed double")

    linear = scored([("a", 1, 10.0, 12.0), ("a", 1, 20.0, 14.0), ("a", 2, 5.0, 6.0), ("b", 1, 1.0, 1.0)])
    forest = scored([("a", 1, 10.0, 9.0), ("a", 3, 7.0, 8.0)])
    table = compare_hourly(linear, forest, "a")
    assert rows(table, "hour", "avg_actual_speed", "avg_linear_speed", "avg_forest_speed") == [
        (1, 15.0, 13.0, 9.0),
        (2, 5.0, 6.0, None),
        (3, None, None, 8.0),
    ]
