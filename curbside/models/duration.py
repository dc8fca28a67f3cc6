"""Linear and random-forest models of trip duration, overall and by borough."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.base import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from curbside.constants import LABEL, MODEL_BOROUGHS, SAMPLE_SEED
from curbside.functions.trip import predicted_speed_mph
from curbside.models import grouped
from curbside.models.features import SCALED
from curbside.models.fitted import FittedModels, fit_models
from curbside.operators.stats import mean_absolute_error

# Boroughs whose forests are fitted at the same time; each fit is itself a distributed job.
PARALLEL_FITS = 6
SCORED_COLUMNS = ["day", "hour", "trip_distance", LABEL, "speed"]
PREDICTION_COLUMNS = [*SCORED_COLUMNS, "prediction", "predicted_speed"]


def linear_regression(features: str = SCALED) -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol=LABEL)


def random_forest(features: str = SCALED, seed: int = SAMPLE_SEED) -> RandomForestRegressor:
    """Twenty trees of depth five. The seed is fixed: PySpark's default differs from process to process."""
    return RandomForestRegressor(featuresCol=features, labelCol=LABEL, seed=seed)


def default_models() -> dict[str, Estimator]:
    return {"linear": linear_regression(), "forest": random_forest()}


def predict(train: DataFrame, test: DataFrame, estimator: Estimator) -> DataFrame:
    """Fit on prepared train rows; test rows with ``prediction`` and ``predicted_speed``."""
    scored = estimator.fit(train).transform(test)
    return scored.withColumn("predicted_speed", predicted_speed_mph())


def predict_on(
    train: DataFrame, test: DataFrame, columns: list[str], estimator: Estimator
) -> DataFrame:
    """The same on numeric columns as they are, put together as ``features``."""
    rows = VectorAssembler(inputCols=columns, outputCol="features")
    return predict(rows.transform(train), rows.transform(test), estimator).drop("features")


def stump() -> RandomForestRegressor:
    """The smallest forest: one tree, one cut, all rows."""
    return RandomForestRegressor(
        featuresCol="features",
        labelCol=LABEL,
        numTrees=1,
        maxDepth=1,
        bootstrap=False,
        featureSubsetStrategy="all",
    )


def _line(trips: DataFrame, columns: list[str]) -> tuple:
    rows = VectorAssembler(inputCols=columns, outputCol="features").transform(trips)
    fitted = linear_regression("features").fit(rows)
    return (*map(float, fitted.coefficients), fitted.intercept, int(fitted.summary.numInstances))


def _line_schema(columns: list[str]) -> str:
    return ", ".join(f"{name} double" for name in columns) + ", intercept double, n bigint"


def fitted_lines(trips: DataFrame, columns: list[str]) -> DataFrame:
    """Linear regression on numeric columns: one row of coefficients, intercept and rows."""
    return trips.sparkSession.createDataFrame([_line(trips, columns)], _line_schema(columns))


def borough_lines(train: DataFrame, columns: list[str], boroughs: Iterable[str]) -> DataFrame:
    """The same for every listed borough that has rows, from one scan; one row per borough."""
    chosen = train.where(F.col("Borough").isin(list(boroughs)))
    found = grouped.moments(chosen, ["Borough"], [], columns)
    return grouped.wide_lines(grouped.fit_lines(found, ["Borough"], [], columns), columns, ["Borough"])


def univariate_line(trips: DataFrame, feature: str = "trip_distance") -> DataFrame:
    """Least-squares line of duration on one column: one row (slope, intercept, n)."""
    pair = (F.col(LABEL), F.col(feature))
    return trips.agg(
        F.regr_slope(*pair).alias("slope"),
        F.regr_intercept(*pair).alias("intercept"),
        F.regr_count(*pair).alias("n"),
    )


def apply_line(trips: DataFrame, line: DataFrame, feature: str = "trip_distance") -> DataFrame:
    """Predict durations by a one-row line, lazily."""
    fitted = F.col("intercept") + F.col("slope") * F.col(feature)
    return (
        trips.crossJoin(F.broadcast(line.select("slope", "intercept")))
        .select(*trips.columns, fitted.alias("prediction"))
        .withColumn("predicted_speed", predicted_speed_mph())
    )


def borough_sizes(train: DataFrame, test: DataFrame, boroughs: list[str]) -> dict:
    """Rows per borough of both sets, counted in one pass over each."""
    sides = train.select("Borough", F.lit(0).alias("is_test")).unionByName(
        test.select("Borough", F.lit(1).alias("is_test"))
    )
    counts = sides.where(F.col("Borough").isin(boroughs)).groupBy("Borough").agg(
        F.sum(1 - F.col("is_test")).alias("train"), F.sum("is_test").alias("test")
    )
    # At most one row per listed borough.
    found = {row["Borough"]: (row["train"], row["test"]) for row in counts.collect()}
    return {name: found.get(name, (0, 0)) for name in boroughs}


def fit_boroughs(
    train: DataFrame,
    boroughs: Iterable[str] = MODEL_BOROUGHS,
    models: dict[str, Estimator] | None = None,
    parallelism: int = PARALLEL_FITS,
) -> FittedModels:
    """Models of every listed borough that has training rows, as tables.

    Features and plain linear regressions of all boroughs come from one scan. Rows
    are not grouped into tasks by borough, and a forest's fit is a distributed job,
    so one borough holding most trips only means more tasks.
    """
    models = default_models() if models is None else models
    chosen = train.where(F.col("Borough").isin(list(boroughs)))
    return fit_models(chosen, models, ["Borough"], parallelism=parallelism)


def score_boroughs(fitted: FittedModels, test: DataFrame) -> DataFrame:
    """Test predictions of every borough and model, with both as columns, from one scan."""
    inputs = [*fitted.categories, *fitted.numbers]
    needed = [*fitted.by, *inputs, *[c for c in SCORED_COLUMNS if c not in inputs]]
    scored = fitted.score(test.select(*needed))
    scored = scored.withColumn("predicted_speed", predicted_speed_mph())
    return scored.select("Borough", "model", *PREDICTION_COLUMNS)


def borough_predictions(
    train: DataFrame,
    test: DataFrame,
    boroughs: Iterable[str] = MODEL_BOROUGHS,
    models: dict[str, Estimator] | None = None,
    parallelism: int = PARALLEL_FITS,
) -> DataFrame:
    """Test predictions by models fitted on train; boroughs without training rows have none."""
    return score_boroughs(fit_boroughs(train, boroughs, models, parallelism), test)


def borough_scores(
    train: DataFrame,
    test: DataFrame,
    boroughs: Iterable[str] = MODEL_BOROUGHS,
    models: dict[str, Estimator] | None = None,
) -> DataFrame:
    """MAE of every borough and model; pairs without a model or test rows say why."""
    models = default_models() if models is None else models
    boroughs = list(boroughs)
    sizes = borough_sizes(train, test, boroughs)

    def status(train_rows: int, test_rows: int) -> str:
        if not train_rows:
            return "no training rows"
        return "scored" if test_rows else "no test rows"

    listed = train.sparkSession.createDataFrame(
        [(b, m, *sizes[b], status(*sizes[b])) for b in boroughs for m in models],
        "Borough string, model string, train_rows bigint, test_rows bigint, status string",
    )
    predictions = borough_predictions(train, test, boroughs, models)
    scores = mean_absolute_error(predictions, "Borough", "model").drop("predictions")
    return listed.join(F.broadcast(scores), ["Borough", "model"], "left")
