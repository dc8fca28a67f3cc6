"""Model inputs: indexed and one-hot categories, numeric columns, unit scale."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame

from curbside.constants import CATEGORICAL_FEATURES, NUMERIC_FEATURES

ASSEMBLED, SCALED = "assembled_features", "scaled_features"


def indexed(column: str) -> str:
    return f"{column}_index"


def encoded(column: str) -> str:
    return f"{column}_encoded"


def string_indexer(columns: list[str] = CATEGORICAL_FEATURES) -> StringIndexer:
    """Most frequent value first, ties by text; unseen values keep an index of their own."""
    return StringIndexer(
        inputCols=columns, outputCols=[indexed(c) for c in columns], handleInvalid="keep"
    )


def one_hot_encoder(columns: list[str] = CATEGORICAL_FEATURES) -> OneHotEncoder:
    """The unseen index is the dropped last one, hence the zero vector."""
    return OneHotEncoder(
        inputCols=[indexed(c) for c in columns], outputCols=[encoded(c) for c in columns]
    )


def assembler(
    categories: list[str] = CATEGORICAL_FEATURES, numbers: list[str] = NUMERIC_FEATURES
) -> VectorAssembler:
    return VectorAssembler(
        inputCols=[*[encoded(c) for c in categories], *numbers], outputCol=ASSEMBLED
    )


def scaler(with_mean: bool = False) -> StandardScaler:
    """Unit standard deviation; not centred unless asked, which keeps vectors sparse."""
    return StandardScaler(inputCol=ASSEMBLED, outputCol=SCALED, withMean=with_mean)


def feature_pipeline(
    categories: list[str] = CATEGORICAL_FEATURES,
    numbers: list[str] = NUMERIC_FEATURES,
    with_mean: bool = False,
) -> Pipeline:
    return Pipeline(
        stages=[
            string_indexer(categories),
            one_hot_encoder(categories),
            assembler(categories, numbers),
            scaler(with_mean),
        ]
    )


def prepare_features(
    train: DataFrame, test: DataFrame, **options
) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """Fit on train, transform both; also returns the fitted pipeline."""
    fitted = feature_pipeline(**options).fit(train)
    return fitted.transform(train), fitted.transform(test), fitted
