"""Cleansed table to saved models and a test score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from holdfast.cluster import fixed_layout
from holdfast.operators.features import derive_features, fit_preprocessing, index_label
from holdfast.operators.forest import save_models, train_and_evaluate, train_forest
from holdfast.operators.splitting import hash_split, on_train_side
from holdfast.schema import (
    CATEGORICAL_FEATURES,
    CLEANED_SCHEMA,
    CLEANED_TABLE,
    KEY,
    NUMERICAL_FEATURES,
    with_complaints,
)
from holdfast.sources.files import load_cleaned

Split = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


@dataclass(frozen=True)
class TrainReport:
    """Sizes of both sides, the test score and where the models went."""

    train_rows: int
    test_rows: int
    auc: float
    num_features: int
    preprocessing_path: str
    forest_path: str


def train_churn(
    spark: SparkSession,
    cleaned_base: str,
    models_base: str,
    numerical: list[str] = NUMERICAL_FEATURES,
    categorical: list[str] = CATEGORICAL_FEATURES,
    schema: StructType = CLEANED_SCHEMA,
    table_name: str = CLEANED_TABLE,
    key: str = KEY,
    max_categories: int | None = None,
    split: Split | None = None,
    layout_tasks: int | None = None,
    learner: Callable[[DataFrame], PipelineModel] = train_forest,
) -> TrainReport:
    """Derive, split, fit on the training side, score the test side, save both models.

    The split is by the key's hash unless another one is given, such as `random_split`; `learner` may be
    `train_forest` with other settings.

    Every step reads the Parquet table with just the columns it needs. What is exchanged is counts, bin
    statistics and (score, label) pairs. The learner draws its samples by partition and place, so the
    forest follows from how the scan is split, which depends on the files and the cluster. With
    `layout_tasks` the training rows are first dealt out over that many tasks by their content alone: the
    forest is then the same on any cluster, for one exchange of the training rows.
    """
    cleaned = load_cleaned(spark, cleaned_base, with_complaints(schema, marked=True), table_name)
    labelled = index_label(derive_features(cleaned))
    if split:
        train, test = split(labelled)
        train_rows, test_rows = train.count(), test.count()
    else:
        train, test = hash_split(labelled, key)
        is_train = on_train_side(key)
        train_rows, test_rows = labelled.agg(F.count_if(is_train), F.count_if(~is_train)).first()
    preprocessing = fit_preprocessing(train, numerical, categorical, max_categories)
    laid_out = fixed_layout(train, layout_tasks) if layout_tasks else train
    vectors = preprocessing.transform(laid_out).select("label", "features")
    forest, auc = train_and_evaluate(vectors, preprocessing.transform(test), learner)
    preprocessing_path, forest_path = save_models(models_base, preprocessing, forest)
    return TrainReport(
        train_rows=train_rows,
        test_rows=test_rows,
        auc=auc,
        num_features=forest.stages[-1].numFeatures,
        preprocessing_path=preprocessing_path,
        forest_path=forest_path,
    )
