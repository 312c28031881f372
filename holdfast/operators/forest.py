"""Random forest: training, scoring, evaluation, saving and loading."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.ranking import with_sum_before
from holdfast.schema import FOREST_SUFFIX, MAX_DEPTH, MODEL_NAME, NUM_TREES, PREPROCESSING_SUFFIX, SEED
from holdfast.sources.files import table_path
from holdfast.sources.versions import current_path, replacing


def train_forest(
    train: DataFrame,
    num_trees: int = NUM_TREES,
    max_depth: int = MAX_DEPTH,
    seed: int = SEED,
    bootstrap: bool = True,
) -> PipelineModel:
    """Forest over `features` and `label`. The learner keeps its own binned copy of the rows on the
    executors, so only the two columns it needs are handed over and nothing is cached here. With
    `bootstrap` the learner draws rows by partition and place: another layout gives another forest.

    The copy leaves the training summary behind. That summary holds the session, and tasks that score
    with the model cannot be serialized with it once the session has run an `Observation`.
    """
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=num_trees, maxDepth=max_depth, seed=seed,
        bootstrap=bootstrap,
    )
    return Pipeline(stages=[forest]).fit(train.select("label", "features")).copy()


def score(forest: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add `rawPrediction`, `probability` and `prediction`."""
    return forest.transform(rows)


def area_under_roc(scored: DataFrame, score_col: str = "rawPrediction", label_col: str = "label") -> float:
    """Exact area under the ROC curve: the share of pairs of a positive and a negative row in which the positive one
    has the higher score, equal scores counting half. 1 without negative rows, else 0 without positive ones.

    Rows are counted by distinct score within each task first, so that a score which fills a third of them is a
    row per task; the scores are then sorted over all tasks. All counts are whole numbers. Of a vector of scores the
    second entry counts; rows without a score (null, NaN) or label are left out.
    """
    score = F.get(vector_to_array(score_col), F.lit(1)) if is_vector(scored, score_col) else F.col(score_col)
    rows = scored.select(score.cast("double").alias("score"), (F.col(label_col) > 0.5).alias("positive")).dropna()
    counts = rows.groupBy("score").agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg"))
    ranked = with_sum_before(counts, ["score"], "neg", "below")
    wide = lambda column: F.col(column).cast("decimal(38,0)")
    pairs = F.sum(wide("pos") * (2 * F.col("below") + F.col("neg")))
    twice, pos, neg = ranked.agg(pairs.cast("decimal(38,0)"), F.sum("pos"), F.sum("neg")).first()
    if not pos:
        return 0.0
    return int(twice) / (2 * pos * neg) if neg else 1.0


def is_vector(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, VectorUDT)


def train_and_evaluate(
    train: DataFrame, test: DataFrame, learner: Callable[[DataFrame], PipelineModel] = train_forest
) -> tuple[PipelineModel, float]:
    """Forest of the training rows and its area under ROC on the test rows."""
    forest = learner(train)
    return forest, area_under_roc(score(forest, test))


def model_paths(models_base: str, name: str = MODEL_NAME) -> tuple[str, str]:
    return (
        table_path(models_base, f"{name}{PREPROCESSING_SUFFIX}"),
        table_path(models_base, f"{name}{FOREST_SUFFIX}"),
    )


def save_models(
    models_base: str, preprocessing: PipelineModel, forest: PipelineModel, name: str = MODEL_NAME
) -> tuple[str, str]:
    """Write both fitted models, replacing older ones once both are complete; returns their paths."""
    spark, paths = SparkSession.active(), model_paths(models_base, name)
    with replacing(spark, paths[0]) as first, replacing(spark, paths[1]) as second:
        preprocessing.save(first)
        forest.save(second)
    return paths


def load_models(models_base: str, name: str = MODEL_NAME) -> tuple[PipelineModel, PipelineModel]:
    spark = SparkSession.active()
    preprocessing, forest = (PipelineModel.load(current_path(spark, p)) for p in model_paths(models_base, name))
    return preprocessing, forest
