from __future__ import annotations

import itertools
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from holdfast.operators.features import derive_features, fit_preprocessing, index_label
from holdfast.operators.forest import area_under_roc, load_models, save_models, score, train_forest


@pytest.fixture(scope="module")
def customers(spark):
    noise = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100))
    return spark.range(0, 600, 1, 4).select(
        F.col("id").cast("string").alias("customerID"),
        (F.col("id") % 72).cast("double").alias("tenure"),
        (20 + noise).cast("double").alias("MonthlyCharges"),
        F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("Contract"),
        F.when((F.col("id") % 72 < 30) != (noise < 15), "Yes").otherwise("No").alias("Churn"),
    )


@pytest.fixture(scope="module")
def fitted(spark, customers):
    # An observation in the same session must not keep tasks from scoring with a fresh model.
    seen = Observation("before")
    customers.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 600
    rows = index_label(derive_features(customers))
    preprocessing = fit_preprocessing(rows)
    vectors = preprocessing.transform(rows)
    return preprocessing, train_forest(vectors, num_trees=10, max_depth=4), vectors


def test_forest_has_two_classes(fitted):
    _, forest, vectors = fitted
    scored = score(forest, vectors)
    assert forest.stages[-1].numClasses == 2
    assert forest.stages[-1].getNumTrees == 10
    sizes = scored.select(F.size(vector_to_array("rawPrediction")).alias("n")).distinct().collect()
    assert [r["n"] for r in sizes] == [2]
    assert area_under_roc(scored) > 0.8


def test_area_equals_the_share_of_ordered_pairs(fitted):
    _, forest, vectors = fitted
    scored = score(forest, vectors)
    pairs = scored.select(vector_to_array("rawPrediction")[1].alias("s"), "label").collect()
    pos = [r["s"] for r in pairs if r["label"] == 1.0]
    neg = [r["s"] for r in pairs if r["label"] == 0.0]
    wins = sum((p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg))
    assert area_under_roc(scored) == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-9)


def test_area_is_exact_beyond_a_thousand_scores(spark):
    df = spark.range(3000).select(
        F.pmod(F.xxhash64("id"), F.lit(2500)).cast("double").alias("score"),
        F.pmod(F.xxhash64("id", F.lit(7)), F.lit(2)).cast("double").alias("label"),
    )
    rows = df.collect()
    pos = sorted(r["score"] for r in rows if r["label"] == 1.0)
    neg = sorted(r["score"] for r in rows if r["label"] == 0.0)
    wins = sum((p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg))
    assert area_under_roc(df, "score") == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_saved_models_predict_the_same(spark, fitted, customers, tmp_path, plan_of):
    preprocessing, forest, vectors = fitted
    paths = save_models(str(tmp_path), preprocessing, forest)
    assert [p.rsplit("/", 1)[1] for p in paths] == [
        "churn_prediction_pipeline_preproc",
        "churn_prediction_pipeline_rf",
    ]
    save_models(str(tmp_path), preprocessing, forest)
    again, forest_again = load_models(str(tmp_path))
    scored = score(forest_again, again.transform(derive_features(customers)))
    theirs = {r["customerID"]: r["probability"] for r in scored.collect()}
    mine = {r["customerID"]: r["probability"] for r in score(forest, vectors).collect()}
    assert mine == theirs
    assert "Exchange" not in plan_of(scored)


def test_area_over_many_tasks_and_a_hot_score(spark, plan_of):
    """A third of the rows share a score; the rest have scores of their own."""
    rng = random.Random(5)
    rows = [(0.5 if i % 3 == 0 else rng.random(), float(rng.random() < 0.3)) for i in range(3_000)]
    df = spark.createDataFrame(rows, "score DOUBLE, label DOUBLE").repartition(9)
    pos, neg = ([s for s, label in rows if label == wanted] for wanted in (1.0, 0.0))
    wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
    assert area_under_roc(df, "score") == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


@pytest.mark.parametrize(
    "rows,area", [([], 0.0), ([(0.1, 1.0)], 1.0), ([(0.1, 0.0)], 0.0), ([(0.2, 0.0), (0.2, 1.0), (None, 1.0)], 0.5),
                  ([(float("nan"), 1.0), (9.0, 0.0)], 0.0), ([(0.3, 0.0), (0.1, 1.0)], 0.0)]
)
def test_area_of_odd_tables(spark, rows, area):
    assert area_under_roc(spark.createDataFrame(rows, "score DOUBLE, label DOUBLE"), "score") == area
