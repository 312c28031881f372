from __future__ import annotations

from collections import Counter

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.checks import queries
from holdfast.cluster import session_conf
from holdfast.operators import categories
from holdfast.operators.categories import category_ranking, encode_categories, fit_category_index, index_by_ranking
from holdfast.operators.features import derive_features, fit_preprocessing
from holdfast.operators.forest import load_models, save_models, score, train_forest


def rows(spark, n=300):
    k = F.col("id")
    return derive_features(
        spark.range(n).select(
            k.cast("string").alias("customerID"),
            (k % 60 * 1.5).alias("MonthlyCharges"),
            F.when(k % 9 > 0, k * 10.0).alias("TotalCharges"),
            (k % 40).cast("double").alias("tenure"),
            F.when(k % 7 > 0, F.concat(F.lit("c"), k % 11)).alias("Contract"),
            F.when(k % 5 > 0, F.concat(F.lit("p"), F.pmod(F.xxhash64(k), F.lit(40)))).alias("PaymentMethod"),
            (k % 3 == 0).cast("string").alias("gender"),
            (k % 2).cast("double").alias("label"),
        )
    )


def vectors(df):
    return {r["customerID"]: list(r["v"]) for r in df.select("customerID", vector_to_array("features").alias("v")).collect()}


@pytest.fixture
def narrow(monkeypatch):
    monkeypatch.setattr(categories, "HELD_VALUES", 5)


def test_wide_columns_give_the_same_vectors(spark, monkeypatch):
    df = rows(spark)
    train, other = df.where("CAST(customerID AS INT) < 200"), df  # values unseen in training among the others
    expected = vectors(fit_preprocessing(train).transform(other))
    monkeypatch.setattr(categories, "HELD_VALUES", 5)
    model = fit_preprocessing(train)
    assert any("Ranked" in type(stage).__name__ for stage in model.stages)
    assert vectors(model.transform(other)) == expected


def test_the_ranking_is_saved_beside_the_model(spark, narrow, tmp_path):
    df = rows(spark)
    model = fit_preprocessing(df)
    forest = train_forest(model.transform(df), num_trees=3, max_depth=3)
    save_models(str(tmp_path), model, forest)
    again, forest_again = load_models(str(tmp_path))
    assert isinstance(again, PipelineModel)
    assert vectors(again.transform(df)) == vectors(model.transform(df))
    scored = score(forest_again, again.transform(df)).select("customerID", "prediction")
    assert sorted(scored.collect()) == sorted(score(forest, model.transform(df)).select("customerID", "prediction").collect())
    assert spark.read.parquet(f"{tmp_path}/*_preproc/stages/*Ranked*/ranking").count() > 40


def test_index_and_encoding_of_wide_columns(spark, monkeypatch):
    df, columns = rows(spark), ["Contract", "PaymentMethod", "gender"]

    def found():
        encoded, _ = encode_categories(df, columns)
        index = fit_category_index(df, columns).transform(df)
        wanted = [vector_to_array(f"{c}_enc").alias(c) for c in columns]
        return sorted(encoded.select("customerID", *wanted).collect()), sorted(
            index.select("customerID", *[f"{c}_idx" for c in columns]).collect()
        )

    expected = found()
    monkeypatch.setattr(categories, "HELD_VALUES", 5)
    assert found() == expected


def test_no_value_of_a_wide_column_reaches_the_driver(spark, monkeypatch):
    """Half a million values: what the driver collects is bounded by what a model holds."""
    monkeypatch.setattr(categories, "HELD_VALUES", 1_000)
    df = spark.range(500_000).select(
        F.col("id").cast("string").alias("Contract"), (F.col("id") % 2).cast("string").alias("gender"),
        (F.col("id") % 100).cast("double").alias("tenure"),
    )
    collected = []
    kind = type(df)
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: collected.append(collect(self)) or collected[-1])
    model = fit_preprocessing(df, ["tenure"], ["Contract", "gender"])
    assert max(map(len, collected)) <= 2_001
    first = model.transform(df.limit(5)).select("features").collect()
    assert {r["features"].size for r in first} == {500_003}
    assert all(len(r["features"].indices) <= 3 for r in first)


def test_nulls_are_spread_over_the_tasks_of_the_join(spark, tmp_path):
    """Before, they met in one; and none of their keys is a value's."""
    df = spark.range(4_000).select("id", F.when(F.col("id") % 4 == 0, F.concat(F.col("id"), F.lit("-"))).alias("c"))
    ranking = category_ranking(df, ["c"], str(tmp_path / "r"))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    with session_conf(spark, off):
        found = index_by_ranking(df, ranking, ["c"]).withColumn("task", F.spark_partition_id()).collect()
    assert len(found) == 4_000
    nulls = Counter(r["task"] for r in found if r["c"] is None)
    assert sum(nulls.values()) == 3_000 and max(nulls.values()) < 1_000
    assert {r["c_idx"] for r in found if r["c"] is None} == {1_000.0}
    assert sorted(r["c_idx"] for r in found if r["c"] is not None) == list(range(1_000))


def test_a_wide_column_is_counted_once(spark, tmp_path):
    """What is counted twice reads its rows twice."""
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(x):
        reads.add(1)
        return x

    df = spark.range(0, 300, 1, 4).select(noted(F.col("id").cast("string")).alias("c"))
    held = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    known = categories.categories_of(df, ["c"], held_values=10)
    assert known.wide == {"c": 300} and reads.value == 300
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) <= held


def test_the_slots_are_read_without_text(spark, plan_of, tmp_path):
    k = F.col("id")
    lines = spark.range(500).select(k.alias("l_orderkey"), k.alias("l_linenumber"), k.alias("l_partkey"), k.alias("l_suppkey"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    found = queries.wide_one_hot(spark, str(tmp_path))
    assert plan_of(found).count("from_json") == 1  # the one that makes the vector
    assert found.count() == sum(i % 7 > 0 for i in range(500))
