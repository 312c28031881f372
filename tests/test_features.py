from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.cluster import session_conf
from holdfast.operators.complaints import add_complaints, complaint_counts
from holdfast.operators.features import (
    assemble_features,
    derive_features,
    derive_sql,
    fit_preprocessing,
    index_label,
    project_features,
    query_table,
    training_medians,
)

SCHEMA = (
    "customerID STRING, SeniorCitizen DOUBLE, tenure DOUBLE, MonthlyCharges DOUBLE, TotalCharges DOUBLE,"
    " Contract STRING, gender STRING, Churn STRING, NumComplaints90Days INT"
)
ROWS = [
    ("a", 0.0, 1.0, 30.0, 100.0, "m2m", "F", "No", 2),
    ("b", 1.0, 5.0, 60.0, None, "m2m", None, "Yes", None),
    ("c", 0.0, None, None, 300.0, "year", "M", "Yes", 0),
    ("d", 0.0, 9.0, 90.0, float("inf"), "year", "F", "Yes", 1),
    ("e", 0.0, 7.0, float("nan"), 200.0, "m2m", "F", None, 1),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_derived_columns(df, plan_of):
    derived = derive_features(df)
    got = {r["customerID"]: (r["avg_daily_charge"], r["complaints_90d"]) for r in derived.collect()}
    assert got["a"] == (1.0, 2)
    assert got["b"] == (2.0, 0)
    assert got["c"] == (None, 0)
    assert derived.columns[: len(df.columns)] == df.columns
    assert "Exchange" not in plan_of(derived)


def test_absent_complaints_count_as_zero(df):
    assert {r["complaints_90d"] for r in derive_features(df.drop("NumComplaints90Days")).collect()} == {0}


def test_sql_text_gives_the_same(df):
    columns = ["customerID", "avg_daily_charge", "complaints_90d"]
    kinds = [df, df.drop("NumComplaints90Days"), df.withColumn("NumComplaints90Days", F.lit(3_000_000_000)),
             df.withColumn("NumComplaints90Days", F.lit("3000000000"))]
    for rows in kinds:
        by_sql, by_api = query_table(rows, derive_sql(rows.schema)), derive_features(rows)
        assert by_sql.schema == by_api.schema
        by_sql, by_api = (x.select(columns).filter("customerID <> 'e'") for x in (by_sql, by_api))
        assert by_sql.exceptAll(by_api).count() == by_api.exceptAll(by_sql).count() == 0
    assert {r["complaints_90d"] for r in derive_features(kinds[2]).collect()} == {3_000_000_000}
    unreadable = df.withColumn("NumComplaints90Days", F.lit("many"))
    assert {r["complaints_90d"] for r in derive_features(unreadable).collect()} == {None}
    assert not df.sparkSession.catalog.listTables()


def test_projection_skips_absent_columns(df):
    assert project_features(derive_features(df.drop("tenure"))).columns == [
        "customerID", "avg_daily_charge", "complaints_90d", "Churn", "MonthlyCharges", "TotalCharges",
    ]


def test_label_does_not_flip_with_the_majority(df):
    labels = {r["customerID"]: r["label"] for r in index_label(df).collect()}
    assert labels == {"a": 0.0, "b": 1.0, "c": 1.0, "d": 1.0}
    meta = index_label(df).schema["label"].metadata["ml_attr"]
    assert meta["vals"] == ["No", "Yes"]
    with pytest.raises(ValueError, match="Churn"):
        index_label(df.drop("Churn"))


def test_label_filter_prunes_partitions(spark, df, tmp_path, plan_of):
    df.write.partitionBy("Churn").parquet(str(tmp_path / "t"))
    plan = plan_of(index_label(spark.read.parquet(str(tmp_path / "t"))), "formatted")
    assert "PartitionFilters: [Churn" in plan and " IN (No,Yes)]" in plan


def test_vectors(df):
    rows = derive_features(df)
    model = fit_preprocessing(rows)
    got = {
        r["customerID"]: r["v"]
        for r in model.transform(rows).select("customerID", vector_to_array("features").alias("v")).collect()
    }
    # SeniorCitizen, tenure, MonthlyCharges, TotalCharges, daily charge, complaints, gender F M, Contract m2m year
    assert got["a"] == [0, 1, 30, 100, 1, 2, 1, 0, 1, 0]
    assert got["b"] == [1, 5, 60, 200, 2, 0, 0, 0, 1, 0]
    assert got["c"] == [0, 5, 60, 300, 2, 0, 0, 1, 0, 1]
    assert got["d"] == [0, 9, 90, 200, 3, 1, 1, 0, 0, 1]
    assert got["e"] == [0, 7, 60, 200, 2, 1, 1, 0, 1, 0]


def test_fit_sees_training_rows_only(spark, df):
    rows = derive_features(df)
    train = rows.filter("customerID IN ('a', 'b')")
    model = fit_preprocessing(train)
    assert training_medians(train, ["TotalCharges", "tenure"]) == {"TotalCharges": 100.0, "tenure": 1.0}
    vector = model.transform(rows.filter("customerID = 'c'")).first()["features"]
    # One value each for Contract (m2m) and gender (F) in training: the other ones are all zero.
    assert list(vector.toArray()) == [0, 1, 30, 300, 1, 0, 0, 0]


def test_columns_without_values_are_left_out(spark, df):
    rows = derive_features(df.withColumn("tenure", F.lit(None).cast("double")).withColumn(
        "Contract", F.lit(None).cast("string")))
    out = fit_preprocessing(rows).transform(rows)
    assert out.first()["features"].size == 7
    assert out.count() == 5
    with pytest.raises(ValueError):
        fit_preprocessing(df.select("customerID", "Churn"))


def test_median_stays_within_its_error(spark):
    df = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 10 > 0, F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double")).alias("tenure")
    )
    fill = training_medians(df, ["tenure"])["tenure"]
    filled = fit_preprocessing(df).transform(df.filter("tenure IS NULL").limit(1)).first()
    assert filled["features"].toArray().tolist() == [fill]
    values = sorted(r["tenure"] for r in df.filter("tenure IS NOT NULL").collect())
    rank = values.index(fill) + 1
    assert abs(rank - len(values) / 2) <= 0.001 * len(values)


@pytest.mark.parametrize("value", [-5.0, 1e20, 2.5e-7, 0.1])
def test_any_median_fills(spark, value):
    df = spark.createDataFrame([(value,), (None,)], "tenure DOUBLE")
    rows = fit_preprocessing(df).transform(df).collect()
    assert [r["features"].toArray().tolist() for r in rows] == [[value], [value]]


def test_assemble_returns_labelled_vectors(df):
    out, model = assemble_features(derive_features(df))
    assert out.count() == 4
    assert out.select("label", "features").first() is not None
    assert model.transform(derive_features(df.drop("Churn"))).count() == 5


def test_complaint_window_and_hot_user(spark, plan_of):
    until = datetime(2024, 3, 31)
    events = spark.createDataFrame(
        [
            (1, "error", datetime(2024, 1, 1)),
            (1, "error", datetime(2023, 12, 31, 23, 59, 59)),
            (1, "view", datetime(2024, 3, 1)),
            (2, "error", datetime(2024, 3, 31)),
            *[(3, "error", datetime(2024, 3, 1))] * 500,
        ],
        "user_id BIGINT, event_type STRING, ts TIMESTAMP_NTZ",
    )
    counts = complaint_counts(events, until)
    assert {r["user_id"]: r["NumComplaints90Days"] for r in counts.collect()} == {1: 1, 3: 500}
    customers = spark.createDataFrame([(1,), (2,), (3,)], "c BIGINT")
    joined = add_complaints(customers, counts, "c")
    assert {r["c"]: r["NumComplaints90Days"] for r in joined.collect()} == {1: 1, 2: None, 3: 500}
    assert "partial_count" in plan_of(counts)


def test_hot_customer_key_is_split(spark, plan_of):
    hot = F.col("id") % 3 == 0
    customers = spark.range(0, 60_000, 1, 8).select(
        F.when(hot, F.lit(7)).otherwise(F.col("id")).alias("c"), F.md5(F.col("id").cast("string")).alias("payload")
    )
    events = spark.range(0, 3000, 1, 4).select(
        F.col("id").alias("user_id"),
        F.lit("error").alias("event_type"),
        F.lit("2024-01-20").cast("timestamp_ntz").alias("ts"),
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    with session_conf(spark, conf):
        joined = add_complaints(customers, complaint_counts(events, datetime(2024, 1, 31)), "c")
        rows = joined.collect()
        assert "skew=true" in plan_of(joined)
    assert len(rows) == 60_000
    assert sum(r["NumComplaints90Days"] or 0 for r in rows) == 20_000 + 2000
