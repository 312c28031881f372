from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from holdfast.operators.quality import (
    ReconciliationError,
    SchemaError,
    check_schema,
    null_counts,
    preview,
    reconcile,
    row_count,
    rows_with_null,
    schema_report,
    write_reconciled,
)
from holdfast.schema import CLEANED_SCHEMA, TELCO_SCHEMA, with_complaints


def test_counts(spark, plan_of):
    df = spark.createDataFrame([("a", None), (None, None), ("b", "x")], "customerID STRING, Churn STRING")
    assert row_count(df).first()["row_count"] == 3
    assert null_counts(df).first().asDict() == {"customerID": 1, "Churn": 2}
    assert null_counts(df, ["Churn", "absent"]).columns == ["Churn"]
    assert [r["customerID"] for r in rows_with_null(df, "Churn").orderBy("customerID").collect()] == [None, "a"]
    with pytest.raises(SchemaError):
        null_counts(df, ["absent"])


def test_schema_report_compares_exact_types(spark):
    df = spark.createDataFrame([], "a BIGINT, b STRING, extra INT")
    expected = spark.createDataFrame([], "a INT, b STRING, c DOUBLE").schema
    report = {r["column"]: (r["expected"], r["actual"], r["status"]) for r in
              schema_report(spark, df.schema, expected).collect()}
    assert report == {
        "a": ("int", "bigint", "type"),
        "b": ("string", "string", "ok"),
        "c": ("double", None, "missing"),
    }
    with pytest.raises(SchemaError, match="c"):
        check_schema(df.schema, expected)


def test_declared_schemas():
    assert len(TELCO_SCHEMA) == 21
    assert [f.dataType.simpleString() for f in TELCO_SCHEMA].count("string") == 17
    assert not TELCO_SCHEMA["customerID"].nullable
    assert check_schema(CLEANED_SCHEMA, TELCO_SCHEMA) == ["SeniorCitizen", "tenure"]
    assert CLEANED_SCHEMA.fieldNames()[-1] == "Churn"
    assert len(with_complaints(with_complaints(TELCO_SCHEMA))) == 22


def test_reconciliation(spark, tmp_path):
    df = spark.range(100).withColumn("part", (F.col("id") % 3).cast("string"))
    path, written, found = write_reconciled(df, str(tmp_path), "t", ["part"])
    assert (path, written, found) == (f"{tmp_path}/t", 100, 100)
    with pytest.raises(ReconciliationError, match="101 rows written, 100 read back"):
        reconcile(101, spark.read.parquet(path))


def test_preview_takes_the_first_rows_without_a_full_sort(spark, plan_of):
    df = spark.range(1000, 0, -1)
    first = preview(df, 5, ["id"])
    assert [r["id"] for r in first.collect()] == [1, 2, 3, 4, 5]
    assert "TakeOrderedAndProject" in plan_of(first)
    assert preview(df, 7).count() == 7
