from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from holdfast.operators.cleansing import (
    blank_to_null,
    cast_numeric,
    cleanse,
    cleanse_with_copies,
    drop_duplicate_rows,
    drop_missing_key,
    normalise,
    trim_strings,
)

SCHEMA = "customerID STRING, amt STRING, flag STRING"
NUMBERS = ["amt", "absent"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_trim_takes_spaces_only(spark):
    df = spark.createDataFrame([("  a ", "\tb\n", None)], SCHEMA)
    assert rows(trim_strings(df)) == [("a", "\tb\n", None)]


def test_blank_to_null(spark):
    df = spark.createDataFrame([("", " ", "x")], SCHEMA)
    assert rows(blank_to_null(df)) == [(None, " ", "x")]


def test_bad_numbers_become_null_and_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("a", "1.5", "x"), ("b", "n/a", "y"), ("c", None, "z")], SCHEMA)
    assert rows(cast_numeric(df, NUMBERS)) == [("a", 1.5, "x"), ("b", None, "y"), ("c", None, "z")]


def test_one_projection_equals_the_three_steps(spark):
    df = spark.createDataFrame([(" a ", " 7 ", ""), ("", "x", None), (None, "1e3", " ")], SCHEMA)
    assert rows(normalise(df, NUMBERS)) == rows(cast_numeric(blank_to_null(trim_strings(df)), NUMBERS))


def test_rows_that_differ_anywhere_both_stay(spark):
    df = spark.createDataFrame([("a", "1", "x"), ("a", "1", "y"), ("a", "1.0", "x")], SCHEMA)
    assert rows(cleanse(df, NUMBERS)) == [("a", 1.0, "x"), ("a", 1.0, "y")]


def test_special_values_compare_equal(spark):
    df = spark.createDataFrame(
        [(0.0,), (-0.0,), (math.nan,), (float("nan"),), (None,), (None,)], "x DOUBLE"
    )
    assert drop_duplicate_rows(df).count() == 3


def test_missing_key_column_keeps_the_table(spark):
    df = spark.createDataFrame([(None, 1)], "x STRING, y INT")
    assert drop_missing_key(df).count() == 1


def test_cleansing_shuffles_once_and_prunes_before_it(spark, tmp_path, plan_of):
    spark.createDataFrame([("a", "1", "x")], SCHEMA).write.parquet(str(tmp_path / "t"))
    plan = plan_of(cleanse(spark.read.parquet(str(tmp_path / "t")), NUMBERS))
    assert plan.count("Exchange") == 1
    assert plan.index("Filter") > plan.index("Exchange")


text = st.one_of(st.none(), st.sampled_from(["", " ", "a", " a", "a ", "b", "1", "1.0", " 1", "x"]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(text, text, text), max_size=25), parts=st.integers(1, 5))
def test_cleansing_against_plain_python(spark, data, parts):
    def clean(value):
        return (value.strip(" ") or None) if value is not None else None

    def number(value):
        try:
            return float(value)
        except (TypeError, ValueError):
            return None

    want = {(clean(a), number(clean(b)), clean(c)) for a, b, c in data if clean(a) is not None}
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    once = cleanse(df, NUMBERS)
    assert rows(once) == sorted(want, key=repr)
    assert rows(cleanse(once, NUMBERS)) == rows(once)
    counted = cleanse_with_copies(df, "copies", NUMBERS)
    assert sum(r["copies"] for r in counted.collect()) == len(data)
    assert rows(counted.filter("customerID IS NOT NULL").drop("copies")) == rows(once)
    assert counted.filter("customerID IS NULL").count() <= 1


def test_a_third_of_the_rows_being_one_row(spark, tmp_path):
    hot = F.col("id") % 3 == 0
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(hot, " hot ").otherwise(F.col("id").cast("string")).alias("customerID"),
        F.when(hot, "1").otherwise("2").alias("amt"),
        F.lit("x").alias("flag"),
    )
    assert cleanse(df, NUMBERS).count() == 20_001
    counted = cleanse_with_copies(df, "copies", NUMBERS)
    assert counted.filter("customerID = 'hot'").first()["copies"] == 10_000
