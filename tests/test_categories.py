from __future__ import annotations

from collections import Counter

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.cluster import session_conf
from holdfast.operators.categories import (
    TooManyCategories,
    category_counts,
    category_labels,
    category_ranking,
    encode_categories,
    fit_category_index,
    index_by_ranking,
)

ROWS = [("b", "x", None), ("a", "x", None), ("b", "y", None), ("a", "z", None), (None, "z", None), ("c", "x", None)]
SCHEMA = "p STRING, q STRING, empty STRING"


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_ranking_against_a_counter(df, tmp_path):
    got = {(r["column"], r["value"]): (r["n"], r["index"]) for r in category_ranking(df, ["p", "q"], str(tmp_path / "r")).collect()}
    want = {}
    for i, name in enumerate(("p", "q")):
        counts = Counter(r[i] for r in ROWS if r[i] is not None)
        for index, (value, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))):
            want[(name, value)] = (n, index)
    assert got == want


def test_labels_equal_the_built_in_indexer(spark):
    df = spark.range(5000).select(
        *[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(3 + 4 * i)).cast("string").alias(f"c{i}") for i in range(3)]
    )
    columns = df.columns
    built_in = StringIndexer(inputCols=columns, outputCols=[f"{c}_i" for c in columns]).fit(df)
    assert [list(v) for v in built_in.labelsArray] == list(category_labels(df, columns).values())


def test_index_and_encoding(spark, df):
    index = fit_category_index(df, ["p", "q", "empty", "absent"])
    rows = {r["p"]: r["p_idx"] for r in index.transform(df).collect()}
    assert rows == {"a": 0.0, "b": 1.0, "c": 2.0, None: 3.0}
    assert "empty_idx" not in index.transform(df).columns
    unseen = spark.createDataFrame([("zzz", "x", None)], SCHEMA)
    assert index.transform(unseen).first()["p_idx"] == 3.0

    encoded, model = encode_categories(df, ["p", "q", "empty"])
    vectors = {r["p"]: r["v"] for r in encoded.select("p", vector_to_array("p_enc").alias("v")).collect()}
    assert vectors == {"a": [1, 0, 0], "b": [0, 1, 0], "c": [0, 0, 1], None: [0, 0, 0]}
    assert model.transform(unseen).first()["p_enc"].numNonzeros() == 0


def test_one_valued_column_gives_one_slot(spark):
    encoded, _ = encode_categories(spark.createDataFrame([("a",), ("a",)], "p STRING"), ["p"])
    assert encoded.first()["p_enc"].size == 1


def test_columns_without_values(spark):
    nothing = spark.createDataFrame([(None,)], "p STRING")
    assert category_labels(nothing, ["p"]) == {}
    assert category_labels(nothing, ["absent"]) == {}
    with pytest.raises(ValueError):
        encode_categories(nothing, ["p"])


def test_key_like_columns_fail_instead_of_being_cut(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit("one").alias("c"))
    with pytest.raises(TooManyCategories, match="k"):
        category_labels(df, ["c", "k"], max_categories=49)
    assert len(category_labels(df, ["c", "k"], max_categories=50)["k"]) == 50


def test_ranking_over_many_tasks(spark, tmp_path):
    df = spark.range(0, 20_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(4000)).cast("string"))
        .alias("many"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)).cast("string").alias("few"),
    )
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        ranking = category_ranking(df, ["many", "few"], str(tmp_path / "r"))
        got = {(r["column"], r["value"]): (r["n"], r["index"]) for r in ranking.collect()}
    rows = df.collect()
    for name in df.columns:
        counts = Counter(r[name] for r in rows)
        for index, (value, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))):
            assert got.pop((name, value)) == (n, index)
    assert not got


def test_index_by_ranking_equals_the_models(spark, df, tmp_path):
    ranking = category_ranking(df, ["p", "q"], str(tmp_path / "r"))
    unseen = df.unionByName(spark.createDataFrame([("zzz", None, None)], SCHEMA))
    joined = index_by_ranking(unseen, ranking, ["p", "q", "absent"])
    by_model = fit_category_index(df, ["p", "q"]).transform(unseen)
    columns = ["p", "q", "p_idx", "q_idx"]
    assert sorted(map(repr, joined.select(columns).collect())) == sorted(map(repr, by_model.select(columns).collect()))


def test_no_bound_unless_named(spark):
    df = spark.range(12_000).select(F.col("id").cast("string").alias("k"))
    assert len(category_labels(df, ["k"])["k"]) == 12_000


def test_counts_form_before_the_exchange(df, plan_of):
    plan = plan_of(category_counts(df, ["p", "q"]))
    assert plan.index("partial_count") > plan.index("Exchange")
    assert plan.count("Exchange") == 1
