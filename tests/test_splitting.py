from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from holdfast.checks import queries
from holdfast.operators import splitting
from holdfast.operators.splitting import hash_split, random_split


def test_hash_split_against_plain_python(spark, plan_of):
    df = spark.range(2000).select(F.col("id").cast("string").alias("customerID"))
    train, test = hash_split(df)
    want = {str(i) for i in range(2000) if int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) < 0.8 * 2**32}
    assert {r[0] for r in train.collect()} == want
    assert {r[0] for r in test.collect()} == {str(i) for i in range(2000)} - want
    assert "Exchange" not in plan_of(train)


def test_ratios_that_are_no_whole_percents(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("customerID"))
    heads = [int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) for i in range(20_000)]
    for ratio in (0.004, 0.805, 0.996):
        train, test = hash_split(df, train_ratio=ratio)
        assert train.count() == sum(h < ratio * 2**32 for h in heads) == 20_000 - test.count()
        assert 0 < train.count() < 20_000


def test_hash_split_ignores_layout_and_keeps_null_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "customerID STRING")
    sides = [sorted(map(repr, hash_split(df.repartition(n))[0].collect())) for n in (1, 2, 5)]
    assert sides[0] == sides[1] == sides[2]
    train, test = hash_split(df)
    assert train.count() + test.count() == 4


def test_random_split_covers_every_row_once(spark):
    df = spark.range(0, 5000, 1, 4)
    train, test = random_split(df)
    ids = [r["id"] for r in train.collect()] + [r["id"] for r in test.collect()]
    assert sorted(ids) == list(range(5000))
    assert 3800 < train.count() < 4200


def sides(df, **kwargs):
    train, test = random_split(df, **kwargs)
    return sorted(map(tuple, train.collect()), key=repr), sorted(map(tuple, test.collect()), key=repr)


def test_random_split_gives_the_same_sides_in_any_layout(spark, monkeypatch):
    monkeypatch.setattr(splitting, "COPIES_PER_TASK", 7)
    rows = [(i, f"name {i % 90}", None if i % 4 else i / 3) for i in range(400)]
    rows += [(1, "same", 0.5)] * 300 + [(None, None, None)] * 50 + [(2, "twice", 1.0)] * 2
    df = spark.createDataFrame(rows, "id INT, name STRING, x DOUBLE")
    train, test = sides(df.repartition(2))
    assert (train, test) == sides(df.repartition(8)) == sides(df.orderBy("name").coalesce(1))
    assert sorted(train + test, key=repr) == sorted(rows, key=repr)
    assert 0.74 < len(train) / len(rows) < 0.86
    hot = [sum(r == (1, "same", 0.5) for r in side) for side in (train, test)]
    assert sum(hot) == 300 and 40 < hot[1] < 85  # copies are drawn each
    assert sides(df, seed=7)[0] != train
    assert sides(df, train_ratio=1.0)[1] == [] == sides(df, train_ratio=0.0)[0]


def test_rows_that_look_alike_are_told_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("-", None), (None, "-")], "x STRING, y STRING")
    assert df.select(splitting.row_text(df)).distinct().count() == 4


def test_a_row_that_fills_the_table_is_dealt_out(spark, plan_of):
    train, _ = random_split(spark.range(10).select(F.lit(1).alias("x")))
    assert "RepartitionByExpression" in plan_of(train, "extended")


def test_no_task_gets_all_copies_of_a_row(spark, plan_of):
    train, _ = random_split(spark.range(10).select(F.lit(1).alias("x")))
    assert "Join" not in plan_of(train)  # a join by the row's hash gathers them


def test_values_of_any_kind_come_back_as_they_were(spark):
    rows = [(-0.0, "a", [1, 2]), (0.0, "a", [1, 2]), (float("inf"), None, None), (None, "b", []), (0.1 + 0.2, "b", [None])]
    df = spark.createDataFrame(rows + rows[-1:] * 3, "`x.y` DOUBLE, text STRING, n ARRAY<INT>")
    train, test = random_split(df)
    assert train.schema == df.schema
    assert sorted(map(repr, train.collect() + test.collect())) == sorted(map(repr, df.collect()))
    plain = df.drop("n")
    assert sorted(map(repr, sum((side.collect() for side in random_split(plain)), []))) == sorted(map(repr, plain.collect()))


def test_the_layouts_of_the_query_grow_with_the_table(spark, plan_of, tmp_path):
    lines = spark.range(400).select(F.col("id").alias("l_orderkey"), (F.col("id") % 3).cast("string").alias("l_returnflag"))
    lines.repartition(40).write.parquet(f"{tmp_path}/lineitem.parquet")
    plan = plan_of(queries.random_split_sides(spark, str(tmp_path)))
    assert "Coalesce" not in plan and ", 13)" not in plan
