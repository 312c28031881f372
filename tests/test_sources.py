from __future__ import annotations

import math
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from holdfast.operators.cleansing import cleanse
from holdfast.sources.files import load_cleaned, read_csv, write_parquet

SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("n", IntegerType()),
        StructField("amt", DoubleType()),
        StructField("flag", StringType()),
    ]
)
EDGE_LINES = (
    "WRONGNAME,n,amt,flag",
    "  a1 ,1, ,Yes",
    "a1,1,,Yes",
    "   ,2,3.5,No",
    ",2,3.5,No",
    "b1,xx,4.5,No",
    "b2,3",
    "b3,4,5.5,Yes,EXTRA",
    '"q""x",5,NaN,',
    'b4,6,"1,200",""',
    "\tb5\t,7,1e3,No",
    "b6,8, 7.5 ,No",
    "b7,9.0,1,No",
    "",
)


@pytest.fixture
def edge(spark, csv_file):
    return read_csv(spark, csv_file(*EDGE_LINES), SCHEMA)


def by_id(df):
    return {r["id"]: tuple(r)[1:] for r in df.collect()}


def test_permissive_parsing_keeps_rows_and_nulls_fields(edge):
    rows = by_id(edge)
    assert edge.count() == 12
    assert rows["  a1 "] == (1, None, "Yes")
    assert rows["a1"] == (1, None, "Yes")
    assert rows["b1"] == (None, 4.5, "No")
    assert rows["b2"] == (3, None, None)
    assert rows["b3"] == (4, 5.5, "Yes")
    assert rows["b4"][:2] == (6, None)
    assert rows["\tb5\t"] == (7, 1000.0, "No")
    assert rows["b6"] == (8, 7.5, "No")
    assert rows["b7"] == (None, 1.0, "No")
    assert math.isnan(rows['"q""x"'][1])


def test_edge_rows_after_cleansing(edge):
    rows = by_id(cleanse(edge, ["n", "amt"], "id"))
    assert len(rows) == 9
    assert rows["a1"] == (1.0, None, "Yes")
    assert rows["b4"] == (6.0, None, None)
    assert "\tb5\t" in rows
    assert math.isnan(rows['"q""x"'][1])


def test_quoted_newline_splits_the_record(spark, csv_file):
    df = read_csv(spark, csv_file("id,n,amt,flag", '"a', 'b",1,2.0,Yes'), SCHEMA)
    assert df.count() == 2


def test_every_file_of_a_folder_has_its_own_header(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(f"id,n,amt,flag\nx{i},1,2.0,Yes\n")
    assert sorted(r["id"] for r in read_csv(spark, str(tmp_path), SCHEMA).collect()) == ["x0", "x1", "x2"]


def test_partition_values_come_back_as_declared(spark, tmp_path):
    df = spark.createDataFrame([("1", 1), ("02", 2), ("", 3), (None, 4)], "part STRING, n INT")
    path = write_parquet(df, str(tmp_path), "t", ["part"])
    assert path == f"{tmp_path}/t"
    back = load_cleaned(spark, str(tmp_path), df.schema, "t")
    assert {r["n"]: r["part"] for r in back.collect()} == {1: "1", 2: "02", 3: None, 4: None}


def test_overwrite_removes_partitions_that_are_not_written_again(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "part STRING, n INT")
    write_parquet(df, str(tmp_path), "t", ["part"])
    write_parquet(df.filter("part = 'a'"), str(tmp_path), "t", ["part"])
    assert load_cleaned(spark, str(tmp_path), df.schema, "t").count() == 1


def test_partition_and_column_filters_reach_the_scan(spark, tmp_path, plan_of):
    df = spark.range(100).select(
        F.when(F.col("id") % 2 == 0, "Yes").otherwise("No").alias("Churn"), "id", (F.col("id") * 2).alias("twice")
    )
    write_parquet(df, str(tmp_path), "t", ["Churn"])
    back = load_cleaned(spark, str(tmp_path), df.schema, "t")
    plan = plan_of(back.filter("Churn = 'Yes' AND id > 10").select("id"), "formatted")
    assert "PartitionFilters: [isnotnull(Churn" in plan
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,10)]" in plan
    assert "ReadSchema: struct<id:bigint>" in plan


def test_partitioned_write_adds_no_exchange_and_keeps_tasks_parallel(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).select("id", F.lit("only").alias("part"))
    write_parquet(df, str(tmp_path), "t", ["part"])
    files = [f for f in os.listdir(tmp_path / "t" / "part=only") if f.endswith(".parquet")]
    assert len(files) == 4
