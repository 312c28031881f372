from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from holdfast.sources import versions
from holdfast.sources.files import load_cleaned, write_parquet
from holdfast.sources.versions import Superseded, current_path, replacing


def rows(spark, value, n=20):
    return spark.range(n).select("id", F.lit(value).alias("value"), (F.col("id") % 3).cast("string").alias("part"))


def held(spark, base):
    """The values of the whole table; fails if files of several versions are mixed."""
    table = load_cleaned(spark, base, rows(spark, 0).schema, "t")
    return {(r["value"], r["n"]) for r in table.groupBy("value").agg(F.count("id").alias("n")).collect()}


def failing(df):
    """The rows, with a task that fails after others have written theirs."""
    return df.repartition(4, "id").withColumn("value", F.when(F.col("id") == 7, F.raise_error(F.lit("half way"))).otherwise(F.col("value")))


@pytest.mark.parametrize("settle", [True, False])
@pytest.mark.parametrize("parts", [None, ["part"]])
def test_a_write_that_ends_half_way_leaves_the_old_table(spark, tmp_path, settle, parts):
    base = str(tmp_path)
    write_parquet(rows(spark, 1), base, "t", parts, settle=settle)
    with pytest.raises(Exception, match="half way"):
        write_parquet(failing(rows(spark, 2)), base, "t", parts, settle=settle)
    assert held(spark, base) == {(1, 20)}
    write_parquet(rows(spark, 3, 5), base, "t", parts, settle=settle)
    assert held(spark, base) == {(3, 5)}


@pytest.mark.parametrize("settle", [True, False])
def test_a_version_that_is_refused_is_never_read(spark, tmp_path, settle):
    base = str(tmp_path)

    def refuse(folder):
        assert spark.read.parquet(folder).count() == 20 and held(spark, base) == {(1, 20)}
        raise ValueError("refused")

    write_parquet(rows(spark, 1), base, "t", settle=settle)
    with pytest.raises(ValueError, match="refused"):
        write_parquet(rows(spark, 2), base, "t", verify=refuse, settle=settle)
    assert held(spark, base) == {(1, 20)}
    assert "2" not in os.listdir(tmp_path / "_versions" / "t")


def test_the_first_table_that_fails_leaves_none(spark, tmp_path):
    with pytest.raises(Exception, match="half way"):
        write_parquet(failing(rows(spark, 2)), str(tmp_path), "t")
    assert not os.path.exists(tmp_path / "t")


def test_a_table_may_be_replaced_by_what_it_holds(spark, tmp_path):
    base = str(tmp_path)
    write_parquet(rows(spark, 1), base, "t")
    old = load_cleaned(spark, base, rows(spark, 0).schema, "t")
    write_parquet(old.withColumn("value", F.col("value") + 4), base, "t")
    assert held(spark, base) == {(5, 20)}


def test_a_plain_table_becomes_a_versioned_one(spark, tmp_path):
    base = str(tmp_path)
    rows(spark, 1).write.parquet(f"{base}/t")
    assert current_path(spark, f"{base}/t") == f"{base}/t"
    write_parquet(rows(spark, 2), base, "t", settle=False)
    assert held(spark, base) == {(2, 20)} and current_path(spark, f"{base}/t") != f"{base}/t"
    write_parquet(rows(spark, 3), base, "t")
    assert held(spark, base) == {(3, 20)} and current_path(spark, f"{base}/t") == f"{base}/t"


@pytest.mark.parametrize("step", ["delete", "move"])
def test_an_end_while_settling_leaves_the_new_table(spark, tmp_path, step, monkeypatch):
    base = str(tmp_path)
    write_parquet(rows(spark, 1), base, "t")
    with monkeypatch.context() as m:
        m.setattr(versions._Folder, step, lambda *args: (_ for _ in ()).throw(OSError("ended")))
        with pytest.raises(OSError, match="ended"):
            write_parquet(rows(spark, 2), base, "t")
    assert held(spark, base) == {(2, 20)}
    write_parquet(rows(spark, 3), base, "t")
    assert held(spark, base) == {(3, 20)} and current_path(spark, f"{base}/t") == f"{base}/t"


def test_readers_of_the_version_before_go_on(spark, tmp_path):
    base = str(tmp_path)
    for value in (1, 2):
        write_parquet(rows(spark, value), base, "t", settle=False)
    reading = load_cleaned(spark, base, rows(spark, 0).schema, "t")
    write_parquet(rows(spark, 3), base, "t", settle=False)
    assert reading.agg(F.max("value")).first()[0] == 2 and held(spark, base) == {(3, 20)}
    write_parquet(rows(spark, 4), base, "t", settle=False)
    assert sorted(n for n in os.listdir(tmp_path / "_versions" / "t") if n.isdigit()) == ["3", "4"]


def test_the_writer_that_started_later_wins(spark, tmp_path):
    base, table = str(tmp_path), f"{tmp_path}/t"
    with pytest.raises(Superseded), replacing(spark, table) as early:
        rows(spark, 1).write.parquet(early)
        with replacing(spark, table) as late:
            assert late != early
            rows(spark, 2).write.parquet(late)
    assert held(spark, base) == {(2, 20)}
