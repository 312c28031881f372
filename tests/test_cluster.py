from __future__ import annotations

import pytest

from holdfast.cluster import (
    MIB,
    RECOMMENDED_CONF,
    fixed_layout,
    input_bytes,
    is_inside,
    matches,
    qualified,
    scratch_dir,
    session_conf,
    shuffle_conf,
    sized_for,
)

TIB = 1024**4


def test_sizes_follow_the_input():
    assert shuffle_conf(10 * MIB, 8) == {}
    assert shuffle_conf(TIB, 200) == {"spark.sql.shuffle.partitions": "4096"}
    assert shuffle_conf(TIB, 5000) == {}
    huge = shuffle_conf(100 * TIB, 200)
    assert huge["spark.sql.shuffle.partitions"] == "20000"
    assert 99_000 < 100 * TIB / int(huge["spark.sql.files.maxPartitionBytes"]) <= 100_000
    bounded = shuffle_conf(100 * TIB, 200, max_scan_tasks=400_000, max_shuffle_tasks=50_000)
    assert bounded["spark.sql.shuffle.partitions"] == "50000"
    assert int(bounded["spark.sql.files.maxPartitionBytes"]) <= 263 * MIB
    assert RECOMMENDED_CONF["spark.sql.files.maxPartitionBytes"] == "256m"


def test_values_are_put_back(spark, tmp_path):
    (tmp_path / "a").write_text("12345")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert input_bytes(spark, str(tmp_path / "*")) == 5
    assert input_bytes(spark, str(tmp_path / "none")) == 0
    with pytest.raises(ZeroDivisionError), session_conf(spark, {"spark.sql.shuffle.partitions": "77"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "77"
        1 / 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with sized_for(spark, TIB):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4096"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_layout_follows_from_the_rows_alone(spark):
    def layout(df):
        return fixed_layout(df, 5).rdd.glom().map(lambda rows: [tuple(r) for r in rows]).collect()

    rows = [(i % 40, i) for i in range(200)]
    df = spark.createDataFrame(rows, "k INT, v INT")
    again = spark.createDataFrame(rows[::-1], "k INT, v INT").repartition(7)
    assert layout(df) == layout(again)
    assert len(layout(df)) == 5


def test_paths_in_any_spelling(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("1")
    (tmp_path / "link").symlink_to(tmp_path / "a")
    folder = qualified(spark, str(tmp_path / "a"))
    for spelt in ("a", "a/", "b/../a", "link"):
        assert qualified(spark, f"{tmp_path}/{spelt}") == folder
    assert qualified(spark, f"file:{tmp_path}/a") == folder
    assert matches(spark, f"{tmp_path}/*/x*") == [f"{folder}/x.csv", f"{folder}/x.csv"]  # by the link as well
    assert is_inside(f"{folder}/x.csv", folder) and not is_inside(f"{folder}b", folder)


def test_scratch_space_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    one, two = scratch_dir(spark), scratch_dir(spark)
    assert one.startswith(shared) and two.startswith(shared) and one != two
