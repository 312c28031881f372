from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from holdfast.sources.files import load_cleaned, write_parquet

SIZE = 400_000


def rows(spark, tasks):
    """Hashes, which neither an exchange nor Parquet can make smaller; nine tenths of them under one value."""
    text = F.unhex(F.concat(*[F.sha2(F.concat(F.lit(c), F.col("id").cast("string")), 256) for c in "ab"]))
    part = F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("p"), F.floor(F.col("id") / 10) % 3))
    return spark.range(0, 40_000, numPartitions=tasks).select(text.alias("text"), part.alias("part"))


def sizes(folder):
    found = {}
    for path, _, names in os.walk(folder):
        for name in names:
            if name.endswith(".parquet"):
                found.setdefault(os.path.basename(path), []).append(os.path.getsize(os.path.join(path, name)))
    return found


@pytest.mark.parametrize("tasks", [20, 90])
def test_files_have_the_advised_size_whatever_the_scan_is(spark, tmp_path, tasks):
    df = rows(spark, tasks)
    write_parquet(df, str(tmp_path), "t", ["part"], file_bytes=SIZE)
    found = sizes(tmp_path / "t")
    assert len(found) == 4 and len(found["part=hot"]) > 3
    assert all(SIZE / 2 <= size <= 2 * SIZE for size in found["part=hot"])
    assert all(len(files) == 1 for value, files in found.items() if value != "part=hot")  # smaller than a file each
    table = load_cleaned(spark, str(tmp_path), df.schema, "t")
    assert table.exceptAll(df).count() == df.exceptAll(table).count() == 0


@pytest.mark.parametrize("tasks", [20, 90])
def test_a_table_without_partitions(spark, tmp_path, tasks):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    write_parquet(rows(spark, tasks), str(tmp_path), "t", file_bytes=SIZE)
    (found,) = sizes(tmp_path / "t").values()
    assert len(found) > 3 and all(SIZE / 2 <= size <= 2 * SIZE for size in found)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
