"""Cleanse and write while the shuffle files get lost once; prints what was counted and written.

Run by test_lost_shuffle.py in a process of its own: it needs a session that retries tasks.
"""

from __future__ import annotations

import glob
import json
import os
import sys

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.cleansing import cleanse_with_copies

ROWS, KEYS = 40_000, 10_000


def main(folder: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,4]")
        .config("spark.local.dir", f"{folder}/local")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    marker = f"{folder}/lost"

    def lose_once(batches):
        for batch in batches:
            if not os.path.exists(marker):
                open(marker, "w").close()
                for path in glob.glob(f"{folder}/local/**/shuffle_*", recursive=True):
                    os.unlink(path)
                raise RuntimeError("shuffle files lost")
            yield batch

    rows = spark.range(0, ROWS, 1, 8).select(
        (F.col("id") % KEYS).cast("string").alias("customerID"), F.lit(" x ").alias("value")
    )
    counts = Observation("counts")
    cleansed = cleanse_with_copies(rows, "copies").observe(
        counts, F.sum("copies").alias("read"), F.count(F.lit(1)).alias("written")
    )
    cleansed.mapInPandas(lose_once, cleansed.schema).write.parquet(f"{folder}/out")
    found = spark.read.parquet(f"{folder}/out").count()
    print(json.dumps({**counts.get, "found": found, "lost": os.path.exists(marker)}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
