"""Sums over everything that sorts before a row, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.cluster import scratch_dir


def with_sum_before(df: DataFrame, order: list[str | Column], amount: str, name: str, path: str | None = None) -> DataFrame:
    """Add `name`, the sum of `amount` over all rows before a row in `order`.

    The rows are sorted over all tasks and written to `path`, which the result reads, or to the shared scratch
    space. Each task's sum then starts from the sum of the tasks before it: a table of one row per task.
    """
    path = path or f"{scratch_dir(df.sparkSession)}/sorted"
    df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    # The upper bits of the place are the task that sorted the row.
    ordered = df.sparkSession.read.parquet(path).withColumn("_task", F.shiftright("_place", 33))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("_task").agg(F.sum(amount).alias("_held"))
    starts = parts.select("_task", F.coalesce(F.sum("_held").over(before.orderBy("_task")), F.lit(0)).alias("_start"))
    inside = F.coalesce(F.sum(amount).over(before.partitionBy("_task").orderBy("_place")), F.lit(0))
    summed = ordered.withColumn("_inside", inside).join(F.broadcast(starts), "_task")  # a row per sorting task
    return summed.withColumn(name, F.col("_start") + F.col("_inside")).drop("_task", "_place", "_start", "_inside")
