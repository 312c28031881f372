"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.cluster import scratch_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """Write `df` to a new folder in the shared space and read it back; also returns the folder.

    Cuts the lineage: what follows survives lost executors without repeating what came before.
    """
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame) -> DataFrame:
    """As `written`, for a table that the result reads: its folder stays until the caller clears the space."""
    return written(df)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of `written` that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_of(df: DataFrame) -> Column:
    """All columns as one struct, so that added columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(df: DataFrame, column: str = "row") -> DataFrame:
    return df.select(f"{column}.*")


def held_out(doc_id: Column) -> Column:
    """The fourth of all documents whose labels nothing may be learnt from; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def release_memory() -> None:
    """Hand what a batch has freed back to the operating system. Spark keeps worker processes for later stages, whose
    own needs come on top of what these still hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim:
        trim(0)
