"""Category columns with more values than a model or the driver should hold.

Their ranking stays a Parquet table, saved beside the model; rows get their index by joining with it. The vector is
built from indices by column expressions and names no slots, as a name for each of millions of slots would be held
by the driver and sent to every task.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from holdfast.functions.columns import present


def sparse_vector(size: int, slots: Column) -> Column:
    """A sparse vector of `size` slots from an array of (index int, value double), ascending by index. Its stored form
    is a struct, which Spark reads as a vector out of JSON without leaving the JVM."""
    stored = F.struct(
        F.lit(0).alias("type"),
        F.lit(size).alias("size"),
        F.transform(slots, lambda s: s["index"]).alias("indices"),
        F.transform(slots, lambda s: s["value"]).alias("values"),
    )
    schema = StructType([StructField("vector", VectorUDT())])
    return F.from_json(F.to_json(F.struct(stored.alias("vector"))), schema)["vector"]


def category_slot(column: str, size: int, start: int) -> Column:
    """The slot of `column`'s index, from `start` on; null for the index after the last."""
    index = F.col(f"{column}_idx").cast("int")
    return F.when(index < size, F.struct((index + start).alias("index"), F.lit(1.0).alias("value")))


def index_by_ranking(df: DataFrame, ranking: DataFrame, columns: list[str], sizes: dict[str, int] | None = None) -> DataFrame:
    """Add `c_idx` for each listed column by joining with its part of the ranking.

    For any number of values, none of which reaches the driver. Null and values the ranking lacks get the
    index after the column's last. The join is left to Spark's size check and skew handling; nulls, which it would
    send to one task, each get a key of their own that no value has.
    """
    for column in present(df, columns):
        mine = ranking.filter(F.col("column") == column)
        after_last = sizes[column] if sizes else mine.agg(F.count(F.lit(1))).first()[0]
        index, value, key = f"{column}_idx", f"{column}_value", f"{column}_key"
        values = mine.select(F.concat("value", F.lit("=")).alias(value), F.col("index").cast("double").alias(index))
        own = F.concat(F.monotonically_increasing_id().cast("string"), F.lit("-"))
        keyed = df.withColumn(key, F.coalesce(F.concat(F.col(column).cast("string"), F.lit("=")), own))
        df = keyed.join(values, F.col(key) == F.col(value), "left").drop(key, value)
        df = df.withColumn(index, F.coalesce(index, F.lit(float(after_last))))
    return df


class RankedCategories(Transformer, MLWritable, MLReadable):
    """Adds `c_idx` for each of `sizes`, which tells the number of values of a column, from the ranking at `path`; with
    `numbers` and `slots` also the `features`: the numbers, then a slot for each value of the columns in `slots`."""

    @keyword_only
    def __init__(self, *, sizes=None, path="", numbers=None, slots=None):
        super().__init__()
        self.sizes, self.path = dict(sizes or {}), path
        self.numbers, self.slots = list(numbers or []), dict(slots or {})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ranking = dataset.sparkSession.read.parquet(self.path)
        indexed = index_by_ranking(dataset, ranking, list(self.sizes), self.sizes)
        if not self.numbers and not self.slots:
            return indexed
        found = [
            F.when(F.col(c) != 0, F.struct(F.lit(at).alias("index"), F.col(c).alias("value")))
            for at, c in enumerate(self.numbers)
        ]
        start = len(self.numbers)
        for column, size in self.slots.items():
            found.append(category_slot(column, size, start))
            start += size
        return indexed.withColumn("features", sparse_vector(start, F.array_compact(F.array(*found))))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance: RankedCategories):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        held, spark = self.instance, self.sparkSession
        more = {"sizes": held.sizes, "numbers": held.numbers, "slots": list(held.slots.items())}
        DefaultParamsWriter.saveMetadata(held, path, spark, extraMetadata=more)
        spark.read.parquet(held.path).write.parquet(f"{path}/ranking")


class _Reader(MLReader):
    def load(self, path: str) -> RankedCategories:
        metadata = DefaultParamsReader.loadMetadata(path, SparkSession.active())
        found = RankedCategories(
            sizes=metadata["sizes"], path=f"{path}/ranking", numbers=metadata["numbers"], slots=dict(metadata["slots"])
        )
        found._resetUid(metadata["uid"])
        return found
