"""CSV in, Parquet out and back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from holdfast.cluster import session_conf
from holdfast.schema import CLEANED_SCHEMA, CLEANED_TABLE
from holdfast.sources.versions import current_path, replacing


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def read_csv(spark: SparkSession, path: str, schema: StructType, check_header: bool = False) -> DataFrame:
    """Single-line CSV records with a header, bound to `schema` by position.

    A field that does not parse is null and its row stays; short rows end in nulls, extra fields are
    dropped. One record per line keeps large files splittable. With `check_header` a file whose header
    differs from the schema's names ends the action that reads it.
    """
    return spark.read.csv(
        path, schema=schema, header=True, mode="PERMISSIVE", multiLine=False, enforceSchema=not check_header
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_csv_marked(
    spark: SparkSession, path: str, schema: StructType, mark: str, check_header: bool = False
) -> DataFrame:
    """`read_csv` with a further column `mark`: null for a line that was read as it stands, else the names of the
    columns whose field held text and became null. The array is empty if just the number of fields is wrong or a
    number consists of blanks.

    The same pass: Spark hands out the text of the lines it could not read in full, and only these are taken apart
    once more, as text.
    """
    line = f"{mark}_line"
    raw = spark.read.csv(
        path,
        schema=StructType([*schema.fields, StructField(line, StringType())]),
        header=True,
        mode="PERMISSIVE",
        multiLine=False,
        enforceSchema=not check_header,
        columnNameOfCorruptRecord=line,
    )
    texts = F.from_csv(F.col(line), ", ".join(f"{_quoted(name)} STRING" for name in schema.fieldNames()))

    def lost(name: str) -> Column:
        text = texts.getField(name)
        return F.when(F.col(_quoted(name)).isNull() & (F.trim(text) != ""), F.lit(name))

    typed = [f.name for f in schema.fields if not isinstance(f.dataType, StringType)]
    names = F.array(*[lost(name) for name in typed]).cast("array<string>")
    marked = F.when(F.col(line).isNotNull(), F.array_compact(names))
    return raw.select(*[F.col(_quoted(name)) for name in schema.fieldNames()], marked.alias(mark))


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The column names in the first file; empty if there is none."""
    first = spark.read.option("header", False).csv(path).limit(1).collect()
    return [name or "" for name in first[0]] if first else []


def _sizing(file_bytes: int | None) -> dict[str, str]:
    """Settings under which a rebalancing exchange ends in tasks of 0.5 to 1.5 times the size."""
    if file_bytes is None:
        return {}
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes),
    }


def write_parquet(
    df: DataFrame,
    output_dir: str,
    table_name: str,
    partition_cols: list[str] | None = None,
    verify: Callable[[str], None] | None = None,
    settle: bool = True,
    file_bytes: int | None = None,
) -> str:
    """Replace the table `output_dir/table_name`; returns its path.

    The old table is there until the new one is complete and `verify`, which is given the folder with the new
    one, has not raised; `load_cleaned` reads a whole table at any time (see `versions`). Other readers find it
    at the returned path, unless `settle` is false.

    With partition columns every task writes its own file per value: no exchange by a low-cardinality
    column, which would put a whole value into one task. All old partitions go, listed or not. How many
    files there are then follows from the tasks that write.

    With `file_bytes` the rows are exchanged once, gathered by partition value, in tasks of about that size as
    exchanged: adaptive execution splits a value that is larger, over as many tasks as it takes, and joins
    smaller ones. Each task writes one file per value it holds. A value is split along the tasks that read it, so
    these should read less than a file's size each.
    """
    path = table_path(output_dir, table_name)
    spark = df.sparkSession
    if file_bytes is not None:
        df = df.hint("rebalance", *(partition_cols or []))
    with replacing(spark, path, settle) as folder, session_conf(spark, _sizing(file_bytes)):
        df.write.parquet(folder, partitionBy=partition_cols or None)
        if verify:
            verify(folder)
    return path


def load_cleaned(
    spark: SparkSession,
    base_path: str,
    schema: StructType = CLEANED_SCHEMA,
    table_name: str = CLEANED_TABLE,
) -> DataFrame:
    """The cleansed table with its declared schema, so that partition values keep their type."""
    return spark.read.schema(schema).parquet(current_path(spark, table_path(base_path, table_name)))
