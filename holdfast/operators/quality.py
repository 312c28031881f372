"""Data-quality checks: row and null counts, schema report, write reconciliation, preview."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructType

from holdfast.functions.columns import present
from holdfast.schema import KEY, LABEL
from holdfast.sources.files import write_parquet

# A content digest is kept for each of so many groups of partition values, to tell where a difference lies.
DIGEST_SLOTS = 8

REPORT_SCHEMA = "column STRING, expected STRING, actual STRING, status STRING"


class SchemaError(ValueError):
    """The table lacks a column it must have, or has one in another place or with another type."""


class ReconciliationError(RuntimeError):
    """A written table does not hold the rows that were written to it."""


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: the number of nulls per listed column the table has. One pass for all of them."""
    wanted = present(df, [KEY, LABEL] if columns is None else columns)
    if not wanted:
        raise SchemaError("none of the columns to count nulls in is present")
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in wanted])


def rows_with_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def schema_differences(actual: StructType, expected: StructType) -> list[tuple[str, str, str | None, str]]:
    """(column, expected, actual, status) per expected column; status is ok, type or missing.

    Types are compared exactly. Further columns and nullability do not count.
    """
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    rows = []
    for field in expected.fields:
        want, got = field.dataType.simpleString(), have.get(field.name)
        status = "missing" if got is None else "ok" if got == want else "type"
        rows.append((field.name, want, got, status))
    return rows


def schema_report(spark: SparkSession, actual: StructType, expected: StructType) -> DataFrame:
    return spark.createDataFrame(schema_differences(actual, expected), REPORT_SCHEMA)


def check_schema(actual: StructType, expected: StructType) -> list[str]:
    """Columns whose type differs; a missing column raises."""
    rows = schema_differences(actual, expected)
    missing = [r[0] for r in rows if r[3] == "missing"]
    if missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}")
    return [r[0] for r in rows if r[3] == "type"]


def reconcile(written: int, read_back: DataFrame) -> int:
    """Number of rows in the table read back; raises unless it is the number written."""
    found = read_back.count()
    if found != written:
        raise ReconciliationError(f"{written} rows written, {found} read back")
    return found


def _hashable(df: DataFrame, partition_cols: list[str]) -> dict[str, Column]:
    """The columns as they can be hashed, and as they come back: a blank partition value comes back as null."""

    def value(name: str) -> Column:
        kind, column = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(kind, MapType):
            return F.map_entries(column)
        return F.nullif(column, F.lit("")) if name in partition_cols and isinstance(kind, StringType) else column

    return {name: value(name) for name in sorted(df.columns)}


def content_digest(df: DataFrame, partition_cols: list[str] | None = None) -> list[Column]:
    """Aggregates that tell a table's content, whatever the order of its rows and columns: per group of partition
    values the number of rows, the sum of a 64-bit hash of the whole row and the exclusive or of another one.

    A changed, lost, repeated or swapped value changes them, unless two hashes of 64 bits agree by chance.
    """
    partition_cols = partition_cols or []
    values = _hashable(df, partition_cols)
    first, second = F.xxhash64(*values.values()), F.xxhash64(F.lit("again"), *values.values())
    slot = F.pmod(F.xxhash64(*[values[c] for c in partition_cols]), F.lit(DIGEST_SLOTS)) if partition_cols else F.lit(0)
    found = []
    for at in range(DIGEST_SLOTS if partition_cols else 1):
        here = slot == at
        found += [
            F.count_if(here).alias(f"rows_{at}"),
            F.sum(F.when(here, first.cast("decimal(38,0)"))).alias(f"sum_{at}"),
            F.bit_xor(F.when(here, second)).alias(f"xor_{at}"),
        ]
    return found


def reconcile_content(
    written: Mapping[str, object], read_back: DataFrame, partition_cols: list[str] | None = None
) -> int:
    """Number of rows in the table read back; raises unless its digest is the one observed at the write."""
    found = read_back.agg(*content_digest(read_back, partition_cols)).first().asDict()
    slots = range(DIGEST_SLOTS if partition_cols else 1)
    rows, rows_found = (sum(digest[f"rows_{at}"] or 0 for at in slots) for digest in (written, found))
    if rows != rows_found:
        raise ReconciliationError(f"{rows} rows written, {rows_found} read back")
    differ = [at for at in slots if any((written[f"{k}_{at}"] or 0) != (found[f"{k}_{at}"] or 0) for k in ("rows", "sum", "xor"))]
    if differ:
        where = ""
        if partition_cols:
            slot = F.pmod(F.xxhash64(*[_hashable(read_back, partition_cols)[c] for c in partition_cols]), F.lit(DIGEST_SLOTS))
            some = read_back.where(slot.isin(differ)).select(*partition_cols).distinct().limit(5).collect()
            where = f" in partitions like {', '.join(str(tuple(r)) for r in some) or 'none that is left'}"
        raise ReconciliationError(f"{rows} rows read back, but not the content that was written{where}")
    return rows_found


def write_reconciled(
    df: DataFrame, output_dir: str, table_name: str, partition_cols: list[str] | None = None
) -> tuple[str, int, int]:
    """Write the table, taking its rows' digest in the same pass, read it back and compare, all before the old table
    is replaced. Returns (path, rows written, rows read back).
    """
    digest = Observation(table_name)
    found = []

    def verify(folder: str) -> None:
        table = df.sparkSession.read.schema(df.schema).parquet(folder)
        found.append(reconcile_content(digest.get, table, partition_cols))

    observed = df.observe(digest, *content_digest(df, partition_cols))
    path = write_parquet(observed, output_dir, table_name, partition_cols, verify)
    return path, found[0], found[0]


def preview(df: DataFrame, rows: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """A few rows to look at; the first ones by `order_by` if given, else any."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
