"""Scalar building blocks. All are built-in column expressions, so they stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from holdfast.schema import DAYS_PER_MONTH


def present(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns the table has, in the wanted order; the others are skipped silently."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def clean_text(col: str | Column) -> Column:
    """Text without outer spaces (tabs and newlines stay); blank becomes null."""
    return F.nullif(F.trim(col), F.lit(""))


def to_double(col: str | Column) -> Column:
    """Double value, or null where the text is no number, whatever the ANSI setting."""
    col = F.col(col) if isinstance(col, str) else col
    return col.try_cast("double")


def daily_charge_sql(monthly: str) -> str:
    """Monthly charge over a fixed 30-day month. The double literal keeps decimal arithmetic out."""
    return f"try_cast(`{monthly}` AS DOUBLE) / {DAYS_PER_MONTH}D"


def count_or_zero_sql(schema: StructType, column: str) -> str:
    """The count with null read as 0, in the column's own type; literal 0 if the table lacks it.

    Text becomes a long; text that is no whole number stays missing and is not taken for 0.
    """
    if column not in schema.fieldNames():
        return "0"
    if isinstance(schema[column].dataType, NumericType):
        return f"coalesce(`{column}`, 0)"
    return f"CASE WHEN `{column}` IS NULL THEN 0L ELSE try_cast(`{column}` AS BIGINT) END"


def finite_or_null(col: str) -> Column:
    """Double value with NaN and the infinities read as null."""
    value = to_double(col)
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def hash_head(key: str) -> Column:
    """The first 32 bits of the key's MD5 as a number: the same for a key wherever and however often it is
    read; 0 for a null key."""
    head = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10)
    return F.coalesce(head.cast("long"), F.lit(0).cast("long"))
