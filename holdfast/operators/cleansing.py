"""Cleansing: trim, blank to null, numeric casts, whole-row de-duplication, key check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from holdfast.functions.columns import clean_text, present, to_double
from holdfast.schema import KEY, NUMERICAL_FEATURES


def _text_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}


def trim_strings(df: DataFrame) -> DataFrame:
    text = _text_columns(df)
    return df.select(*[F.trim(c).alias(c) if c in text else F.col(c) for c in df.columns])


def blank_to_null(df: DataFrame) -> DataFrame:
    return df.replace("", None)


def cast_numeric(df: DataFrame, numerical: list[str]) -> DataFrame:
    return df.withColumns({c: to_double(c) for c in present(df, numerical)})


def normalised_columns(df: DataFrame, numerical: list[str] = NUMERICAL_FEATURES) -> dict[str, Column]:
    """Each column trimmed, blank as null, cast where it is a number."""
    text = _text_columns(df)
    numbers = set(present(df, numerical))

    def cleaned(name: str) -> Column:
        value = clean_text(name) if name in text else F.col(name)
        return to_double(value) if name in numbers else value

    return {name: cleaned(name) for name in df.columns}


def normalise(df: DataFrame, numerical: list[str] = NUMERICAL_FEATURES) -> DataFrame:
    """Trim, blank to null and numeric casts for all columns in one projection."""
    return df.select(*[value.alias(name) for name, value in normalised_columns(df, numerical).items()])


def unreadable_numbers(df: DataFrame, numerical: list[str] = NUMERICAL_FEATURES) -> dict[str, Column]:
    """For each number stored as text: whether it holds text that is no number."""
    wanted = [c for c in present(df, numerical) if c in _text_columns(df)]
    return {c: clean_text(c).isNotNull() & to_double(clean_text(c)).isNull() for c in wanted}


def drop_missing_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key is not null; the table as it is when it has no such column."""
    return df.filter(F.col(key).isNotNull()) if key in df.columns else df


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One copy of every distinct whole row. Copies collapse within each task before the exchange,
    so a row that fills a third of the table sends at most one copy per task."""
    return df.dropDuplicates()


def cleanse(df: DataFrame, numerical: list[str] = NUMERICAL_FEATURES, key: str = KEY) -> DataFrame:
    """Normalise every value, then drop rows without a key and repeated rows.

    Rows are compared after normalisation. One exchange, for the de-duplication.
    """
    return drop_duplicate_rows(drop_missing_key(normalise(df, numerical), key))


def cleanse_with_copies(
    df: DataFrame,
    copies: str,
    numerical: list[str] = NUMERICAL_FEATURES,
    key: str = KEY,
    events: list[str] | None = None,
) -> DataFrame:
    """`cleanse` that also counts, in column `copies`, the input rows behind every output row. `events` are boolean
    columns that are no part of a row; each becomes the number of input rows in which it is true.

    Rows without a key fold into one all-null row, which the caller drops. The counts add up to the
    number of rows read, so the counts of a whole job come out of the pass that writes its result.
    Counting before the exchange instead would count rows again whenever a lost executor makes Spark
    repeat part of that stage.
    """
    events = events or []
    values = normalised_columns(df.drop(*events), numerical)
    clean = df.select(*[value.alias(name) for name, value in values.items()], *events)
    if key in values:
        keyed = [F.when(F.col(key).isNotNull(), F.col(c)).alias(c) for c in values]
        clean = clean.select(*keyed, *events)
    counts = [F.count_if(name).alias(name) for name in events]
    return clean.groupBy(*values).agg(F.count(F.lit(1)).alias(copies), *counts)
